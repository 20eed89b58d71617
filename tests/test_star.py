from datetime import date, datetime

from tillworks.operators import star
from tillworks.operators.cleanse import standardize


def test_one_row_per_product(sale):
    silver = standardize(sale({"product_name": "milk"}, {"product_name": "whole milk"}, {"product_id": "p2"}))
    assert star.product_variants(silver).count() == 3
    rows = {r.product_id: r.product_name for r in star.dim_product(silver).collect()}
    assert rows == {"p1": "Whole Milk", "p2": "Milk"}


def test_default_calendar(spark):
    days = {r.full_date: r for r in star.date_dim(spark).collect()}
    assert len(days) == 1461
    new_year = days[date(2027, 1, 1)]
    assert (new_year.week_of_year, new_year.day_of_week, new_year.quarter, new_year.is_weekend) == (53, 5, 1, False)
    assert (new_year.month_name, new_year.day_name) == ("January  ", "Friday   ")
    assert days[date(2026, 3, 1)].is_weekend and days[date(2026, 3, 1)].day_of_week == 7
    assert star.date_dim(spark, date(2026, 5, 1), date(2026, 5, 1), padded=False).first().month_name == "May"


def test_calendar_of_no_rows_is_empty(spark):
    nothing = spark.createDataFrame([], "t timestamp")
    assert star.date_dim_covering(nothing, "t").count() == 0


def test_star_join_restores_the_lines(spark, sale):
    silver = standardize(sale({}, {"transaction_id": "t2", "store_id": "south_02", "quantity": "1", "total_price": "1.5"}))
    dims = {name: build(silver) for name, build in star.DIMENSIONS.items()}
    dims["dim_date"] = star.date_dim_covering(silver, "sale_timestamp")
    rows = {r.transaction_id: r for r in star.star_join(star.fact_sales(silver), dims).collect()}
    assert rows["t2"].store_id == "SOUTH_02" and rows["t1"].product_category == "DAIRY"
    assert rows["t1"].full_date == date(2026, 1, 22)
    counts = {r.table_name: r.row_count for r in star.table_counts({"fact_sales": silver, **dims}).collect()}
    assert counts == {"fact_sales": 2, "dim_product": 1, "dim_store": 2, "dim_payment_method": 1, "dim_client_type": 1, "dim_date": 1}


def test_null_members_have_null_keys(sale):
    fact = star.fact_sales(standardize(sale({"payment_method": None}))).first()
    assert fact.payment_method_key is None and fact.date_key == 20260122
    assert fact.sale_timestamp == datetime(2026, 1, 22, 8, 45, 58, 232187)
