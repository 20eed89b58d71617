import json
from datetime import date

from pyspark.sql import functions as F

from tillworks.layout import Layout
from tillworks.operators import star
from tillworks.plans import bronze_to_silver as b2s
from tillworks.plans import silver_to_gold as s2g
from tillworks.schemas import FACT_SALES_SPEC, QUARANTINE, SALES_SILVER_SPEC, SILVER
from tillworks.sources import bronze, lake, serving
from tillworks.operators import ingest


def land(spark, layout, day, records, batch):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    lines = df.transform(ingest.with_message).transform(ingest.with_missing_fields)
    clock = F.lit(f"{day} 10:00:00").cast("timestamp")
    bronze.write_bronze(ingest.stamp(ingest.accepted(lines), clock), layout.bronze, batch)


def test_two_days_end_to_end(spark, sale, tmp_path):
    layout = Layout(str(tmp_path))
    one, two = date(2026, 1, 22), date(2026, 1, 23)
    line = lambda **c: {**sale.sound, **c}
    land(spark, layout, one, [line(), line(transaction_id="t2"), line(quantity="0"), line(transaction_id="t3", payment_method=None)], "b1")
    land(spark, layout, two, [
        line(unit_price="2", total_price="4", store_id="south_02", product_name="oat milk"),
        line(transaction_id="t4", timestamp="2023-05-01T00:00:00+00:00"),
    ], "b2")
    s2g.load_dates(spark, layout)

    assert b2s.bronze_to_silver(spark, layout, one) == {"total_rows": 4, "valid_rows": 3, "quarantined_rows": 1}
    assert b2s.bronze_to_silver(spark, layout, one)["valid_rows"] == 3  # a rerun replaces the day
    (bad,) = lake.scan_days(spark, layout.quarantine, QUARANTINE, one, ("quarantine_reason",)).collect()
    assert bad.quarantine_reason == "invalid:quantity"
    for day in (one, two):
        b2s.bronze_to_silver(spark, layout, day)
        b2s.serve_silver(spark, layout, day)
        s2g.silver_to_gold(spark, layout, day)
        s2g.serve_gold(spark, layout, day)
    s2g.serve_gold(spark, layout, two)  # again: nothing changes

    silver = {r.transaction_id: r for r in serving.read_table(spark, layout.serving("sales_silver"), SALES_SILVER_SPEC.schema).collect()}
    assert sorted(silver) == ["t1", "t2", "t3", "t4"]
    assert (str(silver["t1"].total_price), silver["t1"].store_id, silver["t1"].product_name) == ("4.00", "NORTH_01", "Oat Milk")
    facts = serving.read_table(spark, layout.serving("fact_sales"), FACT_SALES_SPEC.schema)
    rows = {r.transaction_id: r for r in facts.collect()}
    assert sorted(rows) == ["t1", "t2"]  # t3 has no payment method, t4 lies before the calendar
    assert len({r.sale_key for r in rows.values()}) == 2
    refused = {r.transaction_id: r.broken_constraint for day in (one, two) for r in s2g.gold_rejects(spark, layout, day).collect()}
    assert refused == {"t3": "not_null:payment_method_key", "t4": "fk:date_key"}
    joined = {r.transaction_id: r for r in star.star_join(facts, s2g.dimensions(spark, layout)).collect()}
    assert (joined["t1"].store_id, joined["t2"].store_id, joined["t2"].product_name) == ("SOUTH_02", "NORTH_01", "Oat Milk")


def test_backfill_equals_day_by_day(spark, sale, tmp_path):
    layout = Layout(str(tmp_path))
    days = [date(2026, 1, 22), date(2026, 1, 23), date(2026, 1, 24)]
    for i, day in enumerate(days):
        land(spark, layout, day, [{**sale.sound, "transaction_id": f"t{i}"}, {**sale.sound, "store_id": None}], f"b{i}")
    b2s.bronze_to_silver_days(spark, layout, days[:2])
    assert sorted(r.transaction_id for r in lake.scan_days(spark, layout.silver, SILVER).collect()) == ["t0", "t1"]
    b2s.bronze_to_silver_days(spark, layout)
    assert lake.scan_days(spark, layout.silver, SILVER).count() == 3
    assert lake.scan_days(spark, layout.quarantine, QUARANTINE, partitions=("quarantine_reason",)).count() == 3


def test_every_sale_is_served_or_refused(spark, sale, tmp_path):
    layout, day = Layout(str(tmp_path)), date(2026, 1, 22)
    line = lambda **c: {**sale.sound, **c}
    land(spark, layout, day, [
        line(),
        line(transaction_id="long", product_id="p2", product_name="x" * 101),
        line(transaction_id="dear", unit_price="200000000", total_price="400000000"),
        line(transaction_id="early", timestamp="2001-01-01T00:00:00+00:00"),
        line(transaction_id="unpaid", payment_method=None),
    ], "b1")
    s2g.load_dates(spark, layout)
    assert b2s.bronze_to_silver(spark, layout, day)["valid_rows"] == 5
    served = b2s.serve_silver(spark, layout, day)
    assert (served.merged, served.rejected) == (3, 2)
    refused = spark.read.parquet(layout.rejects("sales_silver"))
    assert {r.transaction_id: r.broken_constraint for r in refused.collect()} == {
        "long": "varchar:product_name", "dear": "decimal:unit_price",
    }
    s2g.silver_to_gold(spark, layout, day)
    (member,) = spark.read.parquet(layout.rejects("dim_product")).collect()
    assert (member.product_id, member.broken_constraint) == ("p2", "varchar:product_name")
    gold = s2g.serve_gold(spark, layout, day)
    assert (gold.merged, gold.rejected) == (2, 3)
    facts = serving.read_table(spark, layout.serving("fact_sales"), FACT_SALES_SPEC.schema).collect()
    assert sorted(r.transaction_id for r in facts) == ["long", "t1"]  # the member stays, without its name
    assert {r.transaction_id: r.broken_constraint for r in s2g.gold_rejects(spark, layout, day).collect()} == {
        "dear": "decimal:unit_price", "early": "fk:date_key", "unpaid": "not_null:payment_method_key",
    }


def test_a_refused_load_is_written_without_a_shuffle(spark, sale, tmp_path, monkeypatch):
    layout, day, writes = Layout(str(tmp_path)), date(2026, 1, 22), []
    line = lambda k: {**sale.sound, "transaction_id": f"t{k}", "product_name": "x" * 101}
    land(spark, layout, day, [line(k) for k in range(50)] + [sale.sound], "b1")
    b2s.bronze_to_silver(spark, layout, day)
    lake.write_day(lake.scan_days(spark, layout.silver, SILVER, day).repartition(50), layout.silver, day, laid_out=True)
    assert len(lake.scan_days(spark, layout.silver, SILVER, day).inputFiles()) > 16  # as many as the tasks with rows
    real = b2s.write_day

    def watched(df, root, *args, laid_out=False):
        writes.append(laid_out and "Exchange" not in df._jdf.queryExecution().executedPlan().toString())
        return real(df, root, *args, laid_out=laid_out)

    monkeypatch.setattr(b2s, "write_day", watched)
    served = b2s.serve_silver(spark, layout, day)
    assert (served.merged, served.rejected, writes) == (1, 50, [True])
    refused = lake.scan_days(spark, layout.rejects("sales_silver"), SILVER, day)
    assert sorted(r.transaction_id for r in refused.collect()) == sorted(f"t{k}" for k in range(50))
    assert len(refused.inputFiles()) <= spark.sparkContext.defaultParallelism
