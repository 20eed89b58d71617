import pytest
from pyspark.sql import functions as F

from tillworks.operators import quality
from tillworks.operators.cleanse import standardize


def reasons(lines, rules=quality.SALES_RULES):
    return [r.quarantine_reason for r in quality.tag(standardize(lines), rules).collect()]


@pytest.mark.parametrize(
    "change, tag",
    [
        ({}, None),
        ({"transaction_id": None}, "null:transaction_id"),
        ({"product_id": None}, "null:product_id"),
        ({"store_id": None}, "null:store_id"),
        ({"timestamp": None}, "null:sale_timestamp"),
        ({"timestamp": "not a ts"}, "null:sale_timestamp"),
        ({"quantity": "abc"}, "invalid:quantity"),
        ({"quantity": "0"}, "invalid:quantity"),
        ({"unit_price": "-1"}, "invalid:unit_price"),
        ({"unit_price": None}, "invalid:unit_price"),
        ({"total_price": "0.0"}, "invalid:total_price"),
        ({"total_price": "9.99"}, "inconsistent:total_vs_unit_x_qty"),
        ({"unit_price": "NaN"}, "inconsistent:total_vs_unit_x_qty"),
        ({"payment_method": None, "client_type": None, "product_name": None, "category": None}, None),
        ({"transaction_id": "  "}, None),
        ({"quantity": "1", "unit_price": "1.20", "total_price": "1.21"}, "inconsistent:total_vs_unit_x_qty"),
        ({"quantity": "1", "unit_price": "2.50", "total_price": "2.51"}, None),
        ({"store_id": None, "quantity": "0", "total_price": "0"}, "null:store_id"),
        ({"quantity": "0", "unit_price": "0"}, "invalid:quantity"),
    ],
)
def test_rules_in_order(sale, change, tag):
    assert reasons(sale(change)) == [tag]


def test_exact_price_rule_allows_one_cent(sale):
    rules = (quality.price_rule(exact=True),)
    lines = sale(
        {"quantity": "1", "unit_price": "1.20", "total_price": "1.21"},
        {"quantity": "1", "unit_price": "1.20", "total_price": "1.22"},
    )
    assert reasons(lines, rules) == [None, "inconsistent:total_vs_unit_x_qty"]


def test_split_is_complete_and_counts_in_one_pass(sale):
    tagged = quality.tag(standardize(sale({}, {"quantity": "0"}, {"store_id": None}, {})))
    valid, quarantined = quality.split(tagged)
    assert (valid.count(), quarantined.count()) == (2, 2)
    assert "quarantine_reason" not in valid.columns
    assert quality.split_invariant(tagged).first().complete
    assert {tuple(r) for r in quality.audit(tagged).collect()} == {("invalid:quantity", 1), ("null:store_id", 1)}
    assert tuple(quality.metrics(tagged).first()) == (4, 2, 2)


def test_the_tag_is_computed_once(sale):
    plan = quality.valid(quality.tag(standardize(sale({}))))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("null:transaction_id") == 1


def test_standardize_types_and_carry(sale):
    row = standardize(sale({"quantity": "2.7", "category": " fresh "}).withColumn("year", F.lit("2026")), carry=("year",)).first()
    assert (row.quantity, row.product_category, row.product_name, row.store_id, row.year) == (
        2, "FRESH", "Milk", "NORTH_01", "2026",
    )
