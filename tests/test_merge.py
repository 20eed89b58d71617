import random

import pytest

from tillworks.operators import merge
from tillworks.schemas import FACT_SALES_SPEC, empty_table

KEYS = ["k", "p"]
SCHEMA = "k string, p string, price double, store string, note string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("small_batch", [False, True])
def test_policies_per_column(spark, small_batch):
    target = spark.createDataFrame([("a", "1", 1.0, "s1", "x"), ("b", "1", 2.0, "s1", "x")], SCHEMA)
    batch = spark.createDataFrame([("a", "1", 9.0, "s9", None), ("c", "1", 3.0, "s3", None)], SCHEMA)
    merged = merge.upsert(target, batch, KEYS, ["price", "note"], order=(), small_batch=small_batch)
    assert rows(merged) == [("a", "1", 9.0, "s1", None), ("b", "1", 2.0, "s1", "x"), ("c", "1", 3.0, "s3", None)]
    again = merge.upsert(merged, batch, KEYS, ["price", "note"], order=(), small_batch=small_batch)
    assert rows(again) == rows(merged)


@pytest.mark.parametrize("small_batch", [False, True])
def test_columns_the_batch_lacks_stay(spark, small_batch):
    target = spark.createDataFrame([("a", "1", 7)], "k string, p string, serial long")
    batch = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, p string")
    merged = merge.upsert(target, batch, KEYS, order=(), small_batch=small_batch)
    assert rows(merged) == [("a", "1", 7), ("b", "2", None)]


def test_repeated_keys_in_a_batch(spark):
    batch = spark.createDataFrame([("a", "1", 1.0, "s1", None), ("a", "1", 2.0, None, "x")], SCHEMA)
    assert merge.one_per_key(batch, KEYS, ["price"]).first().price == 2.0
    assert merge.one_per_key(batch, KEYS, ["price"], pick="first").first().price == 1.0
    assert merge.one_per_key(batch, KEYS, ["store"]).first().store == "s1"  # NULL is below every value
    with pytest.raises(Exception, match="duplicate key in batch"):
        merge.one_per_key(batch, KEYS, on_duplicate="error").collect()
    assert merge.one_per_key(batch.limit(1), KEYS, on_duplicate="error").count() == 1


def test_hot_key_against_brute_force(spark):
    dice = random.Random(7)
    data = []
    for i in range(3000):
        key = ("hot", "1") if i % 3 == 0 else (f"k{dice.randrange(400)}", str(dice.randrange(3)))
        data.append((*key, dice.choice([None, round(dice.random(), 3)]), dice.choice([None, "s1", "s2"]), f"n{i}"))
    expected = {}
    low = lambda v: (v is not None, v)
    for row in data:
        best = expected.get(row[:2])
        if best is None or [low(v) for v in row[2:]] > [low(v) for v in best[2:]]:
            expected[row[:2]] = row
    df = spark.createDataFrame(data, SCHEMA).repartition(8)
    assert rows(merge.one_per_key(df, KEYS, ["price", "store"])) == sorted(expected.values(), key=repr)
    plan = merge.one_per_key(df, KEYS, ["price"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_insert_absent_keeps_what_is_there(spark):
    target = spark.createDataFrame([("a", "old")], "k string, v string")
    batch = spark.createDataFrame([("a", "new"), ("b", "2"), ("b", "1")], "k string, v string")
    assert rows(merge.insert_absent(target, batch, ["k"])) == [("a", "old"), ("b", "1")]


def test_assigned_keys_are_unique_and_kept(spark):
    target = spark.createDataFrame([("a", "1", 41)], "k string, p string, sale_key long")
    fresh = [(f"n{i}", "1", None) for i in range(200)] + [("a", "1", 41)]
    df = spark.createDataFrame(fresh, "k string, p string, sale_key long").repartition(8)
    keys = {r.k: r.sale_key for r in merge.assign_key(df, target).collect()}
    assert keys["a"] == 41 and len(set(keys.values())) == 201 and min(keys.values()) == 41
    first = merge.assign_key(df.drop("sale_key"), empty_table(spark, FACT_SALES_SPEC))
    assert first.columns[0] == "sale_key" and first.where("sale_key < 1").count() == 0
