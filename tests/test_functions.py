import hashlib

import pytest
from pyspark.sql import functions as F

from tillworks import functions as fn


def evaluate(spark, function, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(function(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "text, number",
    [("3", 3), ("2.7", 2), ("2.0", 2), (" 4 ", 4), ("-1", -1), ("1e2", 100), ("abc", None), ("", None), (None, None),
     ("5d", None), ("5f", None), ("99999999999", None), ("NaN", None), ("2147483647", 2147483647)],
)
def test_whole_number(spark, text, number):
    assert evaluate(spark, fn.whole_number, text) == number


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_never_raise(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert evaluate(spark, fn.money, "x") is None
        assert evaluate(spark, fn.parse_instant, "not a ts") is None
        assert evaluate(spark, fn.whole_number, "2.7") == 2
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    "text, instant",
    [
        ("2026-01-22T08:45:58.232187+00:00", "2026-01-22 08:45:58.232187"),
        ("2026-01-22T08:45:58+00:00", "2026-01-22 08:45:58"),
        ("2026-01-22T08:45:58+02:00", "2026-01-22 06:45:58"),
        ("2026-01-22 08:45:58", "2026-01-22 08:45:58"),
    ],
)
def test_parse_instant(spark, text, instant):
    assert evaluate(spark, lambda c: fn.parse_instant(c).cast("string"), text) == instant


def test_text(spark):
    assert evaluate(spark, fn.title, " Water 1.5L ") == "Water 1.5l"
    assert evaluate(spark, fn.title, "kitchen-roll") == "Kitchen-roll"
    assert evaluate(spark, fn.code, " north_01 ") == "NORTH_01"
    assert evaluate(spark, fn.clean, "  ") == ""
    assert evaluate(spark, fn.clean, "\ta ") == "\ta"


def test_keys_and_money(spark):
    assert evaluate(spark, fn.surrogate_key, "P001") == hashlib.md5(b"P001").hexdigest()
    assert evaluate(spark, fn.surrogate_key, None) is None
    assert str(evaluate(spark, fn.serving_money, 1.005, "double")) == "1.01"
    assert evaluate(spark, fn.serving_money, 1e8, "double") is None
    assert evaluate(spark, lambda c: fn.date_key(c.cast("timestamp")), "2026-03-09 23:59:59") == 20260309


def test_packed_keys(spark):
    digest = hashlib.md5(b"P1").hexdigest()
    texts = [digest, digest.upper(), "0" * 32, "", "P1", "\u00fc" * 16, "x" * 32, "\0" * 16, digest[:16], None]
    keys = spark.createDataFrame([(t,) for t in texts], "k string").select("k", fn.packed_key(F.col("k")).alias("p"))
    rows = keys.select("k", "p", fn.unpacked_key(F.col("p")).alias("back")).collect()
    assert [r.back for r in rows] == texts and len({r.p and bytes(r.p) for r in rows}) == len(texts)
    assert [len(r.p) for r in rows[:3]] == [16, 49, 16]
