import math
import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tillworks.operators import insights

SCHEMA = "product_key string, store_key string, date_key int, quantity int, total_price double"


@pytest.fixture(scope="module")
def lines():
    dice = random.Random(3)
    start, out = date(2026, 1, 1), []
    for i in range(900):
        shelf = ("hot", "s1") if i % 3 == 0 else (f"p{dice.randrange(4)}", f"s{dice.randrange(2)}")
        day = start + timedelta(days=dice.randrange(60))
        price = 5000.0 if i % 211 == 0 else round(dice.uniform(1, 9), 2)
        out.append((*shelf, int(day.strftime("%Y%m%d")), dice.randrange(1, 6), price))
    return out


def as_day(key):
    return date(key // 10000, key // 100 % 100, key % 100)


def daily(lines):
    units = defaultdict(int)
    for product, store, day, quantity, _ in lines:
        units[product, store, day] += quantity
    return units


def test_velocity_and_baseline(spark, lines):
    units = daily(lines)
    fact = spark.createDataFrame(lines, SCHEMA)
    for row in insights.sales_velocity(fact).collect():
        near = [u for (p, s, d), u in units.items() if (p, s) == (row.product_key, row.store_key)
                and 0 <= (as_day(row.date_key) - as_day(d)).days < 7]
        assert row.avg_units == sum(near) / len(near)
    for row in insights.demand_baseline(fact).collect():
        earlier = sorted((d, u) for (p, s, d), u in units.items() if (p, s) == (row.product_key, row.store_key)
                         and d < row.date_key and as_day(d).isoweekday() == row.day_of_week)[-4:]
        assert row.expected_units == (sum(u for _, u in earlier) / len(earlier) if earlier else None)


def test_stock_and_alerts(spark, lines):
    units = daily(lines)
    opening = spark.createDataFrame([("hot", "s1", 500)], "product_key string, store_key string, opening_units int")
    stock = insights.stock_level(spark.createDataFrame(lines, SCHEMA), opening)
    for row in stock.collect():
        sold = sum(u for (p, s, d), u in units.items() if (p, s) == (row.product_key, row.store_key) and d <= row.date_key)
        assert row.stock_units == (500 if row.product_key == "hot" else 0) - sold
    limits = spark.createDataFrame([("hot", 100)], "product_key string, safety_units int")
    alerts = insights.low_stock_alerts(stock, limits)
    assert alerts.count() == stock.where("product_key = 'hot' AND stock_units < 100").count() > 0


def test_anomalies(spark, lines):
    by_product = defaultdict(list)
    for line in lines:
        by_product[line[0]].append(line[4])
    expected = 0
    for prices in by_product.values():
        mean = sum(prices) / len(prices)
        deviation = math.sqrt(sum((p - mean) ** 2 for p in prices) / len(prices))
        expected += sum(abs(p - mean) > 2.5 * deviation for p in prices)
    flagged = insights.anomaly_flags(spark.createDataFrame(lines, SCHEMA)).collect()
    assert len(flagged) == expected > 0 and {r.total_price for r in flagged} == {5000.0}
    same = spark.createDataFrame([("a", "s", 20260101, 1, 2.0)] * 10, SCHEMA)
    assert insights.anomaly_flags(same).count() == 0


def filled(lines):
    """Units per shelf and calendar day, from the first selling day to six days after the last line of all."""
    units = daily(lines)
    shelves = {(p, s) for p, s, _ in units}
    last = max(as_day(d) for _, _, d in units) + timedelta(days=6)
    out = {}
    for shelf in shelves:
        day = min(as_day(d) for p, s, d in units if (p, s) == shelf)
        out[shelf] = []
        while day <= last:
            out[shelf].append((day, units.get((*shelf, int(day.strftime("%Y%m%d"))), 0)))
            day += timedelta(days=1)
    return out


def test_calendar_days_without_a_sale_count(spark, lines):
    rare = [("rare", "s1", 20260105 + 7 * k, 7, 1.0) for k in range(3)] + [("once", "s1", 20260110, 3, 1.0)]
    fact, days = spark.createDataFrame(lines + rare, SCHEMA), filled(lines + rare)
    checked = set()
    for row in insights.calendar_velocity(fact).collect():
        upto = [u for d, u in days[row.product_key, row.store_key] if d <= as_day(row.date_key)]
        assert upto[-1] == row.units and row.avg_units == sum(upto[-7:]) / len(upto[-7:])
        checked.add(row.product_key)
    assert checked >= {"hot", "rare", "once"}
    for row in insights.calendar_baseline(fact).collect():
        day = as_day(row.date_key)
        assert row.day_of_week == day.isoweekday()
        earlier = [u for d, u in days[row.product_key, row.store_key] if d < day and d.isoweekday() == day.isoweekday()][-4:]
        assert row.expected_units == (sum(earlier) / len(earlier) if earlier else None)


@pytest.mark.parametrize("width", [1, 7])
def test_spans_tell_every_day(spark, lines, width):
    fact, got = spark.createDataFrame(lines, SCHEMA), defaultdict(dict)
    for row in insights.velocity_spans(fact, width).collect():
        day = row.from_day
        while day <= row.to_day:
            assert day not in got[row.product_key, row.store_key]
            got[row.product_key, row.store_key][day] = row.window_units
            day += timedelta(days=1)
    for shelf, days in filled(lines).items():
        sums = {d: sum(u for _, u in days[max(0, i - width + 1) : i + 1]) for i, (d, _) in enumerate(days)}
        assert got[shelf] == {d: s for d, s in sums.items() if s}


def test_spans_are_as_long_as_they_can_be(spark):
    fact = spark.createDataFrame([("p", "s", 20260101, 2, 1.0), ("p", "s", 20260103, 2, 1.0)], SCHEMA)
    (span,) = insights.velocity_spans(fact, 2).collect()
    assert (span.from_day, span.to_day, span.window_units) == (date(2026, 1, 1), date(2026, 1, 4), 2)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spans_bring_a_shelf_together_once(spark, lines):
    fact = spark.createDataFrame(lines, SCHEMA)
    # one shuffle for the daily sums, one by shelf; none for the changes
    assert plan(insights.velocity_spans(fact)).count("Exchange hashpartitioning") == 2


def test_metrics_are_the_same_over_packed_shelves(spark, lines):
    fact = spark.createDataFrame(lines, SCHEMA).withColumn("product_key", F.md5("product_key"))
    fact = fact.unionByName(fact.limit(9).withColumn("store_key", F.lit(None).cast("string")))
    thresholds = fact.select("product_key").distinct().withColumn("safety_units", F.lit(-30))

    def metrics(fact, thresholds):
        opening = fact.select(*insights.SHELF).distinct().withColumn("opening_units", F.lit(40))
        stock = insights.stock_level(fact, opening)
        return insights.velocity_spans(fact), stock, insights.low_stock_alerts(stock, thresholds)

    packed = metrics(insights.with_packed_shelves(fact), insights.with_packed_shelves(thresholds))
    for mine, plain in zip(packed, metrics(fact, thresholds)):
        mine = insights.with_unpacked_shelves(mine)
        assert mine.dtypes == plain.dtypes
        assert sorted(map(repr, mine.collect())) == sorted(map(repr, plain.collect())) != []
