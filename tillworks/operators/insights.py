"""Metrics on the star schema: velocity, stock, alerts, demand baseline, outliers.

Everything first sums lines to one row per product, store and day, so later
windows hold at most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks import functions as fn

SHELF = ("product_key", "store_key")


def day_of_key(date_key: Column) -> Column:
    """The date behind an integer YYYYMMDD key."""
    return F.to_date(date_key.cast("string"), "yyyyMMdd")


def with_packed_shelves(df: DataFrame) -> DataFrame:
    """Shelf keys as bytes, half as wide. All metrics take rows with such keys: what they shuffle is mostly keys."""
    return df.withColumns({key: fn.packed_key(F.col(key)) for key in SHELF if key in df.columns})


def with_unpacked_shelves(df: DataFrame) -> DataFrame:
    """The texts of packed shelf keys."""
    return df.withColumns({key: fn.unpacked_key(F.col(key)) for key in SHELF})


def daily_sales(fact: DataFrame) -> DataFrame:
    """Units sold per product, store and day."""
    return fact.groupBy(*SHELF, "date_key").agg(F.sum("quantity").alias("units"))


def sales_velocity(fact: DataFrame, days: int = 7) -> DataFrame:
    """Units per day and their mean over the selling days among the last ``days`` calendar days."""
    daily = daily_sales(fact).withColumn("_day", F.unix_date(day_of_key(F.col("date_key"))))
    recent = Window.partitionBy(*SHELF).orderBy("_day").rangeBetween(1 - days, 0)
    mean = F.sum("units").over(recent).cast("double") / F.count("*").over(recent)
    return daily.withColumn("avg_units", mean).drop("_day")


def _with_first_day(daily: DataFrame) -> DataFrame:
    """Add ``_day``, the day as a number, and ``_first``, the shelf's first selling day."""
    daily = daily.withColumn("_day", F.unix_date(day_of_key(F.col("date_key"))))
    return daily.withColumn("_first", F.min("_day").over(Window.partitionBy(*SHELF)))


def calendar_velocity(fact: DataFrame, days: int = 7) -> DataFrame:
    """Units per selling day, and their mean over all of the last ``days`` calendar days.

    Days without a sale count as zero, from the shelf's first selling day on, so a shelf that sells once a week
    is not taken for one that sells daily. How many days count follows from the dates; no day is filled in.
    """
    recent = Window.partitionBy(*SHELF).orderBy("_day").rangeBetween(1 - days, 0)
    counted = F.least(F.lit(days), F.col("_day") - F.col("_first") + 1)
    mean = F.sum("units").over(recent).cast("double") / counted
    return _with_first_day(daily_sales(fact)).withColumn("avg_units", mean).drop("_day", "_first")


def calendar_baseline(fact: DataFrame, weeks: int = 4) -> DataFrame:
    """Expected units per shelf and selling day: mean of that weekday in the last ``weeks`` calendar weeks.

    Weeks without a sale on the weekday count as zero, from the shelf's first selling day on; NULL where no such
    weekday lies before.
    """
    daily = _with_first_day(daily_sales(fact)).withColumn("day_of_week", F.pmod(F.col("_day") + 3, F.lit(7)).cast("int") + 1)
    before = Window.partitionBy(*SHELF, "day_of_week").orderBy("_day").rangeBetween(-7 * weeks, -1)
    counted = F.least(F.lit(weeks), F.floor((F.col("_day") - F.col("_first")) / 7))
    sold = F.coalesce(F.sum("units").over(before), F.lit(0)).cast("double")
    return daily.withColumn("expected_units", F.when(counted > 0, sold / counted)).drop("_day", "_first")


def velocity_spans(fact: DataFrame, days: int = 7) -> DataFrame:
    """The trailing sum of units over ``days`` calendar days for every day, as spans in which it stays the same.

    A sale enters the sum on its day and leaves it ``days`` later, so two changes per selling day tell it all,
    however long a shelf stands still between them. Spans go from a shelf's first selling day to the last
    on which anything counts; both ends are included. The daily sums are brought together by shelf before they
    become two changes each, so nothing that comes after moves a row.
    """
    daily = daily_sales(fact).withColumn("_day", F.unix_date(day_of_key(F.col("date_key")))).repartition(*SHELF)
    entering = F.struct(F.col("_day").alias("at"), F.col("units").alias("change"))
    leaving = F.struct((F.col("_day") + days).alias("at"), (-F.col("units")).alias("change"))
    changes = daily.select(*SHELF, F.inline(F.array(entering, leaving)))
    changes = changes.groupBy(*SHELF, "at").agg(F.sum("change").alias("change")).where(F.col("change") != 0)
    in_order = Window.partitionBy(*SHELF).orderBy("at")
    spans = changes.select(
        *SHELF,
        F.date_from_unix_date("at").alias("from_day"),
        F.date_from_unix_date(F.lead("at").over(in_order) - 1).alias("to_day"),
        F.sum("change").over(in_order).alias("window_units"),
    )
    return spans.where(F.col("window_units") > 0).withColumn("avg_units", F.col("window_units").cast("double") / days)


def stock_level(fact: DataFrame, opening: DataFrame) -> DataFrame:
    """Stock left per product, store and day: opening stock less everything sold so far.

    ``opening`` holds product_key, store_key, opening_units; shelves without an
    entry start at zero.
    """
    so_far = Window.partitionBy(*SHELF).orderBy("date_key").rowsBetween(Window.unboundedPreceding, 0)
    sold = daily_sales(fact).withColumn("sold_units", F.sum("units").over(so_far))
    return sold.join(opening, list(SHELF), "left").select(
        *SHELF,
        "date_key",
        "units",
        "sold_units",
        (F.coalesce("opening_units", F.lit(0)) - F.col("sold_units")).alias("stock_units"),
    )


def low_stock_alerts(stock: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Days on which a shelf is below its product's safety stock.

    ``thresholds`` holds product_key, safety_units; products without an entry
    raise no alert.
    """
    return stock.join(thresholds, "product_key").where(F.col("stock_units") < F.col("safety_units"))


def demand_baseline(fact: DataFrame, weeks: int = 4) -> DataFrame:
    """Expected units per shelf and day: mean of the last ``weeks`` selling days on that weekday."""
    day = day_of_key(F.col("date_key"))
    daily = daily_sales(fact).withColumn("day_of_week", (F.weekday(day) + 1).cast("int"))
    before = Window.partitionBy(*SHELF, "day_of_week").orderBy("date_key").rowsBetween(-weeks, -1)
    mean = F.sum("units").over(before).cast("double") / F.count("*").over(before)
    return daily.withColumn("expected_units", mean)


def anomaly_flags(fact: DataFrame, threshold: float = 2.5) -> DataFrame:
    """Lines whose value lies ``threshold`` standard deviations off its product's mean.

    Per product the exact count, sum and sum of squares of cents are aggregated
    and joined back; a window over a product's raw lines would put a best-seller
    into one task. With n, s, q for these, the score of a line of c cents is
    (n*c - s) / sqrt(n*q - s*s): whole numbers up to the final division.
    """
    cents = fn.cents(F.col("total_price"))
    wide = F.col("_cents").cast("decimal(19,0)")
    lines = fact.withColumn("_cents", cents)
    moments = lines.groupBy("product_key").agg(
        F.count("*").cast("decimal(19,0)").alias("_n"),
        F.sum("_cents").cast("decimal(19,0)").alias("_s"),
        F.sum((wide * wide).cast("decimal(38,0)")).alias("_q"),
    )
    n, s, q = F.col("_n"), F.col("_s"), F.col("_q")
    profile = (
        moments.select("product_key", "_n", "_s", ((n * q).cast("decimal(38,0)") - (s * s).cast("decimal(38,0)")).alias("_spread"))
        .where(F.col("_spread") > 0)
    )
    score = ((n * wide).cast("decimal(38,0)") - s).cast("double") / F.sqrt(F.col("_spread").cast("double"))
    return (
        lines.join(profile, "product_key")
        .withColumn("z_score", score)
        .where(F.abs("z_score") > threshold)
        .select(*fact.columns, "z_score")
    )
