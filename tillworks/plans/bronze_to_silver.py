"""One day from bronze to silver: type, tag, split, write both sides, merge the serving table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillworks.layout import Layout
from tillworks.operators import cleanse, quality
from tillworks.operators.constraints import BROKEN, split_broken, to_serving, with_broken
from tillworks.schemas import DAY_COLUMNS, SALES_SILVER_SPEC, SILVER, TableSpec
from tillworks.session import in_few_files, staged
from tillworks.sources.bronze import scan_bronze
from tillworks.sources.lake import overwrite_days, scan_days, write_day
from tillworks.sources.serving import merge_table

# Columns a later batch overwrites; the remaining ones keep their first value.
SILVER_UPDATES = (
    "product_name",
    "product_category",
    "quantity",
    "unit_price",
    "total_price",
    "sale_timestamp",
    "processed_at",
)
SILVER_KEYS = ("transaction_id", "product_id")


def tagged_lines(
    raw: DataFrame,
    rules: Sequence[quality.Rule] = quality.SALES_RULES,
    processed_at: Column | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    return quality.tag(cleanse.standardize(raw, processed_at, carry), rules)


def bronze_to_silver(
    spark: SparkSession,
    layout: Layout,
    day: date,
    rules: Sequence[quality.Rule] = quality.SALES_RULES,
    processed_at: Column | None = None,
) -> dict[str, int]:
    """Replace one day of silver and quarantine; returns the row counts.

    Bronze is parsed once: the tagged rows go to the work folder for the two writes,
    and the counts are observed on the way.
    """
    seen = Observation("bronze_to_silver")
    tagged = tagged_lines(scan_bronze(spark, layout.bronze, day), rules, processed_at)
    with staged(tagged.observe(seen, *quality.metric_columns()), "tagged") as kept:
        valid, quarantined = quality.split(kept)
        write_day(valid, layout.silver, day)
        write_day(quarantined, layout.quarantine, day, (quality.REASON,))
    return dict(seen.get)


def bronze_to_silver_days(
    spark: SparkSession,
    layout: Layout,
    days: Sequence[date] = (),
    rules: Sequence[quality.Rule] = quality.SALES_RULES,
    processed_at: Column | None = None,
) -> None:
    """Backfill: all days of bronze (or the given ones) in one job per side.

    The typed lines go to the work folder once and both sides are written from there.
    """
    raw = scan_bronze(spark, layout.bronze, days=days)
    with staged(tagged_lines(raw, rules, processed_at, carry=DAY_COLUMNS), "tagged") as tagged:
        valid, quarantined = quality.split(tagged)
        overwrite_days(valid, layout.silver, days, laid_out=True)  # as the bronze files lie
        overwrite_days(quarantined, layout.quarantine, days, (quality.REASON,))


class Served(NamedTuple):
    """What a serving load did: periods rewritten, rows merged, rows refused (stored with their constraint)."""

    periods: list[str]
    merged: int
    rejected: int


def serve_silver(spark: SparkSession, layout: Layout, day: date, grain: str = "day") -> Served:
    """Merge one day of silver into the serving table.

    Rows that break a constraint are stored by day under ``layout.rejects("sales_silver")``.
    """
    batch = scan_days(spark, layout.silver, SILVER, day).select(*SILVER.names)
    return load_serving(
        with_broken(batch, SALES_SILVER_SPEC), layout, SALES_SILVER_SPEC, day, SILVER_KEYS, SILVER_UPDATES, grain=grain
    )


def load_serving(
    tagged: DataFrame, layout: Layout, spec: TableSpec, day: date, keys: Sequence[str], update: Sequence[str], **options
) -> Served:
    """Merge the rows that break nothing and store the others, both from one evaluation of ``tagged``.

    The refused rows are counted first and written by as many tasks as that calls for: few leave few files, and a load
    that is refused as a whole is not shuffled.
    """
    with staged(tagged, "serving-batch") as rows:
        good, refused = split_broken(rows)
        counts = rows.agg(F.count_if(F.col(BROKEN).isNull()), F.count_if(F.col(BROKEN).isNotNull())).first()
        write_day(in_few_files(refused, counts[1]), layout.rejects(spec.name), day, laid_out=True)
        periods = merge_table(
            rows.sparkSession, layout.serving(spec.name), spec.schema, to_serving(good, spec), keys, update, **options
        )
    return Served(periods, *counts)
