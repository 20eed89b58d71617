"""Validation rules, the valid/quarantine split, and its metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import with_computed

REASON = "quarantine_reason"
PRICE_TOLERANCE = 0.01  # fixed value


@dataclass(frozen=True)
class Rule:
    """A tag and the SQL predicate of the rows it applies to."""

    tag: str
    fails_when: str


def price_rule(tolerance: float = PRICE_TOLERANCE, exact: bool = False) -> Rule:
    """Total against unit price times quantity.

    The default compares doubles, where a gap of exactly one cent may fall on
    either side; ``exact`` compares whole cents.
    """
    if exact:
        gap = "abs(round(total_price * 100) - round(round(unit_price * quantity, 2) * 100))"
        return Rule("inconsistent:total_vs_unit_x_qty", f"{gap} > {round(tolerance * 100)}")
    return Rule(
        "inconsistent:total_vs_unit_x_qty",
        f"abs(total_price - round(unit_price * quantity, 2)) > CAST({tolerance!r} AS DOUBLE)",
    )


# Tags and their order; the first failing rule names the row.
SALES_RULES = (
    Rule("null:transaction_id", "transaction_id IS NULL"),
    Rule("null:product_id", "product_id IS NULL"),
    Rule("null:store_id", "store_id IS NULL"),
    Rule("null:sale_timestamp", "sale_timestamp IS NULL"),
    Rule("invalid:quantity", "quantity IS NULL OR quantity <= 0"),
    Rule("invalid:unit_price", "unit_price IS NULL OR unit_price <= 0"),
    Rule("invalid:total_price", "total_price IS NULL OR total_price <= 0"),
    price_rule(),
)


def first_failure(rules: Sequence[Rule] = SALES_RULES) -> Column:
    """Tag of the first rule that fails, NULL when none does."""
    return F.coalesce(*[F.when(F.expr(rule.fails_when), F.lit(rule.tag)) for rule in rules])


def tag(df: DataFrame, rules: Sequence[Rule] = SALES_RULES) -> DataFrame:
    """Add the reason column, evaluated once however often the split filters on it."""
    return with_computed(df, REASON, first_failure(rules))


def valid(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def quarantined(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the tag, and quarantined rows with it."""
    return valid(tagged), quarantined(tagged)


def metric_columns() -> list[Column]:
    """Row counts of one tagged set; also usable with ``DataFrame.observe``."""
    reason = F.col(REASON)
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(reason.isNull()).alias("valid_rows"),
        F.count_if(reason.isNotNull()).alias("quarantined_rows"),
    ]


def metrics(tagged: DataFrame) -> DataFrame:
    return tagged.agg(*metric_columns())


def audit(tagged: DataFrame) -> DataFrame:
    """Quarantined rows per reason."""
    return quarantined(tagged).groupBy(REASON).agg(F.count("*").alias("lines"))


def split_invariant(tagged: DataFrame) -> DataFrame:
    """Whether the two sides of the split are disjoint and complete, from one pass."""
    sides = metrics(tagged)
    return sides.withColumn("complete", F.col("valid_rows") + F.col("quarantined_rows") == F.col("total_rows"))
