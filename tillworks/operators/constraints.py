"""Constraint reports: the rows or keys a serving table would refuse.

Reports over one table read it once, whatever the number of constraints.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import functions as fn
from tillworks.functions import with_computed
from tillworks.operators.merge import absent_from
from tillworks.schemas import TableSpec

KEY_SEPARATOR = "/"
ABSENT_KEY_PART = "?"


def row_key(columns: Sequence[str]) -> Column:
    """Readable identity of a row: its key columns joined, NULL parts marked."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(ABSENT_KEY_PART)) for c in columns]
    return F.concat_ws(KEY_SEPARATOR, *parts)


def _violations(df: DataFrame, checks: dict[str, Column], key: Sequence[str]) -> DataFrame:
    """(constraint_name, row_key) for every check a row fails."""
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()]))
    return df.select(F.explode(failed).alias("constraint_name"), row_key(key).alias("row_key"))


def not_null_violations(df: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    return _violations(df, {f"not_null:{c}": F.col(c).isNull() for c in columns}, key)


def varchar_violations(df: DataFrame, limits: dict[str, int], key: Sequence[str]) -> DataFrame:
    return _violations(df, {f"varchar:{c}": F.length(c) > n for c, n in limits.items()}, key)


def decimal_overflow(df: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    checks = {
        f"decimal:{c}": F.col(c).isNotNull() & fn.serving_money(F.col(c)).isNull() for c in columns
    }
    return _violations(df, checks, key)


def unique_violations(df: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """(constraint_name, row_key, copies) for every key that occurs more than once.

    A key with a NULL part is never a duplicate, as in SQL.
    """
    filled = df
    for column in keys:
        filled = filled.where(F.col(column).isNotNull())
    return (
        filled.groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .select(F.lit(name or "unique:" + ",".join(keys)).alias("constraint_name"), row_key(keys).alias("row_key"), "copies")
    )


def foreign_key_orphans(fact: DataFrame, dims: dict[str, DataFrame], references: dict[str, str]) -> DataFrame:
    """(constraint_name, missing_key, lines) for fact keys without a dimension row.

    Lines are counted per key before anything is matched, so the match moves one
    row per distinct key however often a key is used.
    """
    keys = list(references)
    used = (
        fact.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(f"fk:{k}").alias("constraint_name"), F.col(k).cast("string").alias("missing_key"))
                        for k in keys
                    ]
                )
            ).alias("used")
        )
        .select("used.*")
        .where(F.col("missing_key").isNotNull())
        .groupBy("constraint_name", "missing_key")
        .agg(F.count("*").alias("lines"))
    )
    known = None
    for key in keys:
        members = dims[references[key]].select(
            F.lit(f"fk:{key}").alias("constraint_name"), F.col(key).cast("string").alias("missing_key")
        )
        known = members if known is None else known.unionByName(members)
    return absent_from(used, known, ["constraint_name", "missing_key"])


def foreign_key_accepted(fact: DataFrame, dims: dict[str, DataFrame], references: dict[str, str]) -> DataFrame:
    """Fact rows whose every key has a dimension row."""
    rows = fact
    for key, name in references.items():
        rows = rows.join(dims[name].select(key), key, "left_semi")
    return rows.select(*fact.columns)


BROKEN = "broken_constraint"


def first_broken(df: DataFrame, spec: TableSpec) -> Column:
    """Name of the first per-row constraint that a row breaks, NULL for none (columns the rows lack are not checked)."""
    checks = [(f"not_null:{c}", F.col(c).isNull()) for c in spec.not_null if c in df.columns]
    checks += [(f"varchar:{c}", F.length(c) > n) for c, n in spec.max_length.items() if c in df.columns]
    checks += [
        (f"decimal:{c}", F.col(c).isNotNull() & fn.serving_money(F.col(c)).isNull()) for c in spec.money if c in df.columns
    ]
    return F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks], F.lit(None).cast("string"))


def acceptable(df: DataFrame, spec: TableSpec) -> Column:
    """Whether a row meets the table's per-row constraints (columns the rows lack are not checked)."""
    return first_broken(df, spec).isNull()


def with_broken(df: DataFrame, spec: TableSpec, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """Add the first constraint each row breaks: its own ones, then, given the dimensions, its references.

    Every row comes back once: references are left joins to keys that are unique in their dimension.
    """
    broken = first_broken(df, spec)
    if dims is None:
        return with_computed(df, BROKEN, broken)
    rows, orphans = df, []
    for key, name in spec.references.items():
        known = f"_known_{key}"
        rows = rows.join(dims[name].select(key, F.lit(True).alias(known)), key, "left")
        orphans.append(F.when(F.col(known).isNull(), F.lit(f"fk:{key}")))
    return with_computed(rows, BROKEN, F.coalesce(broken, *orphans)).select(*df.columns, BROKEN)


def split_broken(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that break nothing, without the tag, and the others with it."""
    return tagged.where(F.col(BROKEN).isNull()).drop(BROKEN), tagged.where(F.col(BROKEN).isNotNull())


def with_defaults(df: DataFrame, clock: str = "processed_at") -> DataFrame:
    """Fill in the column default of a load that omits the processing time."""
    return df if clock in df.columns else df.withColumn(clock, F.current_timestamp())


def to_serving(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows in the table's declared column types and order."""
    filled = with_defaults(df) if "processed_at" in spec.schema.names else df
    return filled.select(
        *[
            (fn.serving_money(F.col(f.name)) if f.name in spec.money else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in spec.schema.fields
            if f.name in filled.columns
        ]
    )
