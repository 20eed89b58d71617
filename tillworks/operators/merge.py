"""Upserts with a policy per column, insert-if-absent, in-batch duplicates, surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which of several sales rows for one key is the latest: greatest in this order.
SALES_ORDER = ("sale_timestamp", "processed_at", "total_price", "quantity", "store_id")


def _ordered(columns: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """Deciding columns first, then the rest, so that ties leave nothing to chance."""
    lead = [c for c in order if c in columns and c not in keys]
    return lead + [c for c in columns if c not in keys and c not in lead]


def one_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    pick: str = "latest",
    on_duplicate: str = "resolve",
) -> DataFrame:
    """One row per key: the greatest (``latest``) or least (``first``) row in ``order``.

    NULLs sort below every value. The aggregate keeps one candidate per key in
    each map task, so a key repeated in a third of all rows never meets in one
    task. ``on_duplicate="error"`` makes the job fail on a repeated key, as a
    database refuses to update a row twice in one statement.
    """
    ranked = _ordered(df.columns, keys, order)
    best = F.max if pick == "latest" else F.min
    aggregates = [best(F.struct(*ranked)).alias("_row")] if ranked else []
    if on_duplicate == "error" or not ranked:
        aggregates.append(F.count("*").alias("_copies"))
    chosen = df.groupBy(*keys).agg(*aggregates)
    if on_duplicate == "error":
        repeated = F.concat(F.lit("duplicate key in batch: "), F.to_json(F.struct(*keys)))
        chosen = chosen.where(F.when(F.col("_copies") > 1, F.raise_error(repeated).cast("boolean")).otherwise(True))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = SALES_ORDER) -> DataFrame:
    return one_per_key(df, keys, order)


def absent_from(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not have.

    Written as an outer join: Spark would push an anti join below the aggregate
    that made the rows distinct, and match every raw line instead of every key.
    """
    known = target.select(*keys, F.lit(True).alias("_known"))
    return rows.join(known, list(keys), "left").where(F.col("_known").isNull()).select(*rows.columns)


def _merged_columns(target_columns: Sequence[str], staging_columns: Sequence[str], keys, update) -> list[Column]:
    """Output columns over a join of ``old`` and ``new`` row structs (NULL struct = absent).

    Presence decides, never the value: a NULL in the batch overwrites.
    """
    old, new = F.col("old"), F.col("new")
    out = []
    for name in target_columns:
        if name in keys:
            out.append(F.col(name))
        elif name not in staging_columns:
            out.append(old[name].alias(name))
        elif name in update:
            out.append(F.when(new.isNotNull(), new[name]).otherwise(old[name]).alias(name))
        else:
            out.append(F.when(old.isNotNull(), old[name]).otherwise(new[name]).alias(name))
    return out


def upsert(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    order: Sequence[str] = SALES_ORDER,
    on_duplicate: str = "resolve",
    small_batch: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Target rows after merging a batch on ``keys``.

    Matched rows take the batch's value in the ``update`` columns (default: all)
    and keep the target's in the rest; unmatched batch rows are added whole.
    Columns the batch lacks stay as they are, or NULL in new rows.

    The default joins both sides once, full outer. ``small_batch=True`` is for a
    batch whose stored size was checked against the broadcast bound: it is then
    written so that Spark can broadcast the batch and leave the target in place.
    ``unique=True`` says the batch holds each key once and spares the check.
    """
    keys = list(keys)
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    update = set(rest if update is None else update)
    batch = staging if unique else one_per_key(staging, keys, order, on_duplicate=on_duplicate)
    given = [c for c in rest if c in batch.columns]
    # The flag keeps the structs non-NULL even when no other column is given.
    old = target.select(*keys, F.struct(F.lit(True).alias("_present"), *rest).alias("old"))
    new = batch.select(*keys, F.struct(F.lit(True).alias("_present"), *given).alias("new"))
    out = _merged_columns(columns, given, keys, update)
    if not small_batch:
        return old.join(new, keys, "full_outer").select(*out)
    kept_or_updated = old.join(new, keys, "left").select(*out)
    matched = target.select(*keys).join(batch.select(*keys), keys, "left_semi")
    fresh = absent_from(batch, matched, keys)
    added = fresh.select(
        *[F.col(c) if c in fresh.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in columns]
    )
    return kept_or_updated.unionByName(added)


def insert_absent(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Target rows untouched, plus the batch rows whose key is new.

    Of several batch rows for one key the first in ``order`` is taken;
    ``unique=True`` says there are none and spares the check.
    """
    keys = list(keys)
    batch = staging.select(*target.columns)
    if not unique:
        batch = one_per_key(batch, keys, order, pick="first")
    return target.unionByName(absent_from(batch, target, keys))


def assign_key(rows: DataFrame, target: DataFrame, key: str = "sale_key") -> DataFrame:
    """Number the rows that have no surrogate key yet, above every key in use.

    Keys are unique with gaps, like a database sequence. They depend on how
    Spark splits the rows, so write the result once and read it from there.
    """
    highest = target.agg(F.coalesce(F.max(key), F.lit(0).cast("bigint"))).scalar()
    fresh = highest + F.lit(1) + F.monotonically_increasing_id()
    if key not in rows.columns:
        return rows.select(fresh.alias(key), *rows.columns)
    return rows.withColumn(key, F.coalesce(F.col(key), fresh))
