"""Serving tables: Parquet by sale period, merged in place period by period.

A merge rewrites the periods that hold a matched key or receive a batch row and leaves the others untouched.
Which periods may hold a matched key is told by key sketches: beside the rows of each period lie the 64-bit
hashes of its keys, which come and go with the period. A merge reads those, opens the periods they admit, and no
other; so besides eight bytes a key its cost follows the batch, not the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.operators.merge import SALES_ORDER, absent_from, one_per_key, upsert
from tillworks.operators.numbering import numbered
from tillworks.session import broadcast_limit, file_system, staged, stored_bytes
from tillworks.sources import versions

PERIOD = "sale_period"
PERIOD_FORMATS = {"day": "yyyyMMdd", "month": "yyyyMM"}
NO_PERIOD = "none"
KEY_SKETCH = "_keys"  # below a period's version; readers skip names with an underscore
_PERIODS = f"{PERIOD}=*"
_HIGHEST = "_highest."  # an empty file beside the rows; its name ends in the number

finish_pending = versions.finish_pending


def period_of(instant: str, grain: str = "month") -> Column:
    return F.coalesce(F.date_format(F.col(instant), PERIOD_FORMATS[grain]), F.lit(NO_PERIOD))


def read_table(spark: SparkSession, root: str, schema: T.StructType, periods: Sequence[str] | None = None) -> DataFrame:
    """Rows and their period; no rows before the first merge. With ``periods`` no other one is opened."""
    current = versions.current_parts(spark, root, _PERIODS)
    wanted = current if periods is None else [f"{PERIOD}={p}" for p in periods]
    return _opened(spark, root, schema, [current[part] for part in wanted if part in current])


def _opened(spark: SparkSession, root: str, schema: T.StructType, paths: list[str]) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(PERIOD, T.StringType())])
    if not paths:
        # The condition tells Spark's optimizer that there are no rows: joins with a new table need no shuffle.
        return spark.createDataFrame([], full).where(F.lit(False))
    return spark.read.schema(full).option("basePath", root).parquet(*paths).select(*full.names)


def recreate(spark: SparkSession, root: str) -> None:
    """Drop a table and begin it anew: no rows, and surrogate keys from 1 on."""
    versions.drop(spark, root)


def with_dates(facts: DataFrame, dates: DataFrame, grain: str = "month", date_key: str = "date_key") -> DataFrame:
    """Rows of a serving table with the attributes of their day.

    Days are joined through the period as well, which is a partition column: a condition on ``dates`` so chooses,
    when the query runs, the periods that are opened.
    """
    period = F.date_format("full_date", PERIOD_FORMATS[grain])
    return facts.join(dates.withColumn(PERIOD, period), [PERIOD, date_key])


def key_hash(keys: Sequence[str]) -> Column:
    """What a sketch holds of a key. Equal keys have equal hashes; of n and m different keys some n*m / 2**64 pairs have."""
    return F.xxhash64(*keys)


def _write_anew(df: DataFrame, path: str) -> None:
    """By period, with nothing left of an earlier try, whatever the session says of overwriting."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PERIOD).parquet(path)


def _sketch(spark: SparkSession, rows: str, schema: T.StructType, keys: Sequence[str], serial: str | None) -> None:
    """Put the key sketches of waiting periods into their folders, sorted, and note the highest surrogate keys."""
    waiting = spark.read.schema(T.StructType([*schema.fields, T.StructField(PERIOD, T.StringType())])).parquet(rows)
    hashes = waiting.select(PERIOD, F.col(PERIOD).alias("of"), key_hash(keys).alias("key_hash"))
    sketches = f"{rows}{KEY_SKETCH}"
    laid_out = hashes.hint("rebalance", F.col(PERIOD)).sortWithinPartitions(PERIOD, "key_hash")
    _write_anew(laid_out, sketches)
    for sketch in versions.found(spark, f"{sketches}/{_PERIODS}"):
        part = sketch.rpartition("/")[2]
        fs, source = file_system(spark, sketch)
        if not fs.rename(source, file_system(spark, f"{rows}/{part}/{KEY_SKETCH}")[1]):
            raise OSError(f"cannot move {sketch}")
    if serial:
        for period, highest in waiting.groupBy(PERIOD).agg(F.max(serial)).collect():  # a row per period
            fs, note = file_system(spark, f"{rows}/{PERIOD}={period}/{_HIGHEST}{highest or 0}")
            fs.create(note).close()
    fs, folder = file_system(spark, sketches)
    fs.delete(folder, True)


def _beside(spark: SparkSession, root: str, name: str) -> dict[str, str]:
    """What lies beside the rows of the current periods under a name pattern, by period; one call for all."""
    current = versions.current_parts(spark, root, _PERIODS)
    paths = versions.found(spark, f"{root}/{_PERIODS}/{versions.PREFIX}*/{name}")
    lying = {tuple(path.split("/")[-3:-1]): path for path in paths}  # by period and version
    return {part.partition("=")[2]: lying.get((part, path.rpartition("/")[2]), "") for part, path in current.items()}


def admitted_periods(spark: SparkSession, root: str, batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """Periods that may hold a key of the batch: those whose sketch shares a hash with it, and any without a sketch."""
    sketches = _beside(spark, root, KEY_SKETCH)
    admitted = [period for period, path in sketches.items() if not path]
    paths = [path for path in sketches.values() if path]
    if paths:
        hashes = spark.read.schema("of string, key_hash bigint").parquet(*paths)
        met = hashes.join(batch.select(key_hash(keys).alias("key_hash")), "key_hash", "left_semi").select("of").distinct()
        admitted += [row[0] for row in met.collect()]  # periods only
    return sorted(admitted)


def highest_number(spark: SparkSession, root: str, schema: T.StructType, serial: str) -> int:
    """The highest surrogate key in use, as noted beside the rows of each period; read from the rows where it is not."""
    notes = _beside(spark, root, f"{_HIGHEST}*")
    unnoted = [period for period, path in notes.items() if not path]
    highest = max((int(path.rpartition(_HIGHEST)[2]) for path in notes.values() if path), default=0)
    read = read_table(spark, root, schema, unnoted).agg(F.max(serial)).first()[0] if unnoted else None
    return max(highest, read or 0)


def merge_table(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    batch: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    instant: str = "sale_timestamp",
    grain: str = "month",
    order: Sequence[str] = SALES_ORDER,
    on_duplicate: str = "resolve",
    serial: str | None = None,
) -> list[str]:
    """Merge a batch into the table at ``root`` and return the periods rewritten.

    The new periods are first written beside the table, then moved in. Spark so
    never reads what it overwrites, and a merge broken off while replacing is
    completed by the next one. The batch is staged in buckets by its keys, as its deduplication leaves it, so of the
    joins with it only the other side moves.
    A batch's columns take the table's types. ``serial`` names a surrogate key: rows that are new get the next whole numbers, without gaps, in the
    order of their keys; other rows keep theirs.
    """
    keys = list(keys)
    finish_pending(spark, root)
    typed = {c: F.col(c).cast(schema[c].dataType) for c in batch.columns if c in schema.names}  # hashes tell types apart
    with staged(one_per_key(batch.withColumns(typed), keys, order, on_duplicate=on_duplicate), "batch", keys) as rows:
        opened = read_table(spark, root, schema, admitted_periods(spark, root, rows, keys))
        matches = opened.select(*keys, PERIOD).join(rows.select(*keys), keys, "left_semi")
        with staged(matches, "matches", keys) as matched:
            if not serial:
                return _merge_staged(spark, root, schema, rows, matched, keys, update, instant, grain)
            highest = highest_number(spark, root, schema, serial)
            fresh = absent_from(rows.select(*keys), matched.select(*keys), keys)
            with numbered(fresh, keys, serial, after=highest) as numbers:
                kept = [c for c in (schema.names if update is None else update) if c not in (serial, *keys)]
                return _merge_staged(spark, root, schema, rows, matched, keys, kept, instant, grain, serial, numbers)


def _merge_staged(spark, root, schema, rows, matched, keys, update, instant, grain, serial=None, numbers=None) -> list[str]:
    small = sum(stored_bytes(spark, f) for f in rows.inputFiles()) <= broadcast_limit(spark)
    arriving = rows.select(period_of(instant, grain).alias(PERIOD))
    met = matched.select(PERIOD).distinct().union(arriving.distinct()).distinct().collect()  # periods only
    touched = sorted(row[0] for row in met)
    if not touched:
        return []
    target = read_table(spark, root, schema, touched).select(*schema.names)
    ready = rows if numbers is None else rows.join(numbers, keys, "left")
    merged = upsert(target, ready, keys, update, small_batch=small, unique=True)
    laid_out = (
        merged.withColumn(PERIOD, period_of(instant, grain)).hint("rebalance", F.col(PERIOD)).sortWithinPartitions(PERIOD, instant)
    )
    waiting = versions.waiting(root)
    _write_anew(laid_out, waiting)
    filled = versions.waiting_parts(spark, root, _PERIODS)
    if filled:
        _sketch(spark, waiting, schema, keys, serial)
    versions.replace_parts(spark, root, filled, [f"{PERIOD}={p}" for p in touched if f"{PERIOD}={p}" not in filled])
    return touched
