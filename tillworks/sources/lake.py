"""Parquet datasets by day: scans that prune, and writes that replace a day at once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.layout import day_columns, day_folder
from tillworks.schemas import DAY_COLUMNS
from tillworks.session import file_system
from tillworks.sources import versions

_DAY_FIELDS = [T.StructField(name, T.StringType()) for name in DAY_COLUMNS]
_DAYS = "/".join(f"{name}=*" for name in DAY_COLUMNS)


def day_paths(spark: SparkSession, root: str, days: Sequence[date]) -> list[str]:
    """Folders of the given days that exist; the other days of the dataset are not listed."""
    paths = [f"{root}/{day_folder(day)}" for day in days]
    found = []
    for path in paths:
        fs, folder = file_system(spark, path)
        if fs.exists(folder):
            found.append(path)
    return found


def scan_days(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    day: date | None = None,
    partitions: Sequence[str] = (),
) -> DataFrame:
    """Rows of a by-day dataset with its day (and further text partition) columns.

    Of every day the version that counts is opened. For one ``day`` its folder alone is listed; a day, or a
    dataset, that is not there has no rows.
    """
    extra = [T.StructField(name, T.StringType()) for name in partitions]
    plain = [f for f in schema.fields if f.name not in partitions]
    full = T.StructType([*plain, *_DAY_FIELDS, *extra])
    if day is None:
        paths = list(versions.current_parts(spark, root, _DAYS).values())
    else:
        path = versions.current(spark, f"{root}/{day_folder(day)}")
        paths = [path] if path else []
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", root).parquet(*paths).select(*full.names)


def write_day(df: DataFrame, root: str, day: date, partitions: Sequence[str] = (), laid_out: bool = False) -> str:
    """Replace one day, also when there is nothing left to write.

    The rows become the day's next version, which counts once it is complete; until then, and for readers that
    have started, the old one stays. Rows are rebalanced first: files of even size, however many tasks made them.
    ``laid_out=True`` is for rows whose tasks are even and few already; a task then writes what it has, and no row moves.
    """
    spark, folder = df.sparkSession, f"{root}/{day_folder(day)}"
    versions.finish_pending(spark, root)
    path = versions.path_of(folder, versions.following(spark, folder))
    rows = df.drop(*DAY_COLUMNS)
    if not laid_out:
        rows = rows.hint("rebalance", *[F.col(c) for c in partitions]) if partitions else rows.hint("rebalance")
    writer = rows.write.partitionBy(*partitions) if partitions else rows.write
    writer.parquet(path)
    versions.mark(spark, path)
    versions.expire(spark, folder)
    return path


def stage_days(df: DataFrame, root: str, partitions: Sequence[str] = (), laid_out: bool = False) -> set[str]:
    """Write rows beside the dataset, by their day columns, and return the days found; nothing is replaced yet.

    Rows are rebalanced first, so a day gets files of even size and a day with most of the rows is split
    over several tasks. ``laid_out=True`` is for rows that come from the scan of a dataset by day without a
    shuffle: its files are such already, and a task writes the few days that it reads.
    """
    spark, columns = df.sparkSession, [*DAY_COLUMNS, *partitions]
    versions.finish_pending(spark, root)
    rows = df if laid_out else df.hint("rebalance", *[F.col(c) for c in columns])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*columns).parquet(versions.waiting(root))
    return versions.waiting_parts(spark, root, _DAYS)


def overwrite_days(
    df: DataFrame, root: str, days: Sequence[date] = (), partitions: Sequence[str] = (), laid_out: bool = False
) -> None:
    """Replace every day found in the rows' day columns, in one job.

    ``days`` lists the days the load covers: those without rows are emptied. Each day changes at once; a load
    that breaks off before all rows are written changes none, and later is finished by the next write.
    ``laid_out`` as for ``stage_days``.
    """
    filled = stage_days(df, root, partitions, laid_out)
    emptied = {day_folder(day) for day in days} - filled
    versions.replace_parts(df.sparkSession, root, filled, sorted(emptied))


def with_day(df: DataFrame, instant: str) -> DataFrame:
    """Add the day columns of a timestamp column."""
    return df.withColumns(day_columns(F.col(instant)))
