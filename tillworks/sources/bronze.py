"""Bronze: message sources, and newline-delimited JSON by ingestion day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.layout import day_columns, day_folder, day_from_path
from tillworks.operators.ingest import MESSAGE, STRICT_JSON, bronze_line
from tillworks.schemas import DAY_COLUMNS, RAW_WITH_CORRUPT
from tillworks.session import file_system, staged
from tillworks.sources.lake import day_paths

BATCH = "batch"
MERGED = "_merged"  # in a compacted batch: the batches it holds; readers skip names with an underscore
_PARTITIONS = [T.StructField(name, T.StringType()) for name in (*DAY_COLUMNS, BATCH)]
BRONZE = T.StructType([*RAW_WITH_CORRUPT.fields, *_PARTITIONS])


def landing_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream of lines (column ``value``) from files dropped into a folder, oldest first."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """Stream of message bytes (column ``value``) from a Kafka topic, from its oldest record.

    Needs Spark's Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("value")


LINES_PER_FILE = 250_000


def write_lines(df: DataFrame, root: str, line: str, ingested_at: str, batch: str, lines: int | None = None) -> None:
    """Write one text column by ingestion day, as the named batch.

    Each batch owns its folders, so a batch that is written again replaces
    itself and nothing else. An empty batch writes no file. Files are gzip, a tenth of the text. ``lines`` is for
    a batch of one instant, whose number of lines is known: its tasks are merged to files of ``LINES_PER_FILE``, and
    no line moves. Other batches are rebalanced by day.
    """
    rows = df.select(F.col(line).alias("value"), *[c.alias(n) for n, c in day_columns(F.col(ingested_at)).items()])
    placed = rows.hint("rebalance", *DAY_COLUMNS) if lines is None else rows.coalesce(max(1, -(-lines // LINES_PER_FILE)))
    (
        placed.withColumn(BATCH, F.lit(batch))
        .write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", compression="gzip")
        .partitionBy(*DAY_COLUMNS, BATCH)
        .text(root)
    )


def write_bronze(stamped: DataFrame, root: str, batch: str, lines: int | None = None) -> None:
    """Land accepted, stamped messages; ``lines`` as for ``write_lines``."""
    stamped = stamped.withColumn(
        "line", bronze_line(F.col(MESSAGE), F.col("ingested_at"), F.col("source_system"))
    )
    write_lines(stamped, root, "line", "ingested_at", batch, lines)


def scan_bronze(spark: SparkSession, root: str, day: date | None = None, days: Sequence[date] = ()) -> DataFrame:
    """Raw fields as text plus the partition columns.

    With ``day`` or ``days`` only their folders are opened and listed; a day that is not there has no rows.
    """
    reader = spark.read.schema(BRONZE).options(**STRICT_JSON)
    wanted = [*days, *([] if day is None else [day])]
    if not wanted:
        return reader.json(root)
    paths = day_paths(spark, root, wanted)
    return reader.option("basePath", root).json(paths) if paths else spark.createDataFrame([], BRONZE)


def scan_lines(spark: SparkSession, root: str, day: date) -> DataFrame:
    """The JSON lines of a day as they are (column ``value``), fields that are not declared included."""
    paths = day_paths(spark, root, [day])
    return spark.read.text(paths).select("value") if paths else spark.createDataFrame([], "value string")


def compact_day(spark: SparkSession, root: str, day: date, into: str = "compacted") -> int:
    """Merge a closed day's batches into one batch of evenly sized files; returns the batches merged.

    The lines are first written to the work folder, then put in the batch ``into``, and the folders of the
    old batches go last: a run that breaks off in between is completed by the next, which finds the lines
    of the old batches in the compacted one's list and does not take them twice.
    """
    folder = f"{root}/{day_folder(day)}"
    fs, path = file_system(spark, folder)
    if not fs.exists(path):
        return 0
    target = f"{folder}/{BATCH}={into}"
    batches = [s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith(f"{BATCH}=")]
    listed = _merged_batches(spark, target)
    old = [b for b in batches if b != f"{BATCH}={into}"]
    new = [b for b in old if b not in listed]
    if new:
        lines = spark.read.text([f"{folder}/{b}" for b in ([*new, f"{BATCH}={into}"] if listed else new)])
        with staged(lines.select("value"), "compact") as kept:
            swap = f"{root}_compact/{day_folder(day)}"
            kept.hint("rebalance").write.mode("overwrite").option("compression", "gzip").text(swap)
            names = spark.createDataFrame([(b,) for b in sorted(listed | set(new))], "value string")
            names.coalesce(1).write.mode("overwrite").text(f"{swap}/{MERGED}")
            fs.delete(file_system(spark, target)[1], True)
            fs.rename(file_system(spark, swap)[1], file_system(spark, target)[1])
    for batch in old:
        fs.delete(file_system(spark, f"{folder}/{batch}")[1], True)
    return len(old)


def _merged_batches(spark: SparkSession, target: str) -> set[str]:
    fs, path = file_system(spark, f"{target}/{MERGED}")
    return {row[0] for row in spark.read.text(f"{target}/{MERGED}").collect()} if fs.exists(path) else set()  # names only


def scan_bronze_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw fields of files given by leaf path; the day is taken from each file's own path."""
    lines = spark.read.schema(RAW_WITH_CORRUPT).options(**STRICT_JSON).json(path)
    return lines.withColumns(day_from_path(F.col("_metadata.file_path")))
