"""Session settings, sizing helpers and the shared work folder."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on (time zone) or that keep plans healthy at scale.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stream state on local disk with checkpoints, instead of in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Commit the changes of a batch, not whole snapshots, and skip the read that only counts rows.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Datasets and work tables are mostly keys and repeated text.
    "spark.sql.parquet.compression.codec": "zstd",
    # A scanned file's rows are sorted by partition before they are written: no more at once than memory takes.
    "spark.sql.files.maxPartitionBytes": "32m",
    # What a job shuffled goes when it ends, not when the driver happens to collect its garbage; a plan that is run
    # again makes its shuffles again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024
STORED_BYTES_PER_SHUFFLE_PARTITION = 16 * 1024 * 1024  # stored tables are compressed; their rows take many times that
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024

_local_work_roots: dict[str, str] = {}


def prepare(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply ``SESSION_CONF`` and, when the input size is known, size the shuffles for it.

    The shuffle width is only ever raised: adaptive execution merges what turns
    out small, but it cannot split a partition that was planned too wide.
    """
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    if input_bytes:
        wanted = shuffle_partitions(input_bytes, STORED_BYTES_PER_SHUFFLE_PARTITION)
        current = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
        if wanted > current:
            spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return spark


def shuffle_partitions(input_bytes: int, per_partition: int = BYTES_PER_SHUFFLE_PARTITION) -> int:
    """Number of shuffle partitions that keeps each near ``per_partition`` bytes."""
    return max(1, math.ceil(input_bytes / per_partition))


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path objects for ``path`` (local, HDFS or object store)."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place at once, over one that is there."""
    fs, target = file_system(spark, path)
    draft = file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
    fs.mkdirs(target.getParent())
    stream = fs.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"cannot write {path}")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path``; 0 when it does not exist."""
    fs, hadoop_path = file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast bound in bytes (negative means never)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_BROADCAST_BYTES)).strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = text.rstrip("b")
    if digits and digits[-1] in units:
        return int(digits[:-1]) * units[digits[-1]]
    return int(digits)


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a single-machine session may fall back to a local temporary folder;
    on a cluster the setting is required because executors come and go.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_work_roots:
        folder = tempfile.mkdtemp(prefix="run-tillworks-")
        context.setCheckpointDir(folder)
        _local_work_roots[context.applicationId] = folder
    return _local_work_roots[context.applicationId]


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the work root, never reused."""
    return f"{work_root(spark).rstrip('/')}/tillworks/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the work folder and read it back.

    Used where several branches read one result: the branches then scan narrow
    Parquet columns instead of recomputing it, the copy outlives lost executors,
    and its known size lets Spark decide on broadcasts by itself. Inside a
    ``scratch`` block the copy goes with the block, else with the work folder.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    for paths in _scratch_paths[-1:]:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """``stored`` rows in buckets by the hash of ``keys``: joins of such copies on just these keys move no row.

    As many buckets as a shuffle has partitions at first, so rows that come from an aggregate or a join on the same
    keys, or from such a copy, lie right already and leave a file or two a bucket. The catalog knows the buckets
    while the copy is opened, and forgets the name; the files stay in the work folder.
    """
    path = work_dir(df.sparkSession, label)
    for paths in _scratch_paths[-1:]:
        paths.append(path)
    return _in_buckets(df, path, keys)


def _in_buckets(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    spark, name = df.sparkSession, f"tillworks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, *keys).option("path", path).saveAsTable(name, format="parquet")
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


ROWS_PER_FILE = 1_000_000


def in_few_files(df: DataFrame, rows: int, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Rows for a small table in as many tasks as its number of rows calls for, but a task per core at least.

    For results of a known bound that come in many nearly empty partitions, where adaptive execution does not
    merge them: each would leave a file of its own. Never raises the number of tasks.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / rows_per_file)))


_scratch_paths: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is ``stored`` in a block at its end, also when it fails.

    For steps whose result is written elsewhere within the block: what the block
    returned and did not write can't be read any more.
    """
    _scratch_paths.append([])
    try:
        yield
    finally:
        for path in _scratch_paths.pop():
            fs, folder = file_system(spark, path)
            fs.delete(folder, True)


@contextmanager
def staged(df: DataFrame, label: str, keys: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``stored`` rows, or with ``keys`` ``stored_by`` them, for the length of a block, whose end deletes them."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    try:
        if keys:
            yield _in_buckets(df, path, keys)
        else:
            df.write.parquet(path)
            yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, folder = file_system(spark, path)
        fs.delete(folder, True)
