"""Stream to bronze: the ingest operators on micro-batches, with dead letters kept."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tillworks.layout import Layout
from tillworks.operators import ingest
from tillworks.session import write_text
from tillworks.sources.bronze import write_bronze, write_lines


def prepared(messages: DataFrame, ingested_at: Column | None = None, value: str = "value") -> DataFrame:
    """Messages with lineage and their missing fields; no rows dropped, no state."""
    lines = messages.transform(ingest.with_message, value).transform(ingest.with_missing_fields)
    return ingest.stamp(lines, ingested_at)


def dead_letter_line(df: DataFrame) -> DataFrame:
    """A rejected message with its reason, as one JSON line."""
    letter = F.struct(
        ingest.REASON, ingest.MISSING, ingest.MESSAGE, F.col("ingested_at").cast("string").alias("ingested_at")
    )
    return df.withColumn("line", F.to_json(letter))


def landing_writer(layout: Layout, source: str, one_instant: bool = False) -> Callable[[DataFrame, int], None]:
    """Batch handler landing accepted lines and dead letters.

    ``source`` names the checkpoint the batch numbers belong to. A batch that is
    run again after a failure has the same number and the same clock, so it
    replaces its own folders, and its counts, which are observed while it is landed
    and stored before it counts as done (``batch_metrics``). ``one_instant`` says that all lines of a batch have the
    same clock, and so lie in one day: then they are written where they were read, in files by their number.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        name, seen = f"{source}-{batch_id:010d}", Observation()
        # Observed before the rows are kept, so each is counted once however many writes follow.
        kept = batch.observe(seen, *ingest.metric_columns()).persist()
        try:
            kept.count()
            counts = {"source": source, "batch": batch_id, **seen.get}
            landed = counts["accepted"] if one_instant else None
            letters = counts["messages"] - counts["accepted"] if one_instant else None
            write_bronze(ingest.accepted(kept), layout.bronze, name, landed)
            write_lines(dead_letter_line(ingest.rejected(kept)), layout.dead_letter, "line", "ingested_at", name, letters)
            write_text(kept.sparkSession, f"{layout.batch_metrics}/{name}.json", json.dumps(counts))
        finally:
            kept.unpersist()

    return land


def batch_metrics(spark: SparkSession, layout: Layout) -> DataFrame:
    """``source, batch, messages, accepted, incomplete, malformed`` of every landed batch."""
    counts = ", ".join(f"{name} bigint" for name in ingest.METRICS)
    return spark.read.schema(f"source string, batch bigint, {counts}").json(layout.batch_metrics)


def start_bronze_stream(
    messages: DataFrame,
    layout: Layout,
    source: str = "sales",
    ingested_at: Column | None = None,
    available_now: bool = True,
    every: str = "1 second",
) -> StreamingQuery:
    """Start landing a message stream; the checkpoint remembers the position between runs.

    ``source`` names both checkpoint and batches: give a stream that starts over
    with a new checkpoint a new name, or it would replace the old batches.
    """
    writer = (
        prepared(messages, ingested_at)
        .writeStream.foreachBatch(landing_writer(layout, source, one_instant=ingested_at is None))
        .option("checkpointLocation", layout.checkpoint(source))
        .queryName(f"bronze-{source}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def run_bronze_stream(messages: DataFrame, layout: Layout, **options) -> None:
    """Land everything available now and stop."""
    start_bronze_stream(messages, layout, **options).awaitTermination()
