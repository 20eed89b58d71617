"""Stream-to-bronze record handling: decode, required fields, lineage, dead letters.

The functions hold no state and no actions, so they serve a static and a
streaming DataFrame alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.functions import with_computed
from tillworks.schemas import CORRUPT_FIELD, LINEAGE_FIELDS, RAW_WITH_CORRUPT, REQUIRED_FIELDS

MESSAGE = "message"
MISSING = "missing_fields"
REASON = "reject_reason"
MALFORMED_REASON = "malformed"
MISSING_REASON = "missing_fields"
SOURCE_SYSTEM = "kinesis_producer"  # fixed value: the lineage constant of streamed lines


def message_text(df: DataFrame, value: str = "value") -> Column:
    """A message column as JSON text: text and bytes as they are, structs rendered."""
    dtype = df.schema[value].dataType
    if isinstance(dtype, (T.StructType, T.MapType)):
        return F.to_json(F.col(value), {"ignoreNullFields": "false"})
    return F.col(value).cast("string")


def with_message(df: DataFrame, value: str = "value") -> DataFrame:
    """Replace the source's value column by its text as ``message``."""
    return df.select(*[c for c in df.columns if c != value], F.rtrim(message_text(df, value)).alias(MESSAGE))


#: How every message and bronze line is read: JSON as its standard has it.
STRICT_JSON = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_FIELD,
    "allowSingleQuotes": "false",
    "allowUnquotedControlChars": "false",
}


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON messages into the raw text fields plus the unreadable text, if any."""
    parsed = F.from_json(message_text(df, value), RAW_WITH_CORRUPT, STRICT_JSON)
    others = [c for c in df.columns if c != value]
    return df.select(*others, parsed.alias("record")).select(*others, "record.*")


def with_missing_fields(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Add the sorted required fields a message lacks; NULL when it is not one JSON object.

    Only presence counts: a field holding JSON null is present. The untouched
    text is parsed with the bronze scan's options, so nothing is accepted that
    could not be read back. Line breaks then stand only between JSON tokens,
    where they carry no meaning; accepted messages get spaces for them, as a
    record is one line of the bronze files.
    """
    wanted = F.array(*[F.lit(name) for name in sorted(required)])
    message = F.col(MESSAGE)
    # json_object_keys reads the first value only; as the one element of an array
    # the whole text must hold up, which shows anything after the record.
    one_record = F.json_array_length(F.concat(F.lit("["), message, F.lit("]"))) == 1
    parsed = F.from_json(message, T.StructType([T.StructField(CORRUPT_FIELD, T.StringType())]), STRICT_JSON)
    sound = message.startswith("{") & message.endswith("}") & one_record & parsed[CORRUPT_FIELD].isNull()
    keys = F.when(sound, F.json_object_keys(message))
    checked = with_computed(df, MISSING, F.array_except(wanted, keys))
    breaks = message.contains("\n") | message.contains("\r")
    line = F.when(F.col(MISSING).isNotNull() & breaks, F.regexp_replace(message, r"[\r\n]+", " ")).otherwise(message)
    return checked.withColumn(MESSAGE, line)


def accepted(df: DataFrame) -> DataFrame:
    """Messages with every required field."""
    return df.where(F.size(MISSING) == 0).drop(MISSING)


def rejected(df: DataFrame) -> DataFrame:
    """Messages that fail at ingest, with the reason; nothing is lost silently."""
    reason = F.when(F.col(MISSING).isNull(), F.lit(MALFORMED_REASON)).otherwise(F.lit(MISSING_REASON))
    return df.where(F.col(MISSING).isNull() | (F.size(MISSING) > 0)).withColumn(REASON, reason)


def stamp(df: DataFrame, ingested_at: Column | None = None, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """Add the lineage columns; the clock is a parameter for replays and tests."""
    return df.withColumns(
        {
            "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
            "source_system": F.lit(source_system),
        }
    )


def bronze_line(message: Column, ingested_at: Column, source_system: Column) -> Column:
    """The message with its lineage appended as two more JSON fields.

    Working on the text keeps unknown fields and the exact form of numbers. A
    later field of the same name wins when the line is read back.
    """
    lineage = F.to_json(
        F.struct(
            F.date_format(ingested_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias(LINEAGE_FIELDS[0]),
            source_system.alias(LINEAGE_FIELDS[1]),
        )
    )
    return F.concat(F.substr(message, F.lit(1), F.length(message) - 1), F.lit(","), F.substr(lineage, F.lit(2)))


def encode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as JSON lines, NULL fields written out."""
    fields = F.struct(*(columns or df.columns))
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("line"))


def missing_field_report(df: DataFrame) -> DataFrame:
    """How many messages lack each field; a message lacking two fields counts for both."""
    return (
        df.where(F.size(MISSING) > 0)
        .select(F.explode(MISSING).alias("field"))
        .groupBy("field")
        .agg(F.count("*").alias("messages"))
    )


METRICS = ("messages", "accepted", "incomplete", "malformed")


def metric_columns() -> list[Column]:
    """Messages read, accepted, and skipped by cause, to be aggregated or observed."""
    counts = (F.count("*"), F.count_if(F.size(MISSING) == 0), F.count_if(F.size(MISSING) > 0), F.count_if(F.col(MISSING).isNull()))
    return [count.alias(name) for name, count in zip(METRICS, counts)]


def ingest_metrics(df: DataFrame) -> DataFrame:
    """The counts of all messages, in one pass."""
    return df.agg(*metric_columns())


def late_arrivals(df: DataFrame, event_time: str, ingested_at: str = "ingested_at") -> DataFrame:
    """Rows stored under another day than the one they happened on."""
    event_day, ingest_day = F.to_date(event_time), F.to_date(ingested_at)
    return df.where(event_day != ingest_day).withColumns(
        {
            "event_day": event_day,
            "ingest_day": ingest_day,
            "days_late": F.datediff(ingest_day, event_day),
        }
    )


def repartition_by_basket(
    df: DataFrame, basket: str = "transaction_id", line: str = "product_id", spread: int = 1, partitions: int | None = None
) -> DataFrame:
    """Bring the lines of a basket together, as the stream's partition key does.

    Rows without a basket belong together with nobody and are spread by their
    content. ``spread`` is the number of partitions every basket may take, by
    line identity; with 1, a basket stays whole. Without ``partitions`` the
    session sizes the shuffle.
    """
    part = F.when(F.col(basket).isNull(), F.xxhash64(*df.columns)).otherwise(F.pmod(F.xxhash64(line), F.lit(spread)))
    placed = df.withColumn("_part", part)
    sized = placed.repartition(basket, "_part") if partitions is None else placed.repartition(partitions, basket, "_part")
    return sized.drop("_part")
