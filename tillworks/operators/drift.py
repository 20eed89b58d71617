"""Fields that JSON lines really hold, against the declared ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.schemas import LINEAGE_FIELDS, REQUIRED_FIELDS

# What the producer sends and the stream adds; everything but these numbers is text.
NUMBERS = ("quantity", "unit_price", "total_price")
DECLARED_KINDS = {name: "number" if name in NUMBERS else "text" for name in (*REQUIRED_FIELDS, *LINEAGE_FIELDS)}

NEW, MISSING, CHANGED, AS_DECLARED = "new", "missing", "changed", "declared"
_KINDS = {"number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "text": ("STRING",), "boolean": ("BOOLEAN",), "null": ("VOID",),
          "object": ("OBJECT",), "array": ("ARRAY",)}


def kind_of(variant_type: Column) -> Column:
    """Kind of JSON value behind the name of a variant's type; ``mixed`` where types have nothing in common."""
    name = F.regexp_extract(variant_type, "^[A-Z]+", 0)
    return F.coalesce(*[F.when(name.isin(*names), F.lit(kind)) for kind, names in _KINDS.items()], F.lit("mixed"))


def fields_found(lines: DataFrame, value: str = "value") -> DataFrame:
    """``field, type, lines, nulls``: every top-level field of JSON objects, with the type that holds all its values.

    Types of two lines merge as Spark widens them, so the aggregate runs on the map side and its size follows
    the fields. Lines that aren't one JSON object, or name a field twice, have no fields.
    """
    spark = lines.sparkSession
    parsed = lines.select(F.try_parse_json(value).alias("_line"))
    objects = parsed.where(F.schema_of_variant("_line").startswith("OBJECT"))
    fields = objects.lateralJoin(spark.tvf.variant_explode(F.col("_line").outer())).select(F.col("key").alias("field"), F.col("value").alias("_value"))
    return fields.groupBy("field").agg(
        F.schema_of_variant_agg("_value").alias("type"),
        F.count("*").alias("lines"),
        F.count_if(F.is_variant_null("_value")).alias("nulls"),
    )


def schema_drift(lines: DataFrame, declared: Mapping[str, str] = DECLARED_KINDS, value: str = "value") -> DataFrame:
    """``field, kind, type, lines, nulls, status`` of the fields that lines hold or should hold.

    ``declared`` maps fields to kinds. The status says whether a field is new, missing from all lines, changed (of
    another kind; NULL alone is no change) or as declared.
    """
    spec = lines.sparkSession.createDataFrame(list(declared.items()), "field string, declared string")
    met = fields_found(lines, value).join(F.broadcast(spec), "field", "full_outer")  # a row per declared field
    kind = F.when(F.col("type").isNotNull(), kind_of(F.col("type")))
    status = (
        F.when(F.col("declared").isNull(), NEW)
        .when(F.col("type").isNull(), MISSING)
        .when((kind != F.col("declared")) & (kind != "null"), CHANGED)
        .otherwise(AS_DECLARED)
    )
    counts = {name: F.coalesce(name, F.lit(0).cast("bigint")) for name in ("lines", "nulls")}
    return met.withColumns({"kind": kind, "status": status, **counts}).select("field", "kind", "type", "lines", "nulls", "status")
