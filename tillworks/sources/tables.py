"""Sales lines read from the order tables (lineitem, orders, customer, part, supplier).

The tables are clean, so a share of keys, prices and dates is made faulty by key
to exercise every rule. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.schemas import REQUIRED_FIELDS


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by name; its footer is read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _broken(key: str, every: int):
    return F.col(key) % every == 0


def sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales line per lineitem, typed, with the faults in place.

    Customers are joined to orders before the lines are, so that the segment
    travels with one row per order instead of one per line. Lines and orders both
    grow with the data, so they are merged, never broadcast; of an inner join's
    size Spark knows so little that it would take the lines for the small side.
    """
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    price = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity") + 0.5) / 100
    total = F.floor(price * F.col("l_quantity") * 100 + 0.5) / 100
    return lines.select(
        F.when(~_broken("l_orderkey", 211), F.concat(F.lit(" T"), F.col("l_orderkey").cast("string"), F.lit(" "))).alias(
            "transaction_id"
        ),
        F.when(~_broken("l_partkey", 199), F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit(" "), F.lower("p_type")).alias("category"),
        F.when(_broken("l_orderkey", 97), F.lit(0.0)).otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(_broken("l_orderkey", 89), F.lit(-1.0)).otherwise(price).alias("unit_price"),
        F.when(_broken("l_orderkey", 83), F.lit(None))
        .when(_broken("l_orderkey", 53), F.col("l_extendedprice"))
        .otherwise(total)
        .alias("total_price"),
        F.when(~_broken("l_suppkey", 47), F.lower("s_name")).alias("store_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("c_mktsegment").alias("client_type"),
        F.when(~_broken("l_orderkey", 101), F.col("o_orderdate")).cast("timestamp").alias("sale_ts"),
        F.col("l_shipdate").cast("timestamp").alias("ship_ts"),
        "l_orderkey",
    )


def iso_text(instant: str):
    """A timestamp as the producer writes it: ISO-8601 with microseconds and offset."""
    return F.date_format(F.col(instant), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def raw_lines(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The eleven raw fields as text, as a bronze scan returns them."""
    texts = {"timestamp": iso_text("sale_ts")}
    return events.select(*[texts.get(f, F.col(f)).cast("string").alias(f) for f in REQUIRED_FIELDS if f != "timestamp"],
                         texts["timestamp"].alias("timestamp"), *carry)


def messages(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each line as a JSON message (column ``value``).

    Lines of odd orders leave NULL fields out, lines of even orders write them
    as null; the messages of every 61st order are cut off before their end.
    """
    line = F.struct(*[F.col(f) for f in REQUIRED_FIELDS if f != "timestamp"], iso_text("sale_ts").alias("timestamp"))
    sparse, full = F.to_json(line), F.to_json(line, {"ignoreNullFields": "false"})
    text = F.when(F.col("l_orderkey") % 2 == 1, sparse).otherwise(full)
    cut = F.substr(text, F.lit(1), F.length(text) - 1)
    return events.select(F.when(_broken("l_orderkey", 61), cut).otherwise(text).alias("value"), *carry)
