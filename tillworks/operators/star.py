"""Star schema: conformed dimensions, date dimension, fact table, and the join back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks import functions as fn
from tillworks.schemas import DIM_CLIENT_TYPE, DIM_DATE, DIM_PAYMENT_METHOD, DIM_PRODUCT, DIM_STORE, FACT_SALES

# The span the date dimension covers unless told otherwise.
DATE_SPAN = (date(2024, 1, 1), date(2027, 12, 31))

# Fact key -> (dimension, natural key column).
NATURAL_KEYS = {
    "product_key": ("dim_product", "product_id"),
    "store_key": ("dim_store", "store_id"),
    "payment_method_key": ("dim_payment_method", "payment_method"),
    "client_type_key": ("dim_client_type", "client_type"),
}


def product_variants(silver: DataFrame) -> DataFrame:
    """Every distinct (id, name, category) seen, keyed by id; ids may repeat."""
    return (
        silver.select("product_id", "product_name", "product_category")
        .distinct()
        .withColumn("product_key", fn.surrogate_key(F.col("product_id")))
        .select(*DIM_PRODUCT.names)
    )


def dim_product(silver: DataFrame) -> DataFrame:
    """One row per product.

    When a product carries several descriptions, the most frequent is taken, and
    the greatest (name, category) of equally frequent ones, so that reruns agree.
    Counting first shrinks a product sold in a third of all lines to its few
    descriptions on the map side, by hashing; the pick then sorts those alone.
    """
    described = F.struct("lines", "product_name", "product_category")
    return (
        silver.groupBy("product_id", "product_name", "product_category")
        .agg(F.count("*").alias("lines"))
        .groupBy("product_id")
        .agg(F.max(described).alias("described"))
        .select(
            fn.surrogate_key(F.col("product_id")).alias("product_key"),
            "product_id",
            "described.product_name",
            "described.product_category",
        )
    )


def _dim_of_one(silver: DataFrame, natural: str, names: list[str]) -> DataFrame:
    members = silver.select(natural).distinct()
    return members.withColumn(names[0], fn.surrogate_key(F.col(natural))).select(*names)


def dim_store(silver: DataFrame) -> DataFrame:
    return _dim_of_one(silver, "store_id", DIM_STORE.names)


def dim_payment_method(silver: DataFrame) -> DataFrame:
    return _dim_of_one(silver, "payment_method", DIM_PAYMENT_METHOD.names)


def dim_client_type(silver: DataFrame) -> DataFrame:
    return _dim_of_one(silver, "client_type", DIM_CLIENT_TYPE.names)


DIMENSIONS = {
    "dim_product": dim_product,
    "dim_store": dim_store,
    "dim_payment_method": dim_payment_method,
    "dim_client_type": dim_client_type,
}


def calendar(days: DataFrame, day: str = "full_date", padded: bool = True) -> DataFrame:
    """Date-dimension columns for a set of days.

    Names are blank-padded as the serving database stores them; ``padded=False``
    gives plain names.
    """
    d = F.col(day)
    weekday = (F.weekday(d) + 1).cast("int")
    columns: dict[str, Column] = {
        "date_key": fn.date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": fn.padded_month_name(d) if padded else F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": weekday,
        "day_name": fn.padded_day_name(d) if padded else F.date_format(d, "EEEE"),
        "is_weekend": weekday.isin(6, 7),
    }
    return days.select(*[columns[name].alias(name) for name in DIM_DATE.names])


def _days_between(span: DataFrame, first: Column, last: Column) -> DataFrame:
    return span.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def date_dim(
    spark: SparkSession, start: date = DATE_SPAN[0], end: date = DATE_SPAN[1], padded: bool = True
) -> DataFrame:
    """Date dimension for a fixed span, both ends included."""
    return calendar(_days_between(spark.range(1), F.lit(start), F.lit(end)), padded=padded)


def date_dim_covering(df: DataFrame, instant: str, padded: bool = True) -> DataFrame:
    """Date dimension from the first to the last day found in a column."""
    ends = df.agg(F.min(F.to_date(instant)).alias("first_day"), F.max(F.to_date(instant)).alias("last_day"))
    filled = ends.where(F.col("first_day").isNotNull())
    return calendar(_days_between(filled, F.col("first_day"), F.col("last_day")), padded=padded)


def fact_sales(silver: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Fact rows; keys are hashes of the natural keys, so no dimension is looked up."""
    keys = {key: fn.surrogate_key(F.col(natural)) for key, (_, natural) in NATURAL_KEYS.items()}
    keys["date_key"] = fn.date_key(F.col("sale_timestamp"))
    return silver.select(*[keys.get(name, F.col(name)).alias(name) for name in FACT_SALES.names], *carry)


def star_join(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact lines with the attributes of their five dimensions.

    No join is forced: over stored dimensions Spark knows each size and
    broadcasts those within its bound; a larger one is shuffled, with adaptive
    execution splitting keys that hold a large share of the lines.
    """
    joined = fact
    for key in ("product_key", "store_key", "date_key", "payment_method_key", "client_type_key"):
        name = "dim_date" if key == "date_key" else NATURAL_KEYS[key][0]
        joined = joined.join(dims[name], key)
    return joined.select(
        "transaction_id",
        "product_name",
        "product_category",
        "store_id",
        "full_date",
        "payment_method",
        "client_type",
        "quantity",
        "unit_price",
        "total_price",
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named table, stacked."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    stacked = counts[0]
    for more in counts[1:]:
        stacked = stacked.unionByName(more)
    return stacked
