"""Column layouts and declared constraints of every dataset."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The fields every raw sales line must carry.
REQUIRED_FIELDS = (
    "transaction_id",
    "product_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "total_price",
    "timestamp",
    "store_id",
    "payment_method",
    "client_type",
)
LINEAGE_FIELDS = ("ingested_at", "source_system")
CORRUPT_FIELD = "_corrupt_record"
DAY_COLUMNS = ("year", "month", "day")


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in types.items()])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_REAL, _WHEN = T.DoubleType(), T.TimestampType()

# Raw lines are read as text so that one bad value never changes a column's type.
RAW = T.StructType([T.StructField(name, _TEXT) for name in (*REQUIRED_FIELDS, *LINEAGE_FIELDS)])
RAW_WITH_CORRUPT = T.StructType([*RAW.fields, T.StructField(CORRUPT_FIELD, _TEXT)])

SILVER = _columns(
    transaction_id=_TEXT, product_id=_TEXT, product_name=_TEXT, product_category=_TEXT,
    quantity=_INT, unit_price=_REAL, total_price=_REAL,
    store_id=_TEXT, payment_method=_TEXT, client_type=_TEXT,
    sale_timestamp=_WHEN, processed_at=_WHEN,
)
QUARANTINE = T.StructType([*SILVER.fields, T.StructField("quarantine_reason", _TEXT)])

DIM_PRODUCT = _columns(product_key=_TEXT, product_id=_TEXT, product_name=_TEXT, product_category=_TEXT)
DIM_STORE = _columns(store_key=_TEXT, store_id=_TEXT)
DIM_PAYMENT_METHOD = _columns(payment_method_key=_TEXT, payment_method=_TEXT)
DIM_CLIENT_TYPE = _columns(client_type_key=_TEXT, client_type=_TEXT)
DIM_DATE = _columns(
    date_key=_INT, full_date=T.DateType(), year=_INT, quarter=_INT, month=_INT, month_name=_TEXT,
    week_of_year=_INT, day_of_month=_INT, day_of_week=_INT, day_name=_TEXT, is_weekend=T.BooleanType(),
)
FACT_SALES = _columns(
    transaction_id=_TEXT, product_key=_TEXT, store_key=_TEXT, date_key=_INT,
    payment_method_key=_TEXT, client_type_key=_TEXT,
    quantity=_INT, unit_price=_REAL, total_price=_REAL, sale_timestamp=_WHEN, processed_at=_WHEN,
)
SERVING_MONEY = T.DecimalType(10, 2)


def served(schema: T.StructType) -> T.StructType:
    """Serving form of a lake schema: prices become DECIMAL(10,2)."""
    return T.StructType(
        [T.StructField(f.name, SERVING_MONEY if f.dataType == _REAL else f.dataType) for f in schema.fields]
    )


FACT_SALES_SERVED = T.StructType([T.StructField("sale_key", _LONG), *served(FACT_SALES).fields])


@dataclass(frozen=True)
class TableSpec:
    """What a serving table declares about its rows."""

    name: str
    schema: T.StructType
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    money: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)


# Lengths, keys and references of the serving tables.
SALES_SILVER_SPEC = TableSpec(
    "sales_silver",
    served(SILVER),
    unique=(("transaction_id", "product_id"),),
    not_null=("transaction_id", "product_id"),
    max_length={
        "transaction_id": 255,
        "product_id": 50,
        "product_name": 100,
        "product_category": 100,
        "store_id": 50,
        "payment_method": 50,
        "client_type": 50,
    },
    money=("unit_price", "total_price"),
)
DIM_PRODUCT_SPEC = TableSpec(
    "dim_product",
    DIM_PRODUCT,
    unique=(("product_key",), ("product_id",)),
    not_null=("product_key", "product_id"),
    max_length={"product_key": 32, "product_id": 50, "product_name": 100, "product_category": 100},
)
DIM_STORE_SPEC = TableSpec(
    "dim_store",
    DIM_STORE,
    unique=(("store_key",), ("store_id",)),
    not_null=("store_key", "store_id"),
    max_length={"store_key": 32, "store_id": 50},
)
DIM_PAYMENT_METHOD_SPEC = TableSpec(
    "dim_payment_method",
    DIM_PAYMENT_METHOD,
    unique=(("payment_method_key",), ("payment_method",)),
    not_null=("payment_method_key", "payment_method"),
    max_length={"payment_method_key": 32, "payment_method": 50},
)
DIM_CLIENT_TYPE_SPEC = TableSpec(
    "dim_client_type",
    DIM_CLIENT_TYPE,
    unique=(("client_type_key",), ("client_type",)),
    not_null=("client_type_key", "client_type"),
    max_length={"client_type_key": 32, "client_type": 50},
)
DIM_DATE_SPEC = TableSpec(
    "dim_date",
    DIM_DATE,
    unique=(("date_key",), ("full_date",)),
    not_null=tuple(DIM_DATE.names),
    max_length={"month_name": 20, "day_name": 20},
)
FACT_SALES_SPEC = TableSpec(
    "fact_sales",
    FACT_SALES_SERVED,
    unique=(("sale_key",), ("transaction_id", "product_key")),
    not_null=(
        "transaction_id", "product_key", "store_key", "date_key", "payment_method_key", "client_type_key",
    ),
    max_length={
        "transaction_id": 255,
        "product_key": 32,
        "store_key": 32,
        "payment_method_key": 32,
        "client_type_key": 32,
    },
    money=("unit_price", "total_price"),
    references={
        "product_key": "dim_product",
        "store_key": "dim_store",
        "date_key": "dim_date",
        "payment_method_key": "dim_payment_method",
        "client_type_key": "dim_client_type",
    },
)
TABLE_SPECS = {
    spec.name: spec
    for spec in (
        SALES_SILVER_SPEC, DIM_PRODUCT_SPEC, DIM_STORE_SPEC, DIM_PAYMENT_METHOD_SPEC,
        DIM_CLIENT_TYPE_SPEC, DIM_DATE_SPEC, FACT_SALES_SPEC,
    )
}


def empty_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """A freshly (re)created table: the declared columns and no rows."""
    return spark.createDataFrame([], spec.schema)
