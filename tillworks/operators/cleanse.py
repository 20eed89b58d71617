"""Raw text lines to typed, standardised sales rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import functions as fn

# Silver column -> (raw field, how to read it), in output order.
STANDARD_COLUMNS = {
    "transaction_id": ("transaction_id", fn.clean),
    "product_id": ("product_id", fn.clean),
    "product_name": ("product_name", fn.title),
    "product_category": ("category", fn.code),
    "quantity": ("quantity", fn.whole_number),
    "unit_price": ("unit_price", fn.money),
    "total_price": ("total_price", fn.money),
    "store_id": ("store_id", fn.code),
    "payment_method": ("payment_method", fn.code),
    "client_type": ("client_type", fn.code),
    "sale_timestamp": ("timestamp", fn.parse_instant),
}


def standardize(raw: DataFrame, processed_at: Column | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Type and clean the eleven sales fields and stamp the processing time.

    ``carry`` passes columns such as the day partition through untouched.
    """
    typed = [read(F.col(f"`{field}`")).alias(name) for name, (field, read) in STANDARD_COLUMNS.items()]
    clock = F.current_timestamp() if processed_at is None else processed_at
    return raw.select(*typed, clock.alias("processed_at"), *carry)
