"""Optional hand-over to a relational database; the merge itself runs on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 8, batch_rows: int = 10_000
) -> None:
    """Replace a database table with the rows, over a bounded number of connections."""
    options = {**properties, "numPartitions": str(connections), "batchsize": str(batch_rows)}
    df.write.options(**options).jdbc(url, table, mode="overwrite", properties=properties)
