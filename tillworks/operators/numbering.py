"""Dense row numbers over a whole table, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.session import staged

_PLACE = (1 << 33) - 1  # the part of a generated number that counts within a task


@contextmanager
def numbered(df: DataFrame, order: Sequence[str], name: str, after: int = 0) -> Iterator[DataFrame]:
    """Rows with the numbers ``after + 1, after + 2, …`` in ``order``, for the length of a block.

    Rows are cut into ranges of the order and stored; a range begins where the ranges before it end. Only the
    counts, a row per range, come together. ``order`` should tell all rows apart, or equal ones may swap numbers
    from run to run.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE))
    with staged(placed.select("*", F.spark_partition_id().alias("_range"), place.alias("_place")), "numbered") as rows:
        counts = rows.groupBy("_range").agg(F.count("*").alias("_n"))
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        number = F.col("_before") + F.col("_place") + F.lit(after + 1)
        yield rows.join(F.broadcast(starts), "_range").select(*df.columns, number.alias(name))
