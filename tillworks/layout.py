"""Where every dataset lives, and how a day maps to a folder."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_folder(day: date) -> str:
    """``year=YYYY/month=MM/day=DD`` with zero-padded parts."""
    return f"year={day.year:04d}/month={day.month:02d}/day={day.day:02d}"


def day_columns(instant: Column) -> dict[str, Column]:
    """The three text partition columns of an instant's (session time zone) day."""
    return {
        "year": F.date_format(instant, "yyyy"),
        "month": F.date_format(instant, "MM"),
        "day": F.date_format(instant, "dd"),
    }


def day_predicate(day: date) -> Column:
    """Partition predicate selecting one day; Spark prunes every other folder with it."""
    return (
        (F.col("year") == f"{day.year:04d}")
        & (F.col("month") == f"{day.month:02d}")
        & (F.col("day") == f"{day.day:02d}")
    )


def day_from_path(path: Column) -> dict[str, Column]:
    """Partition values of files that were read by leaf path and so lost their columns."""
    return {name: F.regexp_extract(path, rf"/{name}=([0-9]+)(/|$)", 1) for name in ("year", "month", "day")}


@dataclass(frozen=True)
class Layout:
    """All dataset folders under one root, so that no two steps can disagree on a prefix."""

    root: str

    def _under(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        return self._under("bronze/sales_data")

    @property
    def dead_letter(self) -> str:
        return self._under("bronze/dead_letter")

    @property
    def silver(self) -> str:
        return self._under("silver/sales_data_parquet")

    @property
    def quarantine(self) -> str:
        return self._under("silver/quarantine")

    @property
    def fact(self) -> str:
        return self._under("gold/fact_sales")

    def dim(self, name: str) -> str:
        return self._under(f"gold/{name}")

    def serving(self, name: str) -> str:
        return self._under(f"serving/{name}")

    def rejects(self, name: str) -> str:
        """Rows a serving table or dimension refused, by day, with the constraint they break."""
        return self._under(f"rejects/{name}")

    @property
    def shard_failures(self) -> str:
        return self._under("bronze/shard_failures")

    @property
    def batch_metrics(self) -> str:
        """What each batch of a stream read, accepted and refused: one file per source and batch."""
        return self._under("bronze/batch_metrics")

    def checkpoint(self, name: str) -> str:
        return self._under(f"checkpoints/{name}")
