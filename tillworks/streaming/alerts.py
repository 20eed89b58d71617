"""Stock alerts as events: one when a shelf falls below its safety stock, one when it has recovered."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

BELOW, RECOVERED = "below", "recovered"
_EVENTS = "product_key string, store_key string, day date, units bigint, safety_units bigint, event string"
GROUPS = 1 << 10  # shelves are looked after in so many groups
_BY_DAY = ["shelf", "day"]
_STOCK = np.dtype([("shelf", "V16"), ("units", "<i8"), ("below", "?")])


class _Shelves(StatefulProcessor):
    """Of a group of shelves the stock of each, and on which side of its safety stock it is: one value for the group."""

    def init(self, handle) -> None:
        self._state = handle.getValueState("stock", "shelves binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Changes are added up by day first: what is held follows the days of a batch, not its rows.
        days = pd.DataFrame()
        for chunk in rows:
            days = _by_day(pd.concat([days, chunk]) if len(days) else chunk)
        stock = np.frombuffer(self._state.get()[0] if self._state.exists() else b"", _STOCK)
        known = {shelf.tobytes(): (units, below) for shelf, units, below in zip(stock["shelf"], stock["units"].tolist(), stock["below"].tolist())}
        shelf, n = days["shelf"].to_numpy(), len(days)
        first = np.append(True, shelf[1:] != shelf[:-1])
        start, end = np.flatnonzero(first), np.append(np.flatnonzero(first)[1:], n) - 1
        of = np.cumsum(first) - 1  # which shelf of the batch a row belongs to
        opening, safety = (days[c].to_numpy("int64")[end] for c in ("opening_units", "safety_units"))
        held = [known.get(k, (o, False)) for k, o in zip(shelf[start], opening.tolist())]
        total = days["change"].to_numpy("int64").cumsum()
        before = np.array([units for units, _ in held], "int64") - np.append(0, total[end[:-1]])
        units = total + before[of]
        below = units < safety[of]
        was = np.append(False, below[:-1])
        was[start] = [below for _, below in held]
        crossed = below != was
        out = days.loc[crossed, ["product_key", "store_key", "day"]]
        event = np.where(below, BELOW, RECOVERED)
        out = out.assign(units=units[crossed], safety_units=safety[of][crossed], event=event[crossed])
        known.update(zip(shelf[start], zip(units[end].tolist(), below[end].tolist())))
        kept = np.zeros(len(known), _STOCK)
        kept["shelf"] = np.frombuffer(b"".join(known), "V16")
        kept["units"], kept["below"] = zip(*known.values())
        self._state.update((kept.tobytes(),))
        yield out

    def close(self) -> None:
        pass


def _by_day(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per shelf and day, by shelf and day; a shelf's parameters are the ones that came last."""
    latest = rows.groupby("shelf", sort=False)[["opening_units", "safety_units"]].transform("last")
    rows = rows.assign(opening_units=latest["opening_units"], safety_units=latest["safety_units"])
    kept = ["product_key", "store_key", "opening_units", "safety_units"]
    return rows.groupby(_BY_DAY, as_index=False).agg({"change": "sum", **dict.fromkeys(kept, "first")})


def stock_events(movements: DataFrame, groups: int = GROUPS) -> DataFrame:
    """Stream of ``product_key, store_key, day, units, safety_units, event`` from a stream of stock movements.

    ``movements`` holds product_key, store_key, day, change (units, negative for sales), opening_units and
    safety_units (none of them NULL). Stock counts at the end of a day. A day's movements should arrive in one
    batch and days in order, as a lake by day delivers them; movements that come later count from then on, under
    their own day. The state holds 25 bytes per shelf (a digest of its keys, a number and a flag), so it follows
    the shelves, not the history. Shelves are read and kept by group, as a call per shelf to the state costs far
    more than the sums; a stream keeps the number of ``groups`` of its first start.
    """
    shelf = F.unhex(F.md5(F.to_json(F.struct("product_key", "store_key"), {"ignoreNullFields": "false"})))
    group = F.pmod(F.xxhash64("product_key", "store_key"), F.lit(groups))
    placed = movements.withColumns({"shelf": shelf, "shelf_group": group})
    return placed.groupBy("shelf_group").transformWithStateInPandas(_Shelves(), _EVENTS, "Append", "None")
