"""Stock events over batches and restarts, against the same crossings in plain Python."""

import random
from collections import defaultdict
from datetime import date, timedelta

from tillworks.streaming.alerts import stock_events

TYPES = "product_key string, store_key string, day date, change bigint, opening_units bigint, safety_units bigint"


def crossings(movements):
    out, shelves = [], defaultdict(lambda: defaultdict(int))
    for product, store, day, change, _, _ in movements:
        shelves[product, store][day] += change
    for shelf, days in shelves.items():
        units, below = 20, False
        for day in sorted(days):
            units += days[day]
            if (units < 10) != below:
                below = not below
                out.append((*shelf, day, units, 10, "below" if below else "recovered"))
    return sorted(out)


def test_one_event_per_crossing_over_restarts(spark, tmp_path):
    dice, start, movements = random.Random(4), date(2026, 1, 1), []
    for i in range(1500):
        shelf = ("hot", "s") if i % 3 == 0 else (f"p{dice.randrange(6)}", f"s{dice.randrange(2)}")
        change = dice.choice([-1, -2, -3, 4, -1, 2])
        movements.append((*shelf, start + timedelta(days=dice.randrange(40)), change, 20, 10))
    folders = {name: str(tmp_path / name) for name in ("in", "out", "state")}
    seen = 0
    for k in range(4):  # ten days a delivery, the stream started anew for each
        part = [m for m in movements if (m[2] - start).days // 10 == k]
        spark.createDataFrame(part, TYPES).repartition(3).write.mode("append").parquet(folders["in"])
        arriving = spark.readStream.schema(TYPES).parquet(folders["in"])
        query = (
            stock_events(arriving).writeStream.format("parquet").option("path", folders["out"])
            .option("checkpointLocation", folders["state"]).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        got = sorted(map(tuple, spark.read.parquet(folders["out"]).collect()))
        assert got == crossings([m for m in movements if (m[2] - start).days // 10 <= k])
        assert len(got) > seen
        seen = len(got)
    events = {(r[0], r[5]) for r in got}
    assert ("hot", "below") in events and any(e == "recovered" for _, e in events)


def test_shelves_share_a_state_value(spark, tmp_path):
    """Many shelves in few groups: each keeps its own stock over batches, those a batch leaves out included."""
    start, folders = date(2026, 1, 1), {name: str(tmp_path / name) for name in ("in", "out", "state")}
    movements = [(f"p{i}", "s", start + timedelta(days=k), -6 if (i + k) % 3 else 7, 20, 10) for k in range(6) for i in range(30) if i % (k + 2) != 1]
    for k in range(3):
        part = [m for m in movements if (m[2] - start).days // 2 == k]
        spark.createDataFrame(part, TYPES).repartition(2).write.mode("append").parquet(folders["in"])
        events = stock_events(spark.readStream.schema(TYPES).parquet(folders["in"]), groups=3)
        writer = events.writeStream.format("parquet").option("path", folders["out"]).option("checkpointLocation", folders["state"])
        writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(folders["out"]).collect())) == crossings(movements)
