"""Shards that fail while others go on, and counts per batch that survive failures."""

import gzip
import json
import threading
import time

import pytest

from tillworks.layout import Layout
from tillworks.sources.bronze import landing_stream, scan_bronze
from tillworks.streaming import bronze_stream
from tillworks.streaming.bronze_stream import batch_metrics, run_bronze_stream
from tillworks.streaming.shards import Supervisor, run_shards, shard_failures


@pytest.fixture
def shards(sale, tmp_path):
    """Four shard folders with two files of ten messages each; the last file of shard d can't be read."""
    for shard in "abcd":
        (tmp_path / shard).mkdir()
        for part in range(2):
            lines = [json.dumps({**sale.sound, "transaction_id": f"{shard}{part}{i}"}) for i in range(10)]
            (tmp_path / shard / f"{part}.txt.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
            time.sleep(0.02)
    return tmp_path


def streams(spark, folder, names="abcd"):
    return {name: (lambda name=name: landing_stream(spark, str(folder / name), max_files=1)) for name in names}


def landed(spark, layout):
    ids = [r.transaction_id for r in scan_bronze(spark, layout.bronze).collect()]
    assert len(ids) == len(set(ids))
    return sorted(ids)


def ids(*parts):
    return sorted(f"{part}{i}" for part in parts for i in range(10))


def test_an_unreadable_shard_stops_no_other(spark, shards, tmp_path):
    layout, broken = Layout(str(tmp_path / "lake")), shards / "d" / "1.txt.gz"
    sound = broken.read_bytes()
    broken.write_bytes(sound[:30])
    states = run_shards(spark, layout, streams(spark, shards), attempts=2, pause=0.05)
    assert {name: (s.finished, s.given_up, s.attempts) for name, s in states.items()} == {
        "a": (True, False, 1), "b": (True, False, 1), "c": (True, False, 1), "d": (False, True, 2),
    }
    assert landed(spark, layout) == ids("a0", "a1", "b0", "b1", "c0", "c1", "d0")
    failures = shard_failures(spark, layout).collect()
    assert sorted((r.shard, r.attempt) for r in failures) == [("d", 1), ("d", 2)] and all(r.error for r in failures)
    broken.write_bytes(sound)  # delivered again: the shard goes on from its checkpoint, the others find nothing new
    states = run_shards(spark, layout, streams(spark, shards), pause=0.05)
    assert all(s.finished and s.attempts == 1 for s in states.values())
    assert landed(spark, layout) == ids(*[f"{s}{p}" for s in "abcd" for p in "01"])
    counts = {(r.source, r.batch): r.messages for r in batch_metrics(spark, layout).collect()}
    assert counts == {(f"sales-{s}", p): 10 for s in "abcd" for p in (0, 1)}


def test_a_shard_that_recovers_is_taken_up_in_the_same_run(spark, shards, tmp_path):
    layout, calls = Layout(str(tmp_path / "lake")), []

    def late():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no route to the shard\nand more")
        return landing_stream(spark, str(shards / "b"))

    states = run_shards(spark, layout, {**streams(spark, shards, "a"), "b": late}, attempts=3, pause=0.05)
    assert states["b"].finished and states["b"].attempts == 3 and states["b"].errors == ["no route to the shard"] * 2
    assert landed(spark, layout) == ids("a0", "a1", "b0", "b1")


def test_unending_shards_go_on_until_stopped(spark, shards, sale, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    (shards / "d" / "1.txt.gz").write_bytes(b"\x1f\x8b broken")
    supervisor = Supervisor(spark, layout, streams(spark, shards, "ad"), attempts=2, pause=0.05, available_now=False, every="0 seconds")
    thread = threading.Thread(target=supervisor.run)
    thread.start()

    def wait(until):
        deadline = time.time() + 90
        while not until():
            assert time.time() < deadline and thread.is_alive()
            time.sleep(0.2)

    def counted():
        try:
            return {r.batch for r in batch_metrics(spark, layout).where("source = 'sales-a'").collect()}
        except Exception:  # no batch yet
            return set()

    wait(lambda: supervisor.states["d"].given_up and counted() >= {0, 1})
    (shards / "a" / "2.txt").write_text(json.dumps({**sale.sound, "transaction_id": "later"}))
    wait(lambda: 2 in counted())
    supervisor.stop()
    thread.join(60)
    assert not thread.is_alive() and "later" in landed(spark, layout)


def test_counts_survive_a_batch_that_is_run_again(spark, sale, tmp_path, monkeypatch):
    """The driver dies after landing a batch, before it counts as done: the repeated batch counts once."""
    landing, layout = tmp_path / "landing", Layout(str(tmp_path / "lake"))
    landing.mkdir()
    short = {k: v for k, v in sale.sound.items() if k != "store_id"}
    for part in range(3):
        lines = [json.dumps({**sale.sound, "transaction_id": f"{part}-{i}"}) for i in range(5)] + ["{", json.dumps(short)]
        (landing / f"{part}.txt").write_text("\n".join(lines))
        time.sleep(0.02)
    real, calls = bronze_stream.write_text, []

    def lost(*args):
        real(*args)
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(bronze_stream, "write_text", lost)
    with pytest.raises(Exception, match="lost"):
        run_bronze_stream(landing_stream(spark, str(landing), max_files=1), layout)
    run_bronze_stream(landing_stream(spark, str(landing), max_files=1), layout)
    assert len(calls) == 4
    rows = batch_metrics(spark, layout).collect()
    assert sorted((r.batch, r.messages, r.accepted, r.incomplete, r.malformed) for r in rows) == [(k, 7, 5, 1, 1) for k in range(3)]


def test_a_batch_of_one_instant_is_written_where_it_was_read(spark, sale, tmp_path, monkeypatch):
    from tillworks.sources import bronze as source

    monkeypatch.setattr(source, "LINES_PER_FILE", 10)
    landing, layout = tmp_path / "landing", Layout(str(tmp_path / "lake"))
    landing.mkdir()
    for part in range(6):
        lines = [json.dumps({**sale.sound, "transaction_id": f"{part}-{i}"}) for i in range(10)] + ["{"]
        (landing / f"{part}.txt.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    before = spark.conf.get("spark.sql.files.openCostInBytes", "4194304")
    spark.conf.set("spark.sql.files.openCostInBytes", "32m")  # a task for each file
    try:
        run_bronze_stream(landing_stream(spark, str(landing)), layout)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert landed(spark, layout) == sorted(f"{p}-{i}" for p in range(6) for i in range(10))
    assert len(scan_bronze(spark, layout.bronze).inputFiles()) == 6  # one file before, by a shuffle
    assert spark.read.text(layout.dead_letter).count() == 6 and len(spark.read.text(layout.dead_letter).inputFiles()) == 1
