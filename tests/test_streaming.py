import json

from pyspark.sql import functions as F

from tillworks.layout import Layout
from tillworks.operators.ingest import decode, stamp
from tillworks.sources.bronze import landing_stream, scan_bronze
from tillworks.streaming.bronze_stream import run_bronze_stream
from tillworks.streaming.dedupe import drop_replays


def drop(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def test_restart_continues_and_bad_lines_do_not_stop_it(spark, sale, tmp_path):
    landing, layout = tmp_path / "landing", Layout(str(tmp_path / "lake"))
    line = lambda i: {**sale.sound, "transaction_id": f"t{i}"}
    short = {k: v for k, v in sale.sound.items() if k != "store_id"}
    drop(landing, "a.json", line(1), "{broken", short)
    run_bronze_stream(landing_stream(spark, str(landing), max_files=1), layout)
    drop(landing, "b.json", line(2), line(3))
    for _ in range(2):
        run_bronze_stream(landing_stream(spark, str(landing), max_files=1), layout)
    assert sorted(r.transaction_id for r in scan_bronze(spark, layout.bronze).collect()) == ["t1", "t2", "t3"]
    letters = spark.read.json(layout.dead_letter).collect()
    assert sorted((r.reject_reason, r.message) for r in letters) == [("malformed", "{broken"), ("missing_fields", json.dumps(short))]


def test_replays_are_dropped_over_batches_and_tasks(spark, tmp_path):
    landing, out, state = (tmp_path / n for n in ("landing", "out", "state"))
    hot = [{"id": "hot", "n": "1"}] * 300

    def run():
        rows = stamp(landing_stream(spark, str(landing), max_files=2).select(F.from_json("value", "id string, n string").alias("r")).select("r.*"))
        query = (
            drop_replays(rows.select("id", "ingested_at"), ["id"])
            .writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(state))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    for i in range(4):
        drop(landing, f"f{i}.json", *hot, *[{"id": f"e{j}", "n": str(i)} for j in range(i * 50, i * 50 + 100)])
    run()
    drop(landing, "late.json", *hot, {"id": "e0", "n": "9"}, {"id": "new", "n": "9"})
    run()
    ids = [r.id for r in spark.read.parquet(str(out)).collect()]
    assert sorted(ids) == sorted({"hot", "new"} | {f"e{j}" for j in range(250)})


def test_decode_on_a_stream(spark, sale, tmp_path):
    drop(tmp_path / "in", "a.json", sale.sound)
    assert decode(landing_stream(spark, str(tmp_path / "in"))).isStreaming


def test_copies_are_thinned_without_a_second_state(spark, tmp_path):
    drop(tmp_path / "in", "a.json", *[{"id": "hot"}] * 500, {"id": None}, {"id": "b"}, {"id": None})
    rows = stamp(landing_stream(spark, str(tmp_path / "in")).select(F.from_json("value", "id string").alias("r")).select("r.*"))
    writer = drop_replays(rows, ["id"]).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    (state,) = [s for p in query.recentProgress if p.numInputRows for s in p.stateOperators]
    assert state.numRowsUpdated == 3
    assert sorted(str(r.id) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["None", "b", "hot"]
