import json

import pytest
from pyspark.sql import functions as F

from tillworks.layout import Layout
from tillworks.operators import ingest
from tillworks.sources import bronze


def checked(df):
    return df.transform(ingest.with_message).transform(ingest.with_missing_fields)


def messages(spark, *texts):
    return checked(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_presence_counts_not_value(spark, sale):
    record = {**sale.sound, "store_id": None, "extra": {"a": [1, 2]}}
    assert ingest.accepted(messages(spark, json.dumps(record))).count() == 1


@pytest.mark.parametrize("fields", [["store_id"], ["client_type", "quantity"]])
def test_missing_fields_are_named(spark, sale, fields):
    record = {k: v for k, v in sale.sound.items() if k not in fields}
    row = ingest.rejected(messages(spark, json.dumps(record))).first()
    assert (row.reject_reason, row.missing_fields) == ("missing_fields", sorted(fields))


@pytest.mark.parametrize("spoil", [
    lambda t: t[:-1], lambda t: t + " tail", lambda t: t + t, lambda t: t + "," + t, lambda t: f"[{t}]",
    lambda t: "", lambda t: "null", lambda t: "{",
])
def test_malformed_lines_are_dead_letters(spark, sale, spoil):
    df = messages(spark, spoil(json.dumps(sale.sound)))
    assert ingest.accepted(df).count() == 0
    assert ingest.rejected(df).first().reject_reason == "malformed"


def test_bytes_structs_and_line_breaks(spark, sale):
    pretty = json.dumps(sale.sound, indent=2)
    as_bytes = spark.createDataFrame([(pretty.encode(),)], "value binary")
    row = ingest.accepted(checked(as_bytes)).first()
    assert "\n" not in row.message and json.loads(row.message) == sale.sound
    as_struct = sale({}).select(F.struct("*").alias("value"))
    assert json.loads(ingest.accepted(checked(as_struct)).first().message) == sale.sound


def test_decode_matches_fields(spark, sale):
    df = spark.createDataFrame([(json.dumps(sale.sound),), ("{broken",)], "value string")
    good, bad = ingest.decode(df).collect()
    assert good.product_id == "p1" and good._corrupt_record is None
    assert bad.product_id is None and bad._corrupt_record == "{broken"


def test_report_counts_every_missing_field(spark, sale):
    drop = lambda *names: json.dumps({k: v for k, v in sale.sound.items() if k not in names})
    df = messages(spark, drop("store_id"), drop("store_id", "quantity"), drop(), "oops")
    assert {tuple(r) for r in ingest.missing_field_report(df).collect()} == {("store_id", 2), ("quantity", 1)}
    assert tuple(ingest.ingest_metrics(df).first()) == (4, 1, 2, 1)


def test_bronze_keeps_unknown_fields_and_adds_lineage(spark, sale, tmp_path):
    record = {**sale.sound, "quantity": 3, "loyalty": "x}y", "ingested_at": "old"}
    clock = F.lit("2026-02-03 04:05:06").cast("timestamp")
    stamped = ingest.stamp(ingest.accepted(messages(spark, json.dumps(record))), clock)
    root = Layout(str(tmp_path)).bronze
    for _ in range(2):  # the same batch again replaces itself
        bronze.write_bronze(stamped, root, "b0")
    (line,) = spark.read.text(f"{root}/year=2026/month=02/day=03").collect()
    written = json.loads(line.value)
    assert written["loyalty"] == "x}y" and written["quantity"] == 3
    assert written["ingested_at"] == "2026-02-03T04:05:06.000000+00:00"
    assert written["source_system"] == "kinesis_producer"
    row = bronze.scan_bronze(spark, root).first()
    assert (row.ingested_at, row.month, row.quantity) == ("2026-02-03T04:05:06.000000+00:00", "02", "3")
    leaf = bronze.scan_bronze_files(spark, f"{root}/year=2026/month=02/day=03").first()
    assert (leaf.year, leaf.month, leaf.day) == ("2026", "02", "03")


def test_day_scan_prunes(spark, sale, tmp_path):
    from datetime import date

    base = ingest.accepted(messages(spark, json.dumps(sale.sound)))
    for day in ("2026-02-03", "2026-02-04"):
        bronze.write_bronze(ingest.stamp(base, F.lit(f"{day} 00:00:00").cast("timestamp")), f"{tmp_path}/b", day)
    scan = bronze.scan_bronze(spark, f"{tmp_path}/b", date(2026, 2, 4))
    assert scan.count() == 1 and len(scan.inputFiles()) == 1
    assert len(bronze.scan_bronze(spark, f"{tmp_path}/b").inputFiles()) == 2
    assert bronze.scan_bronze(spark, f"{tmp_path}/b", date(2020, 1, 1)).count() == 0


def test_compaction_keeps_lines_and_can_be_repeated(spark, sale, tmp_path):
    from datetime import date

    day, root = date(2026, 2, 3), f"{tmp_path}/b"

    def land(batch, *ids):
        rows = ingest.accepted(messages(spark, *[json.dumps({**sale.sound, "transaction_id": i}) for i in ids]))
        bronze.write_bronze(ingest.stamp(rows, F.lit("2026-02-03 01:00:00").cast("timestamp")), root, batch)

    land("b0", "t0", "t1")
    land("b1", "t1")
    assert bronze.compact_day(spark, root, day) == 2
    ids = lambda: sorted(r.transaction_id for r in bronze.scan_bronze(spark, root, day).collect())
    assert ids() == ["t0", "t1", "t1"] and len(bronze.scan_bronze(spark, root, day).inputFiles()) == 1
    land("b0", "t0", "t1")  # an old batch not yet deleted when a run broke off
    land("b2", "t2")
    assert bronze.compact_day(spark, root, day) == 2
    assert ids() == ["t0", "t1", "t1", "t2"]


@pytest.mark.parametrize("spoil", [
    lambda t: t.replace('"milk"', "'milk'"), lambda t: t.replace("milk", "mi\nlk"), lambda t: t.replace("milk", "mi\tlk"),
    lambda t: t + t, lambda t: t + "x",
])
def test_only_what_reads_back_is_accepted(spark, sale, spoil, tmp_path):
    text = spoil(json.dumps(sale.sound))
    df = messages(spark, text)
    assert ingest.accepted(df).count() == 0
    assert ingest.rejected(df).first().message == text


def test_spread_baskets_and_whole_ones(spark):
    rows = [("hot", f"p{i % 50}") for i in range(300)] + [(f"t{i % 100}", f"p{i}") for i in range(400)] + [(None, "p")] * 200
    df = spark.createDataFrame(rows, "transaction_id string, product_id string")
    placed = ingest.repartition_by_basket(df, spread=8, partitions=8).withColumn("at", F.spark_partition_id()).collect()
    assert sorted((r.transaction_id, r.product_id) for r in placed if r.transaction_id) == sorted(r for r in rows if r[0])
    at = {}
    for r in placed:
        at.setdefault(r.transaction_id, set()).add(r["at"])
    assert len(at["hot"]) > 3
    whole = ingest.repartition_by_basket(df, partitions=8).withColumn("at", F.spark_partition_id())
    spots = whole.where("transaction_id IS NOT NULL").groupBy("transaction_id").agg(F.countDistinct("at").alias("n"))
    assert spots.where("n > 1").count() == 0 and whole.count() == len(rows)


def test_late_arrivals(spark):
    df = spark.createDataFrame([("a", "2026-01-01 23:59:00", "2026-01-02 00:01:00"), ("b", "2026-01-01 01:00:00", "2026-01-01 02:00:00")],
                               "id string, sold string, ingested_at string")
    (row,) = ingest.late_arrivals(df, "sold").collect()
    assert (row.id, row.days_late) == ("a", 1)


def test_bronze_is_stored_compressed(spark, sale, tmp_path):
    lines = spark.createDataFrame([(json.dumps(sale.sound),)] * 200, "value string").transform(ingest.with_message).transform(ingest.with_missing_fields)
    bronze.write_bronze(ingest.stamp(ingest.accepted(lines)), str(tmp_path), "b")
    scan = bronze.scan_bronze(spark, str(tmp_path))
    assert scan.count() == 200 and all(f.endswith(".gz") for f in scan.inputFiles())
