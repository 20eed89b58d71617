import pathlib
import random
import shutil
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import session
from tillworks.layout import day_columns
from tillworks.operators import star
from tillworks.operators.numbering import numbered
from tillworks.schemas import DIM_STORE
from tillworks.sources import lake, serving, snapshots, versions

DAY = date(2026, 1, 2)
SCHEMA = "id string, v int, reason string"


def test_day_write_replaces_and_empties(spark, tmp_path):
    root, df = str(tmp_path / "q"), spark.createDataFrame([("a", 1, "null:x"), ("b", 2, "bad:y")], SCHEMA)
    for _ in range(2):
        lake.write_day(df, root, DAY, ("reason",))
    back = lake.scan_days(spark, root, df.schema, DAY, ("reason",))
    assert sorted((r.id, r.reason, r.month) for r in back.collect()) == [("a", "null:x", "01"), ("b", "bad:y", "01")]
    lake.write_day(df.limit(0), root, DAY, ("reason",))
    assert lake.scan_days(spark, root, df.schema, DAY, ("reason",)).count() == 0


def test_backfill_touches_its_days_alone(spark, tmp_path):
    root = str(tmp_path / "s")

    def load(rows, days=()):
        df = spark.createDataFrame(rows, "id string, at timestamp")
        lake.overwrite_days(lake.with_day(df, "at"), root, days)

    load([("a", datetime(2026, 1, 1)), ("b", datetime(2026, 1, 2)), ("c", datetime(2026, 1, 3))])
    load([("b2", datetime(2026, 1, 2))], [date(2026, 1, 2), date(2026, 1, 3)])
    schema = spark.createDataFrame([], "id string, at timestamp").schema
    assert sorted(r.id for r in lake.scan_days(spark, root, schema).collect()) == ["a", "b2"]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "dim_store")
    assert snapshots.read_snapshot(spark, root, DIM_STORE).count() == 0
    for n in range(1, 4):
        grown = snapshots.read_snapshot(spark, root, DIM_STORE).union(spark.createDataFrame([(f"k{n}", f"s{n}")], DIM_STORE))
        assert snapshots.write_snapshot(grown, root) == n
    (tmp_path / "dim_store" / "version=00000004").mkdir()  # a write that never finished
    assert snapshots.current_version(spark, root) == 3
    assert snapshots.write_snapshot(grown, root) == 5
    snapshots.expire_snapshots(spark, root, keep=2)
    assert snapshots.read_snapshot(spark, root, DIM_STORE).count() == 3
    assert not (tmp_path / "dim_store" / "version=00000001").exists()


SALES = "id string, p string, v int, sale_timestamp timestamp"


def sales(spark, *rows):
    return spark.createDataFrame([(*r[:3], datetime(*r[3])) for r in rows], SALES)


def content(spark, root, schema):
    return sorted((r.id, r.v, r.sale_period) for r in serving.read_table(spark, root, schema).collect())


def test_serving_merge_moves_periods_and_leaves_others(spark, tmp_path):
    root = str(tmp_path / "fact")
    first = sales(spark, ("a", "1", 1, (2026, 1, 5)), ("b", "1", 2, (2026, 2, 5)), ("c", "1", 3, (2026, 3, 5)))
    keys = ["id", "p"]
    serving.merge_table(spark, root, first.schema, first, keys)
    untouched = sorted((tmp_path / "fact" / "sale_period=202602").rglob("*"))
    moved = sales(spark, ("a", "1", 9, (2026, 3, 1)), ("d", "1", 4, (2026, 3, 2)))
    assert serving.merge_table(spark, root, first.schema, moved, keys) == ["202601", "202603"]
    expected = [("a", 9, "202603"), ("b", 2, "202602"), ("c", 3, "202603"), ("d", 4, "202603")]
    assert content(spark, root, first.schema) == expected
    assert sorted((tmp_path / "fact" / "sale_period=202602").rglob("*")) == untouched
    serving.merge_table(spark, root, first.schema, moved, keys)
    assert content(spark, root, first.schema) == expected


class Lost(Exception):
    """A driver that dies."""


def broken_off(monkeypatch, owner, name, at=1):
    """The function fails from its ``at``-th call on."""
    real, calls = getattr(owner, name), []

    def lost(*args, **options):
        calls.append(args)
        if len(calls) >= at:
            raise Lost
        return real(*args, **options)

    monkeypatch.setattr(owner, name, lost)


@pytest.mark.parametrize("step", ["finish_pending", "mark", "expire"])
def test_broken_off_merge_is_completed(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "fact")
    first = sales(spark, ("a", "1", 1, (2026, 1, 5)), ("z", "1", 3, (2026, 5, 5)))
    serving.merge_table(spark, root, first.schema, first, ["id", "p"])
    before = content(spark, root, first.schema)
    with monkeypatch.context() as patch:
        broken_off(patch, versions, step)
        with pytest.raises(Lost):
            serving.merge_table(spark, root, first.schema, sales(spark, ("a", "1", 5, (2026, 2, 5))), ["id", "p"])
        if step != "expire":
            assert content(spark, root, first.schema) == before
    assert versions.finish_pending(spark, root)
    after = [("a", 5, "202602"), ("z", 3, "202605")]
    assert content(spark, root, first.schema) == after
    assert not versions.finish_pending(spark, root)
    serving.merge_table(spark, root, first.schema, sales(spark, ("a", "1", 6, (2026, 2, 5))), ["id", "p"])
    assert content(spark, root, first.schema) == [("a", 6, "202602"), ("z", 3, "202605")]


def test_merge_opens_the_admitted_periods_alone(spark, tmp_path):
    """Twelve periods; a batch corrects rows of two and moves one of them to a third. The other rows can't even be read."""
    root, keys = str(tmp_path / "fact"), ["id", "p"]
    first = sales(spark, *[(f"k{m}-{i}", str(i % 3), i, (2026, m, 1 + i)) for m in range(1, 13) for i in range(20)])
    serving.merge_table(spark, root, first.schema, first, keys)
    batch = sales(spark, ("k3-4", "1", 100, (2026, 3, 5)), ("k7-5", "2", 200, (2026, 9, 1)), ("new", "0", 300, (2026, 9, 2)))
    assert serving.admitted_periods(spark, root, batch, keys) == ["202603", "202607"]
    hidden = {}
    for part in (tmp_path / "fact").iterdir():
        if part.name[-6:] not in ("202603", "202607", "202609"):
            for file in part.glob("version=*/part-*"):
                hidden[file] = file.read_bytes()
                file.write_bytes(b"no Parquet")
                file.with_name(f".{file.name}.crc").unlink()
    assert len(hidden) >= 9
    assert serving.merge_table(spark, root, first.schema, batch, keys) == ["202603", "202607", "202609"]
    for file, data in hidden.items():
        file.write_bytes(data)
    expected = {r.id: r.v for r in first.collect()} | {"k3-4": 100, "k7-5": 200, "new": 300}
    got = serving.read_table(spark, root, first.schema).collect()
    assert len(got) == len(expected) and {r.id: r.v for r in got} == expected


def test_no_match_is_lost(spark, tmp_path):
    """Merges of random batches against a dictionary, with keys that move between periods and periods that empty."""
    dice, root, keys, known = random.Random(8), str(tmp_path / "fact"), ["id", "p"], {}
    for _ in range(5):
        rows = {(f"k{dice.randrange(60)}", "1"): (dice.randrange(99), (2026, dice.randrange(1, 7), 3)) for _ in range(25)}
        batch = sales(spark, *[(*key, *value) for key, value in rows.items()])
        truly = {f"{known[k][1][0]}{known[k][1][1]:02d}" for k in rows if k in known}
        if known:
            assert set(serving.admitted_periods(spark, root, batch, keys)) == truly
        serving.merge_table(spark, root, batch.schema, batch, keys)
        known |= rows
        expected = sorted((k[0], v, f"{at[0]}{at[1]:02d}") for k, (v, at) in known.items())
        assert content(spark, root, batch.schema) == expected


def test_keys_of_another_type_and_leftovers_of_a_lost_merge(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "fact")
    first = sales(spark, ("1", "1", 1, (2026, 1, 5)), ("2", "1", 2, (2026, 2, 5)))
    serving.merge_table(spark, root, first.schema, first, ["id", "p"])
    with monkeypatch.context() as patch:
        broken_off(patch, versions, "replace_parts")
        with pytest.raises(Lost):  # March is staged, but never decided
            serving.merge_table(spark, root, first.schema, sales(spark, ("9", "1", 9, (2026, 3, 5))), ["id", "p"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        numbers = sales(spark, ("1", "1", 7, (2026, 1, 6))).withColumn("id", F.col("id").cast("bigint"))
        serving.merge_table(spark, root, first.schema, numbers, ["id", "p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert content(spark, root, first.schema) == [("1", 7, "202601"), ("2", 2, "202602")]


def test_periods_without_a_sketch_are_admitted(spark, tmp_path):
    root = str(tmp_path / "fact")
    first = sales(spark, ("a", "1", 1, (2026, 1, 5)), ("b", "1", 2, (2026, 2, 5)))
    serving.merge_table(spark, root, first.schema, first, ["id", "p"])
    (sketch,) = (tmp_path / "fact" / "sale_period=202602").glob("version=*/_keys")
    shutil.rmtree(sketch)
    batch = sales(spark, ("x", "1", 9, (2026, 3, 1)))
    assert serving.admitted_periods(spark, root, batch, ["id", "p"]) == ["202602"]
    assert serving.merge_table(spark, root, first.schema, batch, ["id", "p"]) == ["202603"]


def test_a_condition_on_days_opens_their_periods_alone(spark, tmp_path):
    root = str(tmp_path / "fact")
    rows = sales(spark, *[(f"k{m}-{i}", "1", i, (2026, m, 1 + i)) for m in range(1, 13) for i in range(20)])
    rows = rows.withColumn("date_key", F.date_format("sale_timestamp", "yyyyMMdd").cast("int"))
    serving.merge_table(spark, root, rows.schema, rows, ["id", "p"])
    dates = session.stored(star.date_dim(spark, date(2026, 1, 1), date(2026, 12, 31)), "dates")
    quarter = serving.with_dates(serving.read_table(spark, root, rows.schema), dates.where("quarter = 2"))
    assert "dynamicpruning" in quarter._jdf.queryExecution().executedPlan().toString()
    for part in (tmp_path / "fact").iterdir():
        if part.name[-2:] not in ("04", "05", "06"):
            for file in part.glob("version=*/part-*"):
                file.write_bytes(b"no Parquet")
                file.with_name(f".{file.name}.crc").unlink()
    got = quarter.collect()
    assert sorted(r.id for r in got) == sorted(f"k{m}-{i}" for m in (4, 5, 6) for i in range(20))
    assert all(r.full_date == r.sale_timestamp.date() and r.quarter == 2 for r in got)


def test_serial_numbers_have_no_gaps_over_merges(spark, tmp_path):
    root, keys = str(tmp_path / "fact"), ["id", "p"]
    schema = sales(spark).select(F.lit(1).cast("bigint").alias("sale_key"), "*").schema
    given, dice = {}, random.Random(9)
    for _ in range(3):
        ids = dice.sample(range(400), 150)
        batch = sales(spark, *[(f"k{i:03d}", "1", i, (2026, dice.randrange(1, 13), 5)) for i in ids]).repartition(6)
        serving.merge_table(spark, root, schema, batch, keys, serial="sale_key")
        fresh = sorted(f"k{i:03d}" for i in ids if f"k{i:03d}" not in given)
        given |= {key: len(given) + n for n, key in enumerate(fresh, 1)}
        got = {r.id: r.sale_key for r in serving.read_table(spark, root, schema).collect()}
        assert got == given and sorted(got.values()) == list(range(1, len(given) + 1))
    for note in (tmp_path / "fact").rglob("_highest.*"):
        note.unlink()
    assert serving.highest_number(spark, root, schema, "sale_key") == len(given)


def test_numbers_are_dense_whatever_the_tasks(spark):
    rows = spark.range(5000).select(F.hash("id").alias("h"), "id").repartition(13)
    with numbered(rows, ["h", "id"], "n", after=7) as out:
        got = [(r.n, r.h, r.id) for r in out.collect()]
    expected = sorted((r.h, r.id) for r in rows.collect())
    assert sorted(got) == [(8 + i, *row) for i, row in enumerate(expected)]
    with numbered(rows.limit(0), ["id"], "n") as out:
        assert out.count() == 0


DAYS = "id string, at timestamp, v int"


def days_of(spark, v, *days):
    return lake.with_day(spark.createDataFrame([(f"r{d}-{i}", datetime(2026, 1, d, 5), v) for d in days for i in range(5)], DAYS), "at")


def seen(spark, root):
    rows = lake.scan_days(spark, root, spark.createDataFrame([], DAYS).schema).collect()
    assert all(r.day == f"{r.at.day:02d}" for r in rows)
    return sorted((r.day, r.v) for r in rows)


def whole(v, *days):
    return [(f"{d:02d}", v) for d in days for _ in range(5)]


@pytest.mark.parametrize("step, shown", [("replace_parts", "old"), ("finish_pending", "old"), ("mark", "old"), ("expire", "new")])
def test_broken_off_backfill_shows_whole_days(spark, tmp_path, monkeypatch, step, shown):
    root, old = str(tmp_path / "s"), whole(1, 1, 2, 3)
    lake.overwrite_days(days_of(spark, 1, 1, 2, 3), root)
    new = whole(2, 1, 2)  # the third day is emptied
    with monkeypatch.context() as patch:
        broken_off(patch, versions, step, at=2 if step == "finish_pending" else 1)
        with pytest.raises(Lost):
            lake.overwrite_days(days_of(spark, 2, 1, 2), root, [DAY.replace(day=d) for d in (1, 2, 3)])
        assert seen(spark, root) == (old if shown == "old" else new)
    # The next write finishes what was decided; what was not decided never shows.
    lake.write_day(days_of(spark, 4, 9), root, DAY.replace(day=9))
    assert seen(spark, root) == (old if step == "replace_parts" else new) + whole(4, 9)
    assert not (tmp_path / "s_pending" / "decided").exists()


def test_a_day_between_two_marks_is_old_or_new(spark, tmp_path, monkeypatch):
    """A backfill that dies after marking the first of two days: one is new, one is old, both are whole."""
    root = str(tmp_path / "s")
    lake.overwrite_days(days_of(spark, 1, 1, 2), root)
    with monkeypatch.context() as patch:
        broken_off(patch, versions, "mark", at=2)
        with pytest.raises(Lost):
            lake.overwrite_days(days_of(spark, 2, 1, 2), root)
    assert seen(spark, root) == whole(2, 1) + whole(1, 2)
    assert versions.finish_pending(spark, root) and seen(spark, root) == whole(2, 1, 2)


def test_broken_off_day_write_leaves_the_old_day(spark, tmp_path):
    root, fail = str(tmp_path / "s"), F.raise_error(F.lit("lost")).cast("int")
    lake.write_day(days_of(spark, 1, 2), root, DAY)
    bad = days_of(spark, 2, 2).withColumn("v", F.when(F.col("id") == "r2-3", fail).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        lake.write_day(bad, root, DAY)
    assert seen(spark, root) == whole(1, 2)
    (tmp_path / "s" / "year=2026" / "month=01" / "day=02" / "version=00000007").mkdir()  # left by another
    lake.write_day(days_of(spark, 3, 2), root, DAY)
    assert seen(spark, root) == whole(3, 2)


def test_a_reader_that_has_started_keeps_its_files(spark, tmp_path):
    root = str(tmp_path / "s")
    lake.write_day(days_of(spark, 1, 2), root, DAY)
    schema = spark.createDataFrame([], DAYS).schema
    started = lake.scan_days(spark, root, schema, DAY)
    lake.write_day(days_of(spark, 2, 2), root, DAY)
    assert {r.v for r in started.collect()} == {1}
    assert {r.v for r in lake.scan_days(spark, root, schema, DAY).collect()} == {2}
    for v in (3, 4):
        lake.write_day(days_of(spark, v, 2), root, DAY)
    assert len(list(tmp_path.rglob("version=*"))) == versions.KEEP


def test_day_scan_lists_its_day_alone(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "id string")
    for day in range(1, 13):
        lake.write_day(df, str(tmp_path), DAY.replace(day=day))
    assert len(lake.scan_days(spark, str(tmp_path), df.schema).inputFiles()) == 12
    one = lake.scan_days(spark, str(tmp_path), df.schema, DAY.replace(day=3))
    assert len(one.inputFiles()) == 1 and one.first().day == "03"
    absent = lake.scan_days(spark, str(tmp_path), df.schema, DAY.replace(year=1999))
    assert absent.count() == 0 and absent.columns == one.columns


def test_day_files_do_not_follow_the_tasks(spark, tmp_path):
    rows = spark.range(4000).select("id", (F.col("id") % 8).cast("string").alias("reason")).repartition(64)
    lake.write_day(rows, str(tmp_path), DAY, ("reason",))
    assert len(list(tmp_path.rglob("*.parquet"))) <= 16


def test_staged_rows_go_with_their_block(spark):
    with session.staged(spark.range(3), "block") as rows:
        folder = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert rows.count() == 3
    import os

    assert not os.path.exists(folder)


def test_stored_rows_go_with_their_scratch_block(spark, tmp_path):
    def folder_of(df):
        return pathlib.Path(df.inputFiles()[0].removeprefix("file://")).parent

    kept = session.stored(spark.range(3), "kept")
    with pytest.raises(Lost), session.scratch(spark):
        outer = folder_of(session.stored(spark.range(3), "outer"))
        with session.scratch(spark):
            inner = folder_of(session.stored(spark.range(3), "inner"))
        assert outer.exists() and not inner.exists()
        raise Lost
    assert not outer.exists() and folder_of(kept).exists()


def test_work_folder_and_sizes(spark, tmp_path, monkeypatch):
    assert session.work_root(spark) == session.work_root(spark)
    assert session.shuffle_partitions(10**12) == 7451
    df = spark.range(10).withColumns(day_columns(F.current_timestamp()))
    copy = session.stored(df, "copy")
    assert copy.count() == 10 and copy.columns == df.columns
    assert session.stored_bytes(spark, str(tmp_path / "nothing")) == 0
    assert session.broadcast_limit(spark) == 10 * 1024 * 1024


def test_rows_that_lie_by_day_are_written_without_a_shuffle(spark, tmp_path):
    schema = T.StructType([T.StructField("n", T.LongType())])
    rows = spark.range(90).select(F.col("id").alias("n"), F.lit("2026").alias("year"), F.lit("01").alias("month"), F.format_string("%02d", F.col("id") % 3 + 1).alias("day"))
    lake.overwrite_days(rows, f"{tmp_path}/a")
    lake.overwrite_days(lake.scan_days(spark, f"{tmp_path}/a", schema), f"{tmp_path}/b", laid_out=True)
    copied = lake.scan_days(spark, f"{tmp_path}/b", schema)
    assert sorted(map(tuple, copied.collect())) == sorted(map(tuple, rows.collect()))


def test_joins_with_a_table_that_is_not_there_are_left_out(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType())])
    nothing = serving.read_table(spark, str(tmp_path / "none"), schema)
    merged = nothing.join(spark.range(5).withColumnRenamed("id", "k"), "k", "full_outer")
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString() and merged.count() == 5


def test_copies_in_buckets_join_without_a_shuffle(spark):
    rows = spark.range(400).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("l"), "id")
    tables = spark.catalog.listTables()
    old = session.stored_by(rows.where("id < 300").repartition("k", "l"), "old", ["k", "l"])
    new = session.stored_by(rows.where("id >= 200").withColumn("id", -F.col("id")), "new", ["k", "l"])
    assert spark.catalog.listTables() == tables
    both = old.join(new.withColumnRenamed("id", "other"), ["k", "l"], "full_outer")
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    found = {r.l: (r.k, r.id, r.other) for r in both.collect()}
    assert found == {str(i): (i % 7, i if i < 300 else None, -i if i >= 200 else None) for i in range(400)}


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(k).getName() for k in range(files.size())) if name.startswith("shuffle_")}


def test_shuffles_go_with_their_job(spark):
    before = shuffle_files(spark)
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    assert session.stored(sums, "sums").count() == 7
    assert sorted(sums.collect()) == sorted(sums.collect())
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before


def test_a_staged_batch_is_joined_where_it_lies(spark, tmp_path, monkeypatch):
    """Of the join with the target only the target moves; keys with a NULL part stay apart, as in any join."""
    schema, root = spark.createDataFrame([], "k string, l string, v int, sale_timestamp timestamp").schema, str(tmp_path / "t")
    at = datetime(2026, 1, 2)
    old = spark.createDataFrame([(str(i), "a", i, at) for i in range(50)] + [(None, "a", 1, at)], schema)
    new = spark.createDataFrame([(str(i), "a", -i, at) for i in range(40, 60)] + [(None, "a", 2, at)], schema)
    plans, real = [], serving._write_anew
    monkeypatch.setattr(serving, "_write_anew", lambda df, path: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, path)))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for batch in (old, new):
            serving.merge_table(spark, root, schema, batch, ["k", "l"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    merges = [text.count("ENSURE_REQUIREMENTS") for text in plans if "Join" in text]
    assert merges == [1]
    found = sorted((r.k or "", r.v) for r in serving.read_table(spark, root, schema).collect())
    assert found == sorted([(str(i), i if i < 40 else -i) for i in range(60)] + [("", 1), ("", 2)])
