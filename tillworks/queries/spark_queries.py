"""The registered queries: each runs one operator over the whole of the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import functions as fn
from tillworks.layout import Layout, day_folder, day_from_path
from tillworks.operators import constraints, drift, ingest, insights, merge, quality, star
from tillworks.plans.bronze_to_silver import SILVER_KEYS, SILVER_UPDATES, bronze_to_silver, bronze_to_silver_days, serve_silver, tagged_lines
from tillworks.plans.silver_to_gold import (
    FACT_KEYS,
    FACT_UPDATES,
    PRODUCT_UPDATES,
    dimensions,
    gold_rejects,
    serve_gold,
    silver_to_gold,
)
from tillworks.schemas import (
    DAY_COLUMNS,
    FACT_SALES,
    FACT_SALES_SPEC,
    QUARANTINE,
    REQUIRED_FIELDS,
    SALES_SILVER_SPEC,
    SILVER,
    TABLE_SPECS,
    empty_table,
)
from tillworks.session import file_system, prepare, stored, stored_by, stored_bytes, work_dir, write_text
from tillworks.sources import bronze, lake, serving, snapshots, versions
from tillworks.sources.tables import messages, raw_lines, sales_events, table
from tillworks.streaming.alerts import stock_events
from tillworks.streaming.bronze_stream import batch_metrics, run_bronze_stream
from tillworks.streaming.dedupe import drop_replays, state_partitions
from tillworks.streaming.shards import run_shards

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The clock of a registered run, so that repeated runs agree.
CLOCK_TEXT = "2026-01-01 00:00:00"
SALES_COLUMNS = [c for c in SILVER.names if c != "processed_at"]
FACT_COLUMNS = [c for c in FACT_SALES.names if c != "processed_at"]
SALES_TABLES = ("lineitem", "orders", "customer", "part", "supplier")

# The merge queries load history first and then a batch that overlaps it.
HISTORY_ENDS = "2000-01-01"
BATCH_STARTS = "1997-01-01"
# The day whose partition the day scans read.
DELIVERY_DAY = date(1998, 7, 1)


def query(name: str):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            size = sum(stored_bytes(spark, f"{sf_dir}/{t}.parquet") for t in SALES_TABLES)
            return build(prepare(spark, size), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        return build

    return register


def _clock():
    return F.lit(CLOCK_TEXT).cast("timestamp")


def _texts(df: DataFrame) -> DataFrame:
    """Dates and instants as text, so that every engine prints them alike."""
    forms = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss"}
    return df.select(
        *[F.date_format(name, forms[kind]).alias(name) if kind in forms else F.col(name) for name, kind in df.dtypes]
    )


def _tagged(spark: SparkSession, sf_dir: str, rules=quality.SALES_RULES) -> DataFrame:
    return tagged_lines(raw_lines(sales_events(spark, sf_dir)), rules, _clock())


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid(_tagged(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid lines, one per business key, as a stored table for the queries that branch off it."""
    return stored(merge.dedupe_latest(_valid(spark, sf_dir), SILVER_KEYS), "silver")


def _history_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Silver already loaded, and a later delivery repeating part of it with corrections."""
    return _delivered(_silver(spark, sf_dir))


def _delivered(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    history = silver.where(F.col("sale_timestamp") < HISTORY_ENDS)
    batch = silver.where(F.col("sale_timestamp") >= BATCH_STARTS).withColumns(
        {
            "product_name": F.when(F.col("quantity") % 2 == 1, F.col("product_name")),
            "store_id": F.concat(F.lit("MOVED "), F.col("store_id")),
            "payment_method": F.when(F.col("quantity") >= 40, F.lit("VOUCHER")).otherwise(F.col("payment_method")),
            "client_type": F.when(F.col("quantity") >= 45, F.lit("STAFF")).otherwise(F.col("client_type")),
            "quantity": F.col("quantity") + 1,
            "total_price": fn.line_total(F.col("unit_price"), F.col("quantity") + 1),
        }
    )
    return history, batch


# ---------------------------------------------------------------- cleansing and scalar functions


@query("silver_standardize")
def silver_standardize(spark, sf_dir):
    return _texts(_tagged(spark, sf_dir).select(*SALES_COLUMNS))


@query("fn_text")
def fn_text(spark, sf_dir):
    raw = raw_lines(sales_events(spark, sf_dir))
    return raw.select(
        fn.clean(F.col("transaction_id")).alias("trimmed_id"),
        fn.title(F.col("product_name")).alias("title_name"),
        fn.code(F.col("category")).alias("category_code"),
        fn.code(F.col("store_id")).alias("store_code"),
    )


@query("fn_casts")
def fn_casts(spark, sf_dir):
    """Whole, decimal and unreadable texts through the casts."""
    raw = raw_lines(sales_events(spark, sf_dir))
    unreadable = F.concat(F.col("quantity"), F.lit(" units"))
    return raw.select(
        "transaction_id",
        fn.whole_number(F.col("quantity")).alias("quantity"),
        fn.whole_number(F.col("unit_price")).alias("whole_price"),
        fn.whole_number(unreadable).alias("unreadable_quantity"),
        fn.money(F.col("total_price")).alias("total_price"),
        fn.money(unreadable).alias("unreadable_price"),
    )


@query("fn_timestamp")
def fn_timestamp(spark, sf_dir):
    """ISO texts with offset, with a space and no offset, and an unreadable one."""
    events = sales_events(spark, sf_dir)
    raw = raw_lines(events, carry=("ship_ts",))
    return _texts(
        raw.select(
            "transaction_id",
            fn.parse_instant(F.col("timestamp")).alias("sale_timestamp"),
            fn.parse_instant(F.date_format("ship_ts", "yyyy-MM-dd HH:mm:ss")).alias("ship_timestamp"),
            fn.parse_instant(F.concat(F.lit("on "), F.col("timestamp"))).alias("unreadable_timestamp"),
        )
    )


@query("fn_price_check")
def fn_price_check(spark, sf_dir):
    typed = _tagged(spark, sf_dir)
    expected = fn.line_total(F.col("unit_price"), F.col("quantity"))
    return typed.select(
        "transaction_id",
        "product_id",
        expected.alias("expected_total"),
        (F.abs(F.col("total_price") - expected) > quality.PRICE_TOLERANCE).alias("inconsistent"),
    )


@query("fn_md5_keys")
def fn_md5_keys(spark, sf_dir):
    typed = _tagged(spark, sf_dir)
    return typed.select(
        *[fn.surrogate_key(F.col(natural)).alias(key) for key, (_, natural) in star.NATURAL_KEYS.items()]
    )


@query("fn_date_key")
def fn_date_key(spark, sf_dir):
    return _tagged(spark, sf_dir).select("transaction_id", fn.date_key(F.col("sale_timestamp")).alias("date_key"))


@query("serving_decimal_cast")
def serving_decimal_cast(spark, sf_dir):
    served = constraints.to_serving(_valid(spark, sf_dir), SALES_SILVER_SPEC)
    return served.select(
        "transaction_id",
        "product_id",
        F.col("unit_price").cast("string").alias("unit_price"),
        F.col("total_price").cast("string").alias("total_price"),
    )


# ---------------------------------------------------------------- quality


@query("validate_first_failure")
def validate_first_failure(spark, sf_dir):
    return _texts(_tagged(spark, sf_dir).drop("processed_at"))


@query("silver_valid")
def silver_valid(spark, sf_dir):
    return _texts(_valid(spark, sf_dir).drop("processed_at"))


@query("quarantine_rows")
def quarantine_rows(spark, sf_dir):
    return _texts(quality.quarantined(_tagged(spark, sf_dir)).drop("processed_at"))


@query("quarantine_audit")
def quarantine_audit(spark, sf_dir):
    return quality.audit(_tagged(spark, sf_dir))


@query("quality_metrics")
def quality_metrics(spark, sf_dir):
    return quality.metrics(_tagged(spark, sf_dir))


@query("split_invariant")
def split_invariant(spark, sf_dir):
    return quality.split_invariant(_tagged(spark, sf_dir))


@query("custom_rules")
def custom_rules(spark, sf_dir):
    """Rules of a user's own, in the user's order."""
    rules = (
        quality.Rule("bulk:quantity", "quantity >= 45"),
        quality.Rule("cheap:unit_price", "unit_price < 950"),
        quality.Rule("null:store_id", "store_id IS NULL"),
    )
    return _texts(_tagged(spark, sf_dir, rules).drop("processed_at"))


@query("silver_preview")
def silver_preview(spark, sf_dir):
    ordered = _valid(spark, sf_dir).orderBy(*[F.col(c) for c in SALES_COLUMNS])
    return _texts(ordered.limit(5).select(*SALES_COLUMNS))


# ---------------------------------------------------------------- star schema


@query("dim_product")
def dim_product(spark, sf_dir):
    return star.dim_product(_valid(spark, sf_dir))


@query("dim_store")
def dim_store(spark, sf_dir):
    return star.dim_store(_valid(spark, sf_dir))


@query("dim_payment_method")
def dim_payment_method(spark, sf_dir):
    return star.dim_payment_method(_valid(spark, sf_dir))


@query("dim_client_type")
def dim_client_type(spark, sf_dir):
    return star.dim_client_type(_valid(spark, sf_dir))


@query("dim_date")
def dim_date(spark, sf_dir):
    """The span of the given orders."""
    return _texts(star.date_dim_covering(table(spark, sf_dir, "orders"), "o_orderdate"))


@query("dim_date_insert_absent")
def dim_date_insert_absent(spark, sf_dir):
    """Add the days on which goods were shipped to the days on which they were ordered."""
    known = star.date_dim_covering(table(spark, sf_dir, "orders"), "o_orderdate")
    more = star.date_dim_covering(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return _texts(merge.insert_absent(known, more, ["date_key"], unique=True))


@query("fact_sales_build")
def fact_sales_build(spark, sf_dir):
    return _texts(star.fact_sales(_valid(spark, sf_dir)).drop("processed_at"))


def _gold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fact rows over stored silver, and the stored dimensions built from it."""
    silver = _silver(spark, sf_dir)
    dims = {name: stored(build(silver), name) for name, build in star.DIMENSIONS.items()}
    dims["dim_date"] = stored(star.date_dim_covering(silver, "sale_timestamp"), "dim_date")
    return star.fact_sales(silver), dims


@query("star_join")
def star_join(spark, sf_dir):
    return _texts(star.star_join(*_gold(spark, sf_dir)))


@query("star_join_top10")
def star_join_top10(spark, sf_dir):
    joined = star.star_join(*_gold(spark, sf_dir))
    return _texts(joined.orderBy("transaction_id", "product_name", "total_price", "store_id", "unit_price").limit(10))


@query("table_counts")
def table_counts(spark, sf_dir):
    fact, dims = _gold(spark, sf_dir)
    return star.table_counts({"fact_sales": fact, **{name: dims[name] for name in star.DIMENSIONS}})


# ---------------------------------------------------------------- merges


@query("dedupe_latest")
def dedupe_latest(spark, sf_dir):
    return _texts(merge.dedupe_latest(_valid(spark, sf_dir), SILVER_KEYS).select(*SALES_COLUMNS))


@query("upsert_silver")
def upsert_silver(spark, sf_dir):
    history, batch = _history_and_batch(spark, sf_dir)
    return _texts(merge.upsert(history, batch, SILVER_KEYS, SILVER_UPDATES, unique=True).select(*SALES_COLUMNS))


@query("upsert_fact")
def upsert_fact(spark, sf_dir):
    history, batch = (star.fact_sales(side) for side in _history_and_batch(spark, sf_dir))
    return _texts(merge.upsert(history, batch, FACT_KEYS, FACT_UPDATES, unique=True).select(*FACT_COLUMNS))


@query("upsert_dim_product")
def upsert_dim_product(spark, sf_dir):
    history, batch = (star.dim_product(side) for side in _history_and_batch(spark, sf_dir))
    return merge.upsert(history, batch, ["product_key"], PRODUCT_UPDATES, unique=True)


@query("upsert_null_overwrite")
def upsert_null_overwrite(spark, sf_dir):
    """Only the column in which the batch carries NULLs is updated."""
    history, batch = _history_and_batch(spark, sf_dir)
    merged = merge.upsert(history, batch, SILVER_KEYS, ("product_name",), unique=True)
    return merged.select("transaction_id", "product_id", "product_name", "quantity", "store_id")


@query("upsert_idempotent")
def upsert_idempotent(spark, sf_dir):
    """The same batch merged twice."""
    history, batch = _history_and_batch(spark, sf_dir)
    once = merge.upsert(history, batch, SILVER_KEYS, SILVER_UPDATES, unique=True)
    return _texts(merge.upsert(once, batch, SILVER_KEYS, SILVER_UPDATES, unique=True).select(*SALES_COLUMNS))


def _insert_absent(build, key):
    def run(spark, sf_dir):
        history, batch = (build(side) for side in _history_and_batch(spark, sf_dir))
        return merge.insert_absent(history, batch, [key], unique=True)

    return run


query("insert_absent_dim_store")(_insert_absent(star.dim_store, "store_key"))
query("insert_absent_dim_payment_method")(_insert_absent(star.dim_payment_method, "payment_method_key"))
query("insert_absent_dim_client_type")(_insert_absent(star.dim_client_type, "client_type_key"))


@query("assign_sale_key")
def assign_sale_key(spark, sf_dir):
    """History keeps its keys through a merge, new rows get larger ones; every key once.

    Rows are merged and compared by the natural keys, whose hashes the facts' keys are: silver is deduplicated by
    them, so it and all that is made of it stay where they are.
    """
    silver = stored_by(merge.dedupe_latest(_valid(spark, sf_dir), SILVER_KEYS), "silver", SILVER_KEYS)
    history, batch = (star.fact_sales(side, carry=("product_id",)) for side in _delivered(silver))
    serving_schema_key = F.lit(None).cast("bigint").alias("sale_key")
    empty = history.limit(0).select(serving_schema_key, "*")
    loaded = stored_by(merge.assign_key(history, empty), "loaded_fact", SILVER_KEYS)
    upserted = merge.upsert(loaded, batch, SILVER_KEYS, FACT_UPDATES, unique=True)
    merged = stored_by(merge.assign_key(upserted, loaded), "merged_fact", SILVER_KEYS)
    highest = loaded.agg(F.max("sale_key")).scalar()
    before = loaded.select(*SILVER_KEYS, F.col("sale_key").alias("old_key"))
    shared = merged.groupBy("sale_key").agg(F.count("*").alias("rows_with_key"))
    repeated = stored(shared.where(F.col("rows_with_key") > 1), "repeated_keys")  # the others occur once
    return (
        merged.join(before, list(SILVER_KEYS), "left")
        .join(repeated, "sale_key", "left")
        .select(
            *FACT_KEYS,
            F.coalesce(F.col("sale_key") == F.col("old_key"), F.lit(False)).alias("kept"),
            (F.col("old_key").isNull() & (F.col("sale_key") > highest)).alias("new_and_above"),
            F.coalesce("rows_with_key", F.lit(1).cast("bigint")).alias("rows_with_key"),
        )
    )


# ---------------------------------------------------------------- constraints


@query("pk_duplicates")
def pk_duplicates(spark, sf_dir):
    """Repeated keys of the lines before they are deduplicated, and of the fact rows made of them."""
    valid = stored(_valid(spark, sf_dir), "valid")
    lines = constraints.unique_violations(valid, SILVER_KEYS, "pk_sales_silver")
    facts = constraints.unique_violations(star.fact_sales(valid), FACT_KEYS, "uq_fact_sales")
    products = constraints.unique_violations(star.product_variants(valid), ("product_key",), "pk_dim_product")
    return lines.unionByName(facts).unionByName(products)


def _facts_and_old_dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fact rows of history and batch against dimensions that know the history alone."""
    history, batch = _history_and_batch(spark, sf_dir)
    dims = {name: stored(build(history), name) for name, build in star.DIMENSIONS.items()}
    dims["dim_date"] = stored(star.date_dim_covering(history, "sale_timestamp"), "dim_date")
    return star.fact_sales(history.unionByName(batch)), dims


@query("fk_orphans")
def fk_orphans(spark, sf_dir):
    return constraints.foreign_key_orphans(*_facts_and_old_dims(spark, sf_dir), FACT_SALES_SPEC.references)


@query("fk_accepted")
def fk_accepted(spark, sf_dir):
    """Facts of history and batch that dimensions built without every fifth store, and without the batch, cover."""
    history, batch = _history_and_batch(spark, sf_dir)
    facts = star.fact_sales(history.unionByName(batch.withColumn("store_id", F.regexp_replace("store_id", "^MOVED ", ""))))
    known = history.where(~F.col("store_id").rlike("[05]$"))
    dims = {name: stored(build(history if name != "dim_store" else known), name) for name, build in star.DIMENSIONS.items()}
    dims["dim_date"] = stored(star.date_dim_covering(history, "sale_timestamp"), "dim_date")
    return _texts(constraints.foreign_key_accepted(facts, dims, FACT_SALES_SPEC.references).drop("processed_at"))


@query("not_null_violations")
def not_null_violations(spark, sf_dir):
    """Every typed line, quarantined ones included, against the fact table's NOT NULL columns."""
    facts = star.fact_sales(_tagged(spark, sf_dir))
    return constraints.not_null_violations(facts, FACT_SALES_SPEC.not_null, FACT_KEYS)


@query("varchar_violations")
def varchar_violations(spark, sf_dir):
    """Descriptions grown with the quantity, against the serving lengths."""
    grown = _valid(spark, sf_dir).withColumns(
        {
            "product_name": F.repeat("product_name", F.col("quantity")),
            "store_id": F.concat_ws("-", "store_id", "store_id", F.col("product_category"), "payment_method"),
        }
    )
    return constraints.varchar_violations(grown, SALES_SILVER_SPEC.max_length, SILVER_KEYS)


@query("decimal_overflow")
def decimal_overflow(spark, sf_dir):
    """Prices given in hundredths of a cent by mistake: the large ones no longer fit."""
    scaled = _valid(spark, sf_dir).withColumns(
        {"unit_price": F.col("unit_price") * 10000, "total_price": F.col("total_price") * 10000}
    )
    return constraints.decimal_overflow(scaled, SALES_SILVER_SPEC.money, SILVER_KEYS)


# ---------------------------------------------------------------- serving loads


def _grown(df: DataFrame) -> DataFrame:
    """Names repeated and prices scaled, so that some no longer fit the serving columns."""
    return df.withColumns(
        {"product_name": F.repeat("product_name", F.col("quantity")), "total_price": F.col("total_price") * 10000}
    )


@query("serve_silver_rejects")
def serve_silver_rejects(spark, sf_dir):
    """What the silver load refuses, with the first constraint broken, and what it merged."""
    layout = Layout(work_dir(spark, "serve_silver"))
    silver = merge.dedupe_latest(_valid(spark, sf_dir), SILVER_KEYS)  # nothing else branches off it, so it is stored once
    lake.write_day(_grown(silver), layout.silver, DELIVERY_DAY, laid_out=True)
    serve_silver(spark, layout, DELIVERY_DAY, grain="month")
    schema = T.StructType([*SILVER.fields, T.StructField(constraints.BROKEN, T.StringType())])
    refused = lake.scan_days(spark, layout.rejects("sales_silver"), schema, DELIVERY_DAY)
    merged = serving.read_table(spark, layout.serving("sales_silver"), SALES_SILVER_SPEC.schema)
    return refused.select(*SILVER_KEYS, constraints.BROKEN).unionByName(
        merged.select(*SILVER_KEYS, F.lit("none").alias(constraints.BROKEN))
    )


@query("serve_gold_rejects")
def serve_gold_rejects(spark, sf_dir):
    """The batch's facts against the dimensions of the history: refused ones with their constraint, and merged ones."""
    layout = Layout(work_dir(spark, "serve_gold"))
    history, batch = _history_and_batch(spark, sf_dir)
    for name, build in star.DIMENSIONS.items():
        snapshots.write_snapshot(build(history), layout.dim(name))
    snapshots.write_snapshot(star.date_dim_covering(history, "sale_timestamp"), layout.dim("dim_date"))
    renamed = F.when(F.col("quantity") % 7 == 0, F.col("store_id")).otherwise(F.regexp_replace("store_id", "^MOVED ", ""))
    lake.write_day(star.fact_sales(batch.withColumn("store_id", renamed)), layout.fact, DELIVERY_DAY, laid_out=True)
    serve_gold(spark, layout, DELIVERY_DAY, grain="month")
    merged = serving.read_table(spark, layout.serving("fact_sales"), FACT_SALES_SPEC.schema)
    return gold_rejects(spark, layout, DELIVERY_DAY).select(*FACT_KEYS, constraints.BROKEN).unionByName(
        merged.select(*FACT_KEYS, F.lit("none").alias(constraints.BROKEN))
    )


def _served(spark: SparkSession, schema, sides: tuple[DataFrame, DataFrame], spec, keys, update, serial=None) -> DataFrame:
    """Two batches merged on disk, the second moving a part of the sales to another month."""
    root = Layout(work_dir(spark, "serving")).serving(spec.name)
    for side in sides:
        serving.merge_table(spark, root, spec.schema, constraints.to_serving(side, spec), keys, update, serial=serial)
    return _amounts(serving.read_table(spark, root, spec.schema)).select(*schema, serving.PERIOD)


def _amounts(df: DataFrame) -> DataFrame:
    """Decimal money as exact text."""
    return df.withColumns({c: F.col(c).cast("string") for c in ("unit_price", "total_price")})


def _moved(batch: DataFrame) -> DataFrame:
    later = F.when(F.col("quantity") % 5 == 0, F.add_months("sale_timestamp", 1).cast("timestamp"))
    return batch.withColumn("sale_timestamp", F.coalesce(F.date_trunc("day", later), F.col("sale_timestamp")))


@query("serving_merge_silver")
def serving_merge_silver(spark, sf_dir):
    history, batch = _history_and_batch(spark, sf_dir)
    return _texts(_served(spark, SALES_COLUMNS, (history, _moved(batch)), SALES_SILVER_SPEC, SILVER_KEYS, SILVER_UPDATES))


@query("serving_merge_fact")
def serving_merge_fact(spark, sf_dir):
    history, batch = _history_and_batch(spark, sf_dir)
    sides = (star.fact_sales(history), star.fact_sales(_moved(batch)))
    return _texts(_served(spark, FACT_COLUMNS, sides, FACT_SALES_SPEC, FACT_KEYS, FACT_UPDATES, serial="sale_key"))


# The two months that a batch of corrections hits.
CORRECTED = ("199603", "199710")


@query("serving_merge_admitted")
def serving_merge_admitted(spark, sf_dir):
    """Corrections of two months merged into the whole table: every row, and whether its period was admitted and rewritten."""
    silver = _silver(spark, sf_dir)
    root = Layout(work_dir(spark, "serving")).serving("sales_silver")
    hit = F.date_format("sale_timestamp", "yyyyMM").isin(*CORRECTED) & (F.col("quantity") % 3 == 0)
    corrections = silver.where(hit).withColumns(
        {
            "product_name": F.concat(F.col("product_name"), F.lit(" (corrected)")),
            "store_id": F.lit("ELSEWHERE"),
            "quantity": F.col("quantity") + 1,
            "total_price": fn.line_total(F.col("unit_price"), F.col("quantity") + 1),
        }
    )
    spec, done = SALES_SILVER_SPEC, []
    for sales in (silver, corrections):
        batch = stored(constraints.to_serving(sales, spec), "delivery")
        admitted = serving.admitted_periods(spark, root, batch, SILVER_KEYS)
        done.append((admitted, serving.merge_table(spark, root, spec.schema, batch, SILVER_KEYS, SILVER_UPDATES)))
    admitted, rewritten = done[-1]
    rows = _amounts(serving.read_table(spark, root, spec.schema))
    flags = {"admitted": F.col(serving.PERIOD).isin(admitted), "rewritten": F.col(serving.PERIOD).isin(rewritten)}
    return _texts(rows.withColumns(flags).select(*SALES_COLUMNS, serving.PERIOD, *flags))


QUARTER = (1996, 2)


@query("star_quarter")
def star_quarter(spark, sf_dir):
    """The star join of one quarter over the serving fact, which lies by month; other months are not opened."""
    silver = _silver(spark, sf_dir)
    root = Layout(work_dir(spark, "serving")).serving("fact_sales")
    facts = constraints.to_serving(star.fact_sales(silver), FACT_SALES_SPEC)
    serving.merge_table(spark, root, FACT_SALES_SPEC.schema, facts, FACT_KEYS, FACT_UPDATES, serial="sale_key")
    dims = {name: stored(build(silver), name) for name, build in star.DIMENSIONS.items()}
    dates = stored(star.date_dim_covering(silver, "sale_timestamp"), "dim_date")
    year, quarter = QUARTER
    dated = serving.with_dates(_amounts(serving.read_table(spark, root, FACT_SALES_SPEC.schema)), dates.where((F.col("year") == year) & (F.col("quarter") == quarter)))
    joined = star.star_join(dated.select(*FACT_SALES_SPEC.schema.names), {**dims, "dim_date": dates})
    return _texts(joined)


def _filled(tables: dict[str, DataFrame], phase: str) -> DataFrame:
    """Per table and column its place, its type and how many rows have a value."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        places = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("position"), F.lit(kind).alias("data_type"), F.col(c).alias("filled"))
            for k, (c, kind) in enumerate(df.dtypes, 1)
        ])
        parts.append(counts.select(F.lit(name).alias("table_name"), F.lit(phase).alias("phase"), F.inline(places)))
    return functools.reduce(DataFrame.unionByName, parts)


@query("tables_from_specs")
def tables_from_specs(spark, sf_dir):
    """All seven tables created, loaded without the processing time, dropped and created again: columns, types, filled rows."""
    silver = _silver(spark, sf_dir).drop("processed_at")
    layout = Layout(work_dir(spark, "tables"))
    loads = {name: build(silver) for name, build in star.DIMENSIONS.items()}
    loads["dim_date"] = star.date_dim_covering(silver, "sale_timestamp")
    merged = {
        "sales_silver": (silver, SILVER_KEYS, SILVER_UPDATES, None),
        "fact_sales": (star.fact_sales(silver.withColumn("processed_at", F.lit(None))).drop("processed_at"), FACT_KEYS, FACT_UPDATES, "sale_key"),
    }
    for name, rows in loads.items():
        snapshots.write_snapshot(empty_table(spark, TABLE_SPECS[name]), layout.dim(name))
        snapshots.write_snapshot(constraints.to_serving(rows, TABLE_SPECS[name]), layout.dim(name))
    for name, (rows, keys, update, serial) in merged.items():
        spec = TABLE_SPECS[name]
        serving.merge_table(spark, layout.serving(name), spec.schema, constraints.to_serving(rows, spec), keys, update, serial=serial)

    def tables() -> dict[str, DataFrame]:
        found = {name: snapshots.read_snapshot(spark, layout.dim(name), TABLE_SPECS[name].schema) for name in loads}
        served = {name: serving.read_table(spark, layout.serving(name), TABLE_SPECS[name].schema) for name in merged}
        return found | {name: df.drop(serving.PERIOD) for name, df in served.items()}

    loaded = stored(_filled(tables(), "loaded"), "loaded")
    for name in loads:
        versions.drop(spark, layout.dim(name))
        snapshots.write_snapshot(empty_table(spark, TABLE_SPECS[name]), layout.dim(name))
    for name in merged:
        serving.recreate(spark, layout.serving(name))
    return loaded.unionByName(_filled(tables(), "recreated"))


# Three deliveries of sales, by first day and day after the last; they overlap.
DELIVERIES = (("1900-01-01", "1995-01-01"), ("1994-01-01", "1997-01-01"), ("1996-01-01", "2100-01-01"))


@query("dense_sale_key")
def dense_sale_key(spark, sf_dir):
    """Surrogate keys after three merges that overlap: 1 to n in the order of arrival and key."""
    facts = stored(_fact(spark, sf_dir), "fact")
    root = Layout(work_dir(spark, "serving")).serving("fact_sales")
    for first, end in DELIVERIES:
        batch = facts.where((F.col("sale_timestamp") >= first) & (F.col("sale_timestamp") < end))
        batch = constraints.to_serving(batch, FACT_SALES_SPEC)
        serving.merge_table(spark, root, FACT_SALES_SPEC.schema, batch, FACT_KEYS, FACT_UPDATES, serial="sale_key")
    return serving.read_table(spark, root, FACT_SALES_SPEC.schema).select("sale_key", *FACT_KEYS, "quantity", serving.PERIOD)


def _days_run(spark: SparkSession, sf_dir: str, arrived: Column | None = None) -> Layout:
    """All lines landed and taken to silver and quarantine."""
    layout = Layout(work_dir(spark, "day_plans"))
    bronze.write_bronze(_stamped(spark, sf_dir, arrived), layout.bronze, "load-0")
    bronze_to_silver_days(spark, layout, processed_at=_clock())
    return layout


@query("plan_silver_days")
def plan_silver_days(spark, sf_dir):
    """Silver and quarantine of every landed day."""
    layout = _days_run(spark, sf_dir)
    valid = lake.scan_days(spark, layout.silver, SILVER).withColumn(quality.REASON, F.lit(None).cast("string"))
    refused = lake.scan_days(spark, layout.quarantine, QUARANTINE, partitions=(quality.REASON,))
    return _texts(valid.unionByName(refused).drop("processed_at"))


@query("plan_gold_days")
def plan_gold_days(spark, sf_dir):
    """Members of the dimensions and facts per day, after two days that hold all lines went through the plans one by one."""
    days = (DELIVERY_DAY, date(1998, 7, 2))
    late = F.coalesce("sale_ts", "ship_ts") >= F.lit(BATCH_STARTS).cast("timestamp")
    arrived = F.when(late, F.lit(str(days[1]))).otherwise(F.lit(str(days[0]))).cast("timestamp")
    layout = _days_run(spark, sf_dir, arrived)
    for day in days:
        bronze_to_silver(spark, layout, day, processed_at=_clock())
        silver_to_gold(spark, layout, day)
    dims = dimensions(spark, layout)
    counted = {"n": F.count("*"), "units": F.sum("quantity"), "cents": F.sum(fn.cents(F.col("total_price")))}
    facts = lake.scan_days(spark, layout.fact, FACT_SALES).groupBy(F.concat(*DAY_COLUMNS).alias("key"))
    out = facts.agg(*[value.alias(name) for name, value in counted.items()]).withColumn("name", F.lit("fact_sales"))
    for name in star.DIMENSIONS:
        key, *natural = TABLE_SPECS[name].schema.names
        member = dims[name].select(F.col(key).alias("key"), F.lit(name).alias("name"), F.concat_ws("/", *natural).alias("member"))
        out = out.unionByName(member, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- files


def _stamped(spark: SparkSession, sf_dir: str, arrived: Column | None = None) -> DataFrame:
    """Accepted messages; a delivery arrives on the first day of the quarter after the sale, unless told otherwise."""
    quarter = F.add_months(F.trunc(F.coalesce("sale_ts", "ship_ts"), "quarter"), 3).cast("timestamp")
    events = sales_events(spark, sf_dir).withColumn("arrived", quarter if arrived is None else arrived)
    lines = messages(events, carry=("arrived",)).transform(ingest.with_message).transform(ingest.with_missing_fields)
    return ingest.stamp(ingest.accepted(lines), F.col("arrived"))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    root = Layout(work_dir(spark, "bronze")).bronze
    bronze.write_bronze(_stamped(spark, sf_dir), root, "load-0")
    return root


def _bronze_columns(df: DataFrame) -> DataFrame:
    """Raw fields in comparable form: numbers as numbers, instants as text."""
    numbers = ("quantity", "unit_price", "total_price")
    instants = ("timestamp", "ingested_at")
    return _texts(
        df.select(
            *[
                (fn.money(F.col(c)) if c in numbers else fn.parse_instant(F.col(c)) if c in instants else F.col(c)).alias(c)
                for c in (*REQUIRED_FIELDS, "ingested_at", "source_system")
            ],
            *[F.col(c) for c in DAY_COLUMNS],
        )
    ).withColumnRenamed("timestamp", "sale_ts")


@query("bronze_ndjson_roundtrip")
def bronze_ndjson_roundtrip(spark, sf_dir):
    return _bronze_columns(bronze.scan_bronze(spark, _landed(spark, sf_dir)))


@query("bronze_day_scan")
def bronze_day_scan(spark, sf_dir):
    return _bronze_columns(bronze.scan_bronze(spark, _landed(spark, sf_dir), DELIVERY_DAY))


@query("bronze_compact_day")
def bronze_compact_day(spark, sf_dir):
    """A closed day landed in three batches, before and after they are merged: the same lines."""
    root = Layout(work_dir(spark, "bronze")).bronze
    lines = stored(_stamped(spark, sf_dir), "stamped")
    for k in range(3):
        bronze.write_bronze(lines.where(F.pmod(F.xxhash64(ingest.MESSAGE), F.lit(3)) == k), root, f"load-{k}")
    bronze.compact_day(spark, root, DELIVERY_DAY)
    return _bronze_columns(bronze.scan_bronze(spark, root))


# Fields that some orders' messages carry on top of the declared ones: how often, and the JSON text.
PLANTED = {"loyalty_points": (7, "12"), "channel": (11, '"web"'), "tags": (17, '["a","b"]'), "address": (19, '{"zip":"1"}'),
           "coupon": (23, "null"), "gift": (29, "true")}
QUOTED_EVERY = 13  # of these orders the quantity comes as text


@query("schema_drift")
def schema_drift(spark, sf_dir):
    """The fields of a landed day against the declared ones, after some messages brought more fields and another type."""
    extra = [F.when(F.col("l_orderkey") % every == 0, F.lit(f',"{name}":{value}')).otherwise("") for name, (every, value) in PLANTED.items()]
    text = F.concat(F.substr("value", F.lit(1), F.length("value") - 1), *extra, F.lit("}"))
    sound = messages(sales_events(spark, sf_dir), carry=("l_orderkey",)).where(F.col("value").endswith("}"))
    quoted = F.when(F.col("l_orderkey") % QUOTED_EVERY == 0, F.regexp_replace(text, '"quantity":([0-9.]+)', '"quantity":"$1"'))
    lines = sound.select(F.coalesce(quoted, text).alias("value")).transform(ingest.with_message).transform(ingest.with_missing_fields)
    root = Layout(work_dir(spark, "bronze")).bronze
    bronze.write_bronze(ingest.stamp(ingest.accepted(lines), F.lit(str(DELIVERY_DAY)).cast("timestamp")), root, "load-0")
    return drift.schema_drift(bronze.scan_lines(spark, root, DELIVERY_DAY)).drop("type")


@query("encode_json_lines")
def encode_json_lines(spark, sf_dir):
    """Valid rows to JSON lines and back."""
    rows = _valid(spark, sf_dir).select("transaction_id", "product_id", "quantity", "store_id", "sale_timestamp")
    line = ingest.encode(_texts(rows))
    return line.select(
        *[F.get_json_object("line", f"$.{c}").alias(c) for c in rows.columns],
        F.size(F.json_object_keys("line")).alias("fields"),
    )


@query("partition_from_path")
def partition_from_path(spark, sf_dir):
    """Lines per day, the day taken from the path of files read without partition columns."""
    root = _landed(spark, sf_dir)
    lines = spark.read.text(f"{root}/*/*/*/*").withColumns(day_from_path(F.col("_metadata.file_path")))
    return lines.groupBy(*DAY_COLUMNS).agg(F.count("*").alias("lines"))


def _tagged_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines, typed and tagged, with the day they were landed on."""
    lines = bronze.scan_bronze(spark, _landed(spark, sf_dir))
    return tagged_lines(lines, processed_at=_clock(), carry=DAY_COLUMNS)


def _silver_lake(spark: SparkSession, sf_dir: str, times: int = 1) -> str:
    """Silver by ingestion day, written ``times`` times over."""
    root = Layout(work_dir(spark, "silver_lake")).silver
    valid = quality.valid(_tagged_by_day(spark, sf_dir))
    for _ in range(times):
        lake.overwrite_days(valid, root, laid_out=True)  # as the bronze files lie
    return root


@query("silver_day_scan")
def silver_day_scan(spark, sf_dir):
    silver = _silver_lake(spark, sf_dir)
    return _texts(lake.scan_days(spark, silver, SILVER, DELIVERY_DAY).drop("processed_at"))


@query("silver_overwrite_idempotent")
def silver_overwrite_idempotent(spark, sf_dir):
    silver = _silver_lake(spark, sf_dir, times=2)
    return _texts(lake.scan_days(spark, silver, SILVER).drop("processed_at"))


REPLACED_FROM, EMPTIED_DAY = "1998", date(1998, 10, 1)


@query("day_replacement")
def day_replacement(spark, sf_dir):
    """What a reader finds by day before, during and after a backfill of the last years that breaks off on the way.

    The backfill corrects every line and empties one day. Once it was only staged, once decided but not carried out.
    """
    root = _silver_lake(spark, sf_dir)
    late = lake.scan_days(spark, root, SILVER).where(F.col("year") >= REPLACED_FROM)
    late = late.where(F.concat_ws("-", *DAY_COLUMNS) != str(EMPTIED_DAY)).withColumn("quantity", F.col("quantity") + 1)

    def seen(phase: str) -> DataFrame:
        days = lake.scan_days(spark, root, SILVER).groupBy(*DAY_COLUMNS)
        found = days.agg(F.count("*").alias("lines"), F.sum("quantity").alias("units"), F.sum(fn.cents(F.col("total_price"))).alias("cents"))
        return stored(found.withColumn("phase", F.lit(phase)), "seen")

    phases = [seen("before")]
    filled = lake.stage_days(late, root, laid_out=True)
    phases.append(seen("staged"))
    versions.decide(spark, root, filled, [day_folder(EMPTIED_DAY)])
    phases.append(seen("decided"))
    versions.finish_pending(spark, root)
    phases.append(seen("after"))
    return functools.reduce(DataFrame.unionByName, phases)


@query("quarantine_roundtrip")
def quarantine_roundtrip(spark, sf_dir):
    root = Layout(work_dir(spark, "quarantine_lake")).quarantine
    lake.overwrite_days(quality.quarantined(_tagged_by_day(spark, sf_dir)), root, partitions=(quality.REASON,))
    rows = lake.scan_days(spark, root, QUARANTINE, partitions=(quality.REASON,))
    return _texts(rows.drop("processed_at"))


@query("fact_overwrite_idempotent")
def fact_overwrite_idempotent(spark, sf_dir):
    silver = _silver_lake(spark, sf_dir)
    root = Layout(work_dir(spark, "fact_lake")).fact
    fact = star.fact_sales(lake.scan_days(spark, silver, SILVER), carry=DAY_COLUMNS)
    for _ in range(2):
        lake.overwrite_days(fact, root, laid_out=True)  # as the silver files lie
    return _texts(lake.scan_days(spark, root, FACT_SALES).drop("processed_at"))


# ---------------------------------------------------------------- ingest


def _checked(spark: SparkSession, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    lines = messages(sales_events(spark, sf_dir), carry)
    return lines.transform(ingest.with_message).transform(ingest.with_missing_fields)


@query("decode_messages")
def decode_messages(spark, sf_dir):
    decoded = ingest.decode(messages(sales_events(spark, sf_dir)))
    return decoded.select(
        *[c for c in REQUIRED_FIELDS if c not in ("quantity", "unit_price", "total_price", "timestamp")],
        *[fn.money(F.col(c)).alias(c) for c in ("quantity", "unit_price", "total_price")],
        F.date_format(fn.parse_instant(F.col("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("sale_ts"),
        F.col("_corrupt_record").isNotNull().alias("malformed"),
    )


@query("required_fields_filter")
def required_fields_filter(spark, sf_dir):
    kept = ingest.accepted(_checked(spark, sf_dir))
    return kept.select(
        *[F.get_json_object(ingest.MESSAGE, f"$.{c}").alias(c) for c in ("transaction_id", "product_id", "store_id")]
    )


@query("missing_field_report")
def missing_field_report(spark, sf_dir):
    return ingest.missing_field_report(_checked(spark, sf_dir))


@query("ingest_metrics")
def ingest_metrics(spark, sf_dir):
    return ingest.ingest_metrics(_checked(spark, sf_dir))


@query("lineage_stamp")
def lineage_stamp(spark, sf_dir):
    stamped = ingest.stamp(_checked(spark, sf_dir), _clock())
    return _texts(
        stamped.select(
            F.get_json_object(ingest.MESSAGE, "$.transaction_id").alias("transaction_id"), "ingested_at", "source_system"
        )
    )


@query("late_arrivals")
def late_arrivals(spark, sf_dir):
    """Lines that reach the lake, with their shipment, on another day than they were sold."""
    stamped = ingest.stamp(sales_events(spark, sf_dir), F.col("ship_ts"))
    late = ingest.late_arrivals(stamped, "sale_ts")
    return _texts(late.select("transaction_id", "product_id", "event_day", "ingest_day", "days_late"))


@query("repartition_by_transaction")
def repartition_by_transaction(spark, sf_dir):
    """How many partitions each basket touches after the repartition."""
    lines = raw_lines(sales_events(spark, sf_dir))
    placed = ingest.repartition_by_basket(lines).withColumn("partition", F.spark_partition_id())
    baskets = placed.groupBy("transaction_id", "partition").agg(F.count("*").alias("lines"))
    return (
        baskets.where(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(F.count("*").alias("partitions"), F.sum("lines").alias("lines"))
    )


# ---------------------------------------------------------------- streaming


# Lines per landing file, and micro-batches in which a stream takes what is there.
FILE_LINES, PULLS = 10_000, 4


def _drop_files(df: DataFrame, folder: str) -> None:
    df.select("value").write.mode("append").options(maxRecordsPerFile=FILE_LINES, compression="gzip").text(folder)


def _landing(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of a landing folder, a part of its files a pull."""
    files = len(spark.read.text(folder).inputFiles())
    return bronze.landing_stream(spark, folder, max_files=-(-files // PULLS))


def _stream_columns(df: DataFrame) -> DataFrame:
    return _bronze_columns(df).drop("ingested_at", *DAY_COLUMNS)


def _ingested(spark: SparkSession, sf_dir: str) -> Layout:
    """All messages dropped as files and landed by the stream."""
    layout, landing = Layout(work_dir(spark, "stream")), work_dir(spark, "landing")
    _drop_files(messages(sales_events(spark, sf_dir)), landing)
    run_bronze_stream(_landing(spark, landing), layout)
    return layout


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    return _stream_columns(bronze.scan_bronze(spark, _ingested(spark, sf_dir).bronze))


@query("stream_dead_letter")
def stream_dead_letter(spark, sf_dir):
    layout = _ingested(spark, sf_dir)
    letters = spark.read.schema(f"{ingest.REASON} string, {ingest.MISSING} array<string>, {ingest.MESSAGE} string")
    return letters.json(layout.dead_letter).select(
        F.col(ingest.REASON),
        F.concat_ws(",", ingest.MISSING).alias("missing_fields"),
        F.when(F.col(ingest.REASON) == ingest.MISSING_REASON, F.get_json_object(ingest.MESSAGE, "$.transaction_id")).alias(
            "transaction_id"
        ),
    )


@query("stream_restart_no_dup")
def stream_restart_no_dup(spark, sf_dir):
    """Two deliveries and an idle restart on one checkpoint."""
    layout, landing = Layout(work_dir(spark, "stream")), work_dir(spark, "landing")
    lines = messages(sales_events(spark, sf_dir), carry=("sale_ts",))
    early = F.coalesce(F.col("sale_ts") < HISTORY_ENDS, F.lit(False))
    _drop_files(lines.where(early), landing)
    run_bronze_stream(bronze.landing_stream(spark, landing), layout)
    _drop_files(lines.where(~early), landing)
    for _ in range(2):
        run_bronze_stream(bronze.landing_stream(spark, landing), layout)
    return _stream_columns(bronze.scan_bronze(spark, layout.bronze))


SHARDS, BROKEN_SHARD = 4, 3


def _break(spark: SparkSession, folder: str) -> Callable[[], None]:
    """Make a landed file unreadable; returns what delivers it again."""
    (path, *_) = sorted(spark.read.text(folder).inputFiles())
    fs, file = file_system(spark, path)
    _, kept = file_system(spark, f"{folder}-kept/{path.rpartition('/')[2]}")
    fs.mkdirs(kept.getParent())
    fs.rename(file, kept)
    write_text(spark, path, "no gzip")

    def deliver() -> None:
        fs.delete(file, False)
        fs.rename(kept, file)

    return deliver


@query("stream_shards")
def stream_shards(spark, sf_dir):
    """Messages in four shards, one with an unreadable file: what is landed then, and after the file came again."""
    layout, landing = Layout(work_dir(spark, "shards")), work_dir(spark, "landing")
    shard = F.pmod("l_orderkey", F.lit(SHARDS)).cast("string")
    lines = messages(sales_events(spark, sf_dir), carry=("l_orderkey",)).select("value", shard.alias("shard"))
    lines.write.option("compression", "gzip").partitionBy("shard").text(landing)
    folders = {str(k): f"{landing}/shard={k}" for k in range(SHARDS)}
    streams = {name: functools.partial(bronze.landing_stream, spark, folder) for name, folder in folders.items()}
    deliver = _break(spark, folders[str(BROKEN_SHARD)])

    def landed(phase: str) -> DataFrame:
        run_shards(spark, layout, streams, attempts=2, pause=0.1)
        rows = bronze.scan_bronze(spark, layout.bronze)
        found = F.regexp_extract(bronze.BATCH, r"-(\d+)-\d+$", 1).cast("int")
        return stored(_shard_rows(rows.select("*", found.alias("shard")), phase), "landed")  # more rows land in the same folders later

    first = landed("broken")
    deliver()
    return first.unionByName(landed("repaired"))


def _shard_rows(rows: DataFrame, phase: str) -> DataFrame:
    columns = ("transaction_id", "product_id", "store_id", "client_type", "source_system", "shard")
    return rows.select(*columns, fn.money(F.col("quantity")).alias("quantity"), F.lit(phase).alias("phase"))


@query("stream_batch_metrics")
def stream_batch_metrics(spark, sf_dir):
    """The counts of all batches of a stream that was stopped and restarted in between, added up."""
    layout, landing = Layout(work_dir(spark, "stream")), work_dir(spark, "landing")
    lines = messages(sales_events(spark, sf_dir), carry=("sale_ts",))
    early = F.coalesce(F.col("sale_ts") < HISTORY_ENDS, F.lit(False))
    for part in (early, ~early):
        _drop_files(lines.where(part), landing)
        run_bronze_stream(_landing(spark, landing), layout)
    return batch_metrics(spark, layout).agg(*[F.sum(name).alias(name) for name in ingest.METRICS])


@query("stream_dedupe")
def stream_dedupe(spark, sf_dir):
    """Every message delivered twice, in two batches; each distinct line comes out once."""
    landing, out, state = (work_dir(spark, name) for name in ("landing", "deduped", "dedupe_state"))
    lines = raw_lines(sales_events(spark, sf_dir)).select(
        F.to_json(F.struct(*REQUIRED_FIELDS), {"ignoreNullFields": "false"}).alias("value")
    )

    def run() -> None:
        arriving = ingest.stamp(ingest.decode(bronze.landing_stream(spark, landing)))
        unique = drop_replays(arriving.select(*REQUIRED_FIELDS, "ingested_at"), REQUIRED_FIELDS)
        writer = unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        with state_partitions(spark, stored_bytes(spark, landing)):
            running = writer.trigger(availableNow=True).start()
        running.awaitTermination()

    for _ in range(2):
        _drop_files(lines, landing)
        run()
    unique = spark.read.parquet(out)
    return unique.select(
        *[c for c in REQUIRED_FIELDS if c not in ("quantity", "unit_price", "total_price", "timestamp")],
        *[fn.money(F.col(c)).alias(c) for c in ("quantity", "unit_price", "total_price")],
        F.date_format(fn.parse_instant(F.col("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("sale_ts"),
    )


# ---------------------------------------------------------------- insights


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_sales(merge.dedupe_latest(_valid(spark, sf_dir), SILVER_KEYS))


def _opening(fact: DataFrame) -> DataFrame:
    """Opening stock per shelf: 40 units (a parameter table in real use)."""
    return fact.select(*insights.SHELF).distinct().withColumn("opening_units", F.lit(40))


def _thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safety stock per product: its size in the part table."""
    part = table(spark, sf_dir, "part")
    product_id = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    return part.select(fn.surrogate_key(product_id).alias("product_key"), F.col("p_size").alias("safety_units"))


@query("sales_velocity")
def sales_velocity(spark, sf_dir):
    return insights.sales_velocity(_fact(spark, sf_dir))


@query("stock_level")
def stock_level(spark, sf_dir):
    fact = insights.with_packed_shelves(stored(_fact(spark, sf_dir), "fact"))
    return insights.with_unpacked_shelves(insights.stock_level(fact, _opening(fact)))


@query("low_stock_alerts")
def low_stock_alerts(spark, sf_dir):
    fact = insights.with_packed_shelves(stored(_fact(spark, sf_dir), "fact"))
    thresholds = insights.with_packed_shelves(_thresholds(spark, sf_dir))
    return insights.with_unpacked_shelves(insights.low_stock_alerts(insights.stock_level(fact, _opening(fact)), thresholds))


@query("demand_baseline")
def demand_baseline(spark, sf_dir):
    return insights.demand_baseline(_fact(spark, sf_dir))


@query("calendar_velocity")
def calendar_velocity(spark, sf_dir):
    return insights.calendar_velocity(_fact(spark, sf_dir))


@query("calendar_baseline")
def calendar_baseline(spark, sf_dir):
    return insights.calendar_baseline(_fact(spark, sf_dir))


@query("velocity_spans")
def velocity_spans(spark, sf_dir):
    fact = insights.with_packed_shelves(_fact(spark, sf_dir))
    return _texts(insights.with_unpacked_shelves(insights.velocity_spans(fact)))


# Every fifth quantity brings a delivery of so many units a month after the sale.
REORDER_EVERY, REORDER_UNITS, OPENING_UNITS = 5, 60, 40


@query("low_stock_events")
def low_stock_events(spark, sf_dir):
    """Crossings of the safety stock over a stream of sales and deliveries, a year of days a batch, restarted on the way."""
    landing, out, state = (work_dir(spark, name) for name in ("movements", "stock_events", "stock_state"))
    facts = stored(_fact(spark, sf_dir).withColumn("day", F.to_date("sale_timestamp")), "fact")
    sold = facts.select(*insights.SHELF, "day", (-F.col("quantity")).cast("bigint").alias("change"))
    reordered = facts.where(F.col("quantity") % REORDER_EVERY == 0)
    delivered = reordered.select(*insights.SHELF, F.add_months("day", 1).alias("day"), F.lit(REORDER_UNITS).cast("bigint").alias("change"))
    movements = sold.unionByName(delivered).join(_thresholds(spark, sf_dir), "product_key")
    movements = movements.withColumns({"opening_units": F.lit(OPENING_UNITS).cast("bigint"), "safety_units": F.col("safety_units").cast("bigint")})
    movements = stored(movements, "movements")
    years = sorted(row[0] for row in movements.select(F.year("day")).distinct().collect())  # a handful
    for year in years:
        movements.where(F.year("day") == year).write.mode("append").parquet(landing)  # all its files are one batch
        arriving = spark.readStream.schema(movements.schema).parquet(landing)
        writer = stock_events(arriving).writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        with state_partitions(spark, stored_bytes(spark, landing)):
            writer.trigger(availableNow=True).start().awaitTermination()
    return _texts(spark.read.parquet(out))


@query("anomaly_flags")
def anomaly_flags(spark, sf_dir):
    fact = stored(_fact(spark, sf_dir), "fact")
    return _texts(insights.anomaly_flags(fact).drop("processed_at"))
