"""The same queries in plain SQL over the same tables, for a second engine to check.

Each query is a chain of named steps; only the steps it needs are put in front.
"""

from __future__ import annotations

import re

from tillworks.queries.spark_queries import (
    BATCH_STARTS, CLOCK_TEXT, CORRECTED, DELIVERIES, DELIVERY_DAY, EMPTIED_DAY, HISTORY_ENDS, REPLACED_FROM,
    BROKEN_SHARD, OPENING_UNITS, PLANTED, QUARTER, QUOTED_EVERY,
    REORDER_EVERY, REORDER_UNITS, SHARDS,
)

TS = "'%Y-%m-%d %H:%M:%S'"
DAY = "'%Y-%m-%d'"
COLUMNS = (
    "transaction_id, product_id, product_name, product_category, quantity, unit_price, total_price, "
    "store_id, payment_method, client_type"
)
SALES = f"{COLUMNS}, strftime(sale_timestamp, {TS}) AS sale_timestamp"
KEYS = ("product_key", "store_key", "payment_method_key", "client_type_key")
FACT = (
    "transaction_id, product_key, store_key, date_key, payment_method_key, client_type_key, "
    f"quantity, unit_price, total_price, strftime(sale_timestamp, {TS}) AS sale_timestamp"
)


def _title(name: str) -> str:
    """Capitalise a two-word name."""
    words = [f"split_part({name}, ' ', {i})" for i in (1, 2)]
    return " || ' ' || ".join(f"upper(substr({w}, 1, 1)) || lower(substr({w}, 2))" for w in words)


def _rule_case(rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN '{tag}'" for tag, when in rules) + " END"


def _rounded(product: str) -> str:
    return f"floor(({product}) * 100 + 0.5) / 100"


SALES_RULES = [
    ("null:transaction_id", "transaction_id IS NULL"),
    ("null:product_id", "product_id IS NULL"),
    ("null:store_id", "store_id IS NULL"),
    ("null:sale_timestamp", "sale_timestamp IS NULL"),
    ("invalid:quantity", "quantity IS NULL OR quantity <= 0"),
    ("invalid:unit_price", "unit_price IS NULL OR unit_price <= 0"),
    ("invalid:total_price", "total_price IS NULL OR total_price <= 0"),
    (
        "inconsistent:total_vs_unit_x_qty",
        f"abs(total_price - {_rounded('unit_price * quantity')}) > CAST(0.01 AS DOUBLE)",
    ),
]
OWN_RULES = [
    ("bulk:quantity", "quantity >= 45"),
    ("cheap:unit_price", "unit_price < 950"),
    ("null:store_id", "store_id IS NULL"),
]


def _fact_of(source: str) -> str:
    return f"""
        SELECT transaction_id, md5(product_id) AS product_key, md5(store_id) AS store_key,
               CAST(year(sale_timestamp) * 10000 + month(sale_timestamp) * 100 + day(sale_timestamp) AS INTEGER) AS date_key,
               md5(payment_method) AS payment_method_key, md5(client_type) AS client_type_key,
               quantity, unit_price, total_price, sale_timestamp
        FROM {source}"""


def _product_of(source: str) -> str:
    return f"""
        SELECT md5(product_id) AS product_key, product_id, product_name, product_category
        FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                ORDER BY lines DESC, product_name DESC NULLS LAST, product_category DESC NULLS LAST) AS pick
              FROM (SELECT product_id, product_name, product_category, count(*) AS lines FROM {source}
                    GROUP BY product_id, product_name, product_category) AS d) AS r
        WHERE pick = 1"""


def _member_of(source: str, key: str, natural: str) -> str:
    return f"SELECT DISTINCT md5({natural}) AS {key}, {natural} FROM {source}"


def _calendar(span: str) -> str:
    """Calendar rows of a (first_day, last_day) row."""
    day = "full_date"
    return f"""
        SELECT CAST(strftime({day}, '%Y%m%d') AS INTEGER) AS date_key, strftime({day}, {DAY}) AS full_date,
               CAST(year({day}) AS INTEGER) AS year, CAST(quarter({day}) AS INTEGER) AS quarter,
               CAST(month({day}) AS INTEGER) AS month, rpad(strftime({day}, '%B'), 9, ' ') AS month_name,
               CAST(weekofyear({day}) AS INTEGER) AS week_of_year, CAST(day({day}) AS INTEGER) AS day_of_month,
               CAST(isodow({day}) AS INTEGER) AS day_of_week, rpad(strftime({day}, '%A'), 9, ' ') AS day_name,
               isodow({day}) IN (6, 7) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS full_date
              FROM ({span}) AS s) AS d"""


def _span(source: str, column: str) -> str:
    return (
        f"SELECT min(date_trunc('day', {column})) AS first_day, max(date_trunc('day', {column})) AS last_day FROM {source}"
    )


def _merged(target: str, batch: str, keys: list[str], update: list[str], keep: list[str]) -> str:
    """Full outer join of two sets, unique on their keys, with a policy per column."""
    first = keys[0]
    columns = [f"coalesce(t.{k}, s.{k}) AS {k}" for k in keys]
    columns += [f"CASE WHEN s.{first} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in update]
    columns += [f"CASE WHEN t.{first} IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in keep]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return f"SELECT {', '.join(columns)} FROM {target} AS t FULL OUTER JOIN {batch} AS s ON {on}"


SILVER_UPDATES = ["product_name", "product_category", "quantity", "unit_price", "total_price", "sale_timestamp"]
SILVER_KEPT = ["store_id", "payment_method", "client_type"]
FACT_UPDATES = [
    "store_key", "date_key", "payment_method_key", "client_type_key", "quantity", "unit_price", "total_price", "sale_timestamp",
]

# Whether a message misses a field: odd orders leave NULL fields out.
NULLABLE = {
    "transaction_id": "transaction_id",
    "product_id": "product_id",
    "total_price": "total_price",
    "store_id": "store_id",
    "timestamp": "sale_ts",
}
CUT_OFF = "l_orderkey % 61 = 0"


def _missing(column: str) -> str:
    return f"(l_orderkey % 2 = 1 AND {column} IS NULL)"


ANY_MISSING = "(" + " OR ".join(_missing(c) for c in NULLABLE.values()) + ")"
MISSING_LIST = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {_missing(NULLABLE[f])} THEN '{f}' END" for f in sorted(NULLABLE)
) + ")"
ARRIVAL = "date_trunc('quarter', coalesce(sale_ts, ship_ts)) + INTERVAL 3 MONTH"
MESSAGE_FIELDS = "transaction_id, product_id, product_name, category, store_id, payment_method, client_type"
BRONZE = f"""
    {MESSAGE_FIELDS}, quantity, unit_price, total_price, strftime(sale_ts, {TS}) AS sale_ts,
    'kinesis_producer' AS source_system"""
ARRIVAL_DAY = "strftime(arrived, '%Y') AS year, strftime(arrived, '%m') AS month, strftime(arrived, '%d') AS day"

STEPS: dict[str, str] = {
    "sales_events": """
        SELECT CASE WHEN l_orderkey % 211 = 0 THEN NULL
                    ELSE concat(' T', CAST(l_orderkey AS VARCHAR), ' ') END AS transaction_id,
               CASE WHEN l_partkey % 199 = 0 THEN NULL
                    ELSE concat('P', CAST(l_partkey AS VARCHAR)) END AS product_id,
               p_name AS product_name,
               concat(' ', lower(p_type)) AS category,
               CASE WHEN l_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS quantity,
               CASE WHEN l_orderkey % 89 = 0 THEN CAST(-1 AS DOUBLE)
                    ELSE floor(l_extendedprice * 100 / l_quantity + 0.5) / 100 END AS unit_price,
               CASE WHEN l_orderkey % 83 = 0 THEN NULL
                    WHEN l_orderkey % 53 = 0 THEN l_extendedprice
                    ELSE floor((floor(l_extendedprice * 100 / l_quantity + 0.5) / 100) * l_quantity * 100 + 0.5) / 100
                    END AS total_price,
               CASE WHEN l_suppkey % 47 = 0 THEN NULL ELSE lower(s_name) END AS store_id,
               o_orderpriority AS payment_method,
               c_mktsegment AS client_type,
               CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE o_orderdate END AS sale_ts,
               l_shipdate AS ship_ts,
               l_orderkey
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    "typed": f"""
        SELECT trim(transaction_id) AS transaction_id, trim(product_id) AS product_id,
               {_title('product_name')} AS product_name, upper(trim(category)) AS product_category,
               CAST(trunc(quantity) AS INTEGER) AS quantity, unit_price, total_price,
               upper(trim(store_id)) AS store_id, upper(trim(payment_method)) AS payment_method,
               upper(trim(client_type)) AS client_type, CAST(sale_ts AS TIMESTAMP) AS sale_timestamp
        FROM sales_events""",
    "tagged": f"SELECT *, {_rule_case(SALES_RULES)} AS quarantine_reason FROM typed",
    "valid": f"SELECT {COLUMNS}, sale_timestamp FROM tagged WHERE quarantine_reason IS NULL",
    "silver": f"""
        SELECT {COLUMNS}, sale_timestamp
        FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id, product_id ORDER BY
                sale_timestamp DESC NULLS LAST, total_price DESC NULLS LAST, quantity DESC NULLS LAST,
                store_id DESC NULLS LAST, product_name DESC NULLS LAST, product_category DESC NULLS LAST,
                unit_price DESC NULLS LAST, payment_method DESC NULLS LAST, client_type DESC NULLS LAST) AS pick
              FROM valid) AS r
        WHERE pick = 1""",
    "history": f"SELECT * FROM silver WHERE sale_timestamp < TIMESTAMP '{HISTORY_ENDS} 00:00:00'",
    "batch": f"""
        SELECT transaction_id, product_id,
               CASE WHEN quantity % 2 = 1 THEN product_name END AS product_name, product_category,
               quantity + 1 AS quantity, unit_price, {_rounded('unit_price * (quantity + 1)')} AS total_price,
               concat('MOVED ', store_id) AS store_id,
               CASE WHEN quantity >= 40 THEN 'VOUCHER' ELSE payment_method END AS payment_method,
               CASE WHEN quantity >= 45 THEN 'STAFF' ELSE client_type END AS client_type, sale_timestamp
        FROM silver WHERE sale_timestamp >= TIMESTAMP '{BATCH_STARTS} 00:00:00'""",
    "merged_silver": _merged("history", "batch", ["transaction_id", "product_id"], SILVER_UPDATES, SILVER_KEPT),
    "valid_fact": _fact_of("valid"),
    "fact": _fact_of("silver"),
    "history_fact": _fact_of("history"),
    "batch_fact": _fact_of("batch"),
    "tagged_fact": _fact_of("tagged"),
    "unmoved": "SELECT * REPLACE (replace(store_id, 'MOVED ', '') AS store_id) FROM batch",
    "unmoved_fact": _fact_of("unmoved"),
    "renamed": """SELECT * REPLACE (CASE WHEN quantity % 7 = 0 THEN store_id ELSE replace(store_id, 'MOVED ', '') END AS store_id)
        FROM batch""",
    "renamed_fact": _fact_of("renamed"),
    "moved": """SELECT * REPLACE (CASE WHEN quantity % 5 = 0 THEN date_trunc('day', sale_timestamp) + INTERVAL 1 MONTH
        ELSE sale_timestamp END AS sale_timestamp) FROM batch""",
    "moved_silver": _merged("history", "moved", ["transaction_id", "product_id"], SILVER_UPDATES, SILVER_KEPT),
    "moved_batch_fact": _fact_of("moved"),
    "moved_fact": _merged("history_fact", "moved_batch_fact", ["transaction_id", "product_key"], FACT_UPDATES, []),
    "merged_fact": _merged("history_fact", "batch_fact", ["transaction_id", "product_key"], FACT_UPDATES, []),
    "history_product": _product_of("history"),
    "batch_product": _product_of("batch"),
    "dim_product": _product_of("silver"),
    "dim_store": _member_of("silver", "store_key", "store_id"),
    "dim_payment_method": _member_of("silver", "payment_method_key", "payment_method"),
    "dim_client_type": _member_of("silver", "client_type_key", "client_type"),
    "history_store": _member_of("history", "store_key", "store_id"),
    "history_payment": _member_of("history", "payment_method_key", "payment_method"),
    "history_client": _member_of("history", "client_type_key", "client_type"),
    "silver_dates": _calendar(_span("silver", "sale_timestamp")),
    "history_dates": _calendar(_span("history", "sale_timestamp")),
    "order_dates": _calendar(_span("orders", "o_orderdate")),
    "ship_dates": _calendar(_span("lineitem", "l_shipdate")),
    "landed": f"SELECT *, {ARRIVAL} AS arrived FROM sales_events WHERE NOT ({CUT_OFF}) AND NOT {ANY_MISSING}",
    "landed_typed": f"""
        SELECT trim(transaction_id) AS transaction_id, trim(product_id) AS product_id,
               {_title('product_name')} AS product_name, upper(trim(category)) AS product_category,
               CAST(trunc(quantity) AS INTEGER) AS quantity, unit_price, total_price,
               upper(trim(store_id)) AS store_id, upper(trim(payment_method)) AS payment_method,
               upper(trim(client_type)) AS client_type, CAST(sale_ts AS TIMESTAMP) AS sale_timestamp, ship_ts, {ARRIVAL_DAY}
        FROM landed""",
    "landed_tagged": f"SELECT *, {_rule_case(SALES_RULES)} AS quarantine_reason FROM landed_typed",
    "landed_valid": "SELECT * FROM landed_tagged WHERE quarantine_reason IS NULL",
    "landed_product": _product_of("landed_valid"),
    "landed_fact": _fact_of("landed_valid").replace("sale_timestamp\n", "sale_timestamp, year, month, day\n"),
    "daily": """
        SELECT product_key, store_key, date_key, sum(quantity) AS units,
               strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS sale_day
        FROM fact GROUP BY product_key, store_key, date_key""",
    "shelf_days": """
        SELECT s.product_key, s.store_key, d.sale_day, coalesce(units, 0) AS units, units IS NOT NULL AS sold
        FROM (SELECT product_key, store_key, min(sale_day) AS first_day FROM daily GROUP BY product_key, store_key) AS s
        JOIN (SELECT unnest(generate_series(min(sale_day), max(sale_day) + INTERVAL 6 DAY, INTERVAL 1 DAY)) AS sale_day
              FROM daily) AS d ON d.sale_day >= s.first_day
        LEFT JOIN daily AS x ON x.product_key = s.product_key AND x.store_key = s.store_key AND x.sale_day = d.sale_day""",
    "movements": """
        SELECT product_key, store_key, CAST(sale_timestamp AS DATE) AS day, -quantity AS change FROM fact
        UNION ALL
        SELECT product_key, store_key, CAST(CAST(sale_timestamp AS DATE) + INTERVAL 1 MONTH AS DATE), {reorder_units}
        FROM fact WHERE quantity % {reorder_every} = 0""".format(reorder_units=REORDER_UNITS, reorder_every=REORDER_EVERY),
    "stock": """
        SELECT product_key, store_key, date_key, CAST(units AS BIGINT) AS units,
               CAST(sum(units) OVER w AS BIGINT) AS sold_units, CAST(40 - sum(units) OVER w AS BIGINT) AS stock_units
        FROM daily
        WINDOW w AS (PARTITION BY product_key, store_key ORDER BY date_key ROWS UNBOUNDED PRECEDING)""",
    "moments": """
        SELECT product_key, count(*) AS n, sum(c) AS s, sum(c * c) AS q
        FROM (SELECT product_key, CAST(round(total_price * 100) AS HUGEINT) AS c FROM fact) AS f GROUP BY product_key""",
}


def _needs(sql: str) -> list[str]:
    """Steps a text reads from."""
    words = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", sql))
    return [name for name in STEPS if name in words]


def _with_steps(sql: str) -> str:
    wanted: set[str] = set()
    queue = _needs(sql)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue.extend(_needs(STEPS[name]))
    ahead = [f"{name} AS ({STEPS[name]})" for name in STEPS if name in wanted]
    return f"WITH {', '.join(ahead)} {sql}" if ahead else sql


def _absent(history: str, batch: str, key: str, natural: str) -> str:
    return f"""
        SELECT {key}, {natural} FROM {history}
        UNION ALL
        SELECT {key}, {natural} FROM ({_member_of(batch, key, natural)}) AS b
        WHERE NOT EXISTS (SELECT 1 FROM {history} AS h WHERE h.{key} = b.{key})"""


def _orphans(key: str, dim: str) -> str:
    return f"""
        SELECT 'fk:{key}' AS constraint_name, CAST({key} AS VARCHAR) AS missing_key, count(*) AS lines
        FROM (SELECT * FROM history_fact UNION ALL SELECT * FROM batch_fact) AS f
        WHERE {key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} AS d WHERE d.{key} = f.{key})
        GROUP BY {key}"""


def _violating(source: str, name: str, when: str, key: tuple[str, str]) -> str:
    identity = " || '/' || ".join(f"coalesce({k}, '?')" for k in key)
    return f"SELECT '{name}' AS constraint_name, {identity} AS row_key FROM {source} WHERE {when}"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _repeated(source: str, name: str, key: list[str]) -> str:
    identity = " || '/' || ".join(key)
    return (
        f"SELECT '{name}' AS constraint_name, {identity} AS row_key, count(*) AS copies FROM {source} "
        f"GROUP BY {', '.join(key)} HAVING count(*) > 1"
    )


LINE_KEY = ("transaction_id", "product_id")
FACT_KEY = ("transaction_id", "product_key")
GROWN = """(SELECT transaction_id, product_id, repeat(product_name, quantity) AS product_name,
    concat_ws('-', store_id, store_id, product_category, payment_method) AS store_id FROM valid) AS g"""
DELIVERED = " AND ".join(
    f"{part} = '{DELIVERY_DAY.strftime(form)}'" for part, form in (("year", "%Y"), ("month", "%m"), ("day", "%d"))
)
STAR_JOIN = """
    SELECT f.transaction_id, p.product_name, p.product_category, s.store_id, d.full_date, pm.payment_method,
           ct.client_type, f.quantity, f.unit_price, f.total_price
    FROM fact AS f
    JOIN dim_product AS p ON f.product_key = p.product_key
    JOIN dim_store AS s ON f.store_key = s.store_key
    JOIN silver_dates AS d ON f.date_key = d.date_key
    JOIN dim_payment_method AS pm ON f.payment_method_key = pm.payment_method_key
    JOIN dim_client_type AS ct ON f.client_type_key = ct.client_type_key"""
METRICS = """SELECT count(*) AS total_rows,
    count(*) FILTER (WHERE quarantine_reason IS NULL) AS valid_rows,
    count(*) FILTER (WHERE quarantine_reason IS NOT NULL) AS quarantined_rows"""


def _decimal_text(amount: str) -> str:
    """A non-negative amount with two decimals, from whole cents."""
    whole = f"CAST(floor({amount} * 100 + 0.5) AS BIGINT)"
    return f"concat(CAST({whole} // 100 AS VARCHAR), '.', lpad(CAST({whole} % 100 AS VARCHAR), 2, '0'))"


JSON_KINDS = {"1": "number", '"': "text", "[": "array", "{": "object", "n": "null", "t": "boolean"}
TEXT_FIELDS = ("transaction_id", "product_id", "product_name", "category", "timestamp", "store_id", "payment_method", "client_type",
               "ingested_at", "source_system")
# The seven tables, where their rows come from, and their columns with Spark's names of the types.
TABLES = {
    "sales_silver": ("silver", {
        "transaction_id": "string", "product_id": "string", "product_name": "string", "product_category": "string", "quantity": "int",
        "unit_price": "decimal(10,2)", "total_price": "decimal(10,2)", "store_id": "string", "payment_method": "string",
        "client_type": "string", "sale_timestamp": "timestamp", "processed_at": "timestamp"}),
    "dim_product": ("dim_product", {
        "product_key": "string", "product_id": "string", "product_name": "string", "product_category": "string"}),
    "dim_store": ("dim_store", {"store_key": "string", "store_id": "string"}),
    "dim_payment_method": ("dim_payment_method", {"payment_method_key": "string", "payment_method": "string"}),
    "dim_client_type": ("dim_client_type", {"client_type_key": "string", "client_type": "string"}),
    "dim_date": ("silver_dates", {
        "date_key": "int", "full_date": "date", "year": "int", "quarter": "int", "month": "int", "month_name": "string",
        "week_of_year": "int", "day_of_month": "int", "day_of_week": "int", "day_name": "string", "is_weekend": "boolean"}),
    "fact_sales": ("fact", {
        "sale_key": "bigint", "transaction_id": "string", "product_key": "string", "store_key": "string", "date_key": "int",
        "payment_method_key": "string", "client_type_key": "string", "quantity": "int", "unit_price": "decimal(10,2)",
        "total_price": "decimal(10,2)", "sale_timestamp": "timestamp", "processed_at": "timestamp"}),
}
CENTS = "CAST(sum(CAST(round(total_price * 100) AS BIGINT)) AS BIGINT)"


def _priced(columns: str) -> str:
    """The columns with both amounts as text."""
    for amount in ("unit_price", "total_price"):
        columns = columns.replace(f" {amount},", f" {_decimal_text(amount)} AS {amount},")
    return columns


def _message_value(column: str) -> str:
    """What a cut-off message decodes to: nothing."""
    return f"CASE WHEN {CUT_OFF} THEN NULL ELSE {column} END AS {column}"


QUERIES: dict[str, str] = {
    "silver_standardize": f"SELECT {SALES} FROM typed",
    "fn_text": f"""SELECT trim(transaction_id) AS trimmed_id, {_title('product_name')} AS title_name,
        upper(trim(category)) AS category_code, upper(trim(store_id)) AS store_code FROM sales_events""",
    "fn_casts": """SELECT transaction_id, CAST(trunc(quantity) AS INTEGER) AS quantity,
        CAST(trunc(unit_price) AS INTEGER) AS whole_price, CAST(NULL AS INTEGER) AS unreadable_quantity, total_price,
        CAST(NULL AS DOUBLE) AS unreadable_price FROM sales_events""",
    "fn_timestamp": f"""SELECT transaction_id, strftime(sale_ts, {TS}) AS sale_timestamp,
        strftime(ship_ts, {TS}) AS ship_timestamp, CAST(NULL AS VARCHAR) AS unreadable_timestamp FROM sales_events""",
    "fn_price_check": f"""SELECT transaction_id, product_id, {_rounded('unit_price * quantity')} AS expected_total,
        abs(total_price - {_rounded('unit_price * quantity')}) > CAST(0.01 AS DOUBLE) AS inconsistent FROM typed""",
    "fn_md5_keys": """SELECT md5(product_id) AS product_key, md5(store_id) AS store_key,
        md5(payment_method) AS payment_method_key, md5(client_type) AS client_type_key FROM typed""",
    "fn_date_key": """SELECT transaction_id, CAST(strftime(sale_timestamp, '%Y%m%d') AS INTEGER) AS date_key FROM typed""",
    "serving_decimal_cast": f"""SELECT transaction_id, product_id, {_decimal_text('unit_price')} AS unit_price,
        {_decimal_text('total_price')} AS total_price FROM valid""",
    "validate_first_failure": f"SELECT {SALES}, quarantine_reason FROM tagged",
    "silver_valid": f"SELECT {SALES} FROM valid",
    "quarantine_rows": f"SELECT {SALES}, quarantine_reason FROM tagged WHERE quarantine_reason IS NOT NULL",
    "quarantine_audit": """SELECT quarantine_reason, count(*) AS lines FROM tagged
        WHERE quarantine_reason IS NOT NULL GROUP BY quarantine_reason""",
    "quality_metrics": f"{METRICS} FROM tagged",
    "split_invariant": f"SELECT *, valid_rows + quarantined_rows = total_rows AS complete FROM ({METRICS} FROM tagged) AS m",
    "custom_rules": f"SELECT {SALES}, {_rule_case(OWN_RULES)} AS quarantine_reason FROM typed",
    "silver_preview": f"""SELECT {SALES} FROM (SELECT * FROM valid ORDER BY
        {', '.join(c + ' NULLS FIRST' for c in (COLUMNS + ', sale_timestamp').split(', '))} LIMIT 5) AS v""",
    "dim_product": _product_of("valid"),
    "dim_store": _member_of("valid", "store_key", "store_id"),
    "dim_payment_method": _member_of("valid", "payment_method_key", "payment_method"),
    "dim_client_type": _member_of("valid", "client_type_key", "client_type"),
    "dim_date": "SELECT * FROM order_dates",
    "dim_date_insert_absent": """SELECT * FROM order_dates UNION ALL
        SELECT * FROM ship_dates AS s WHERE NOT EXISTS (SELECT 1 FROM order_dates AS o WHERE o.date_key = s.date_key)""",
    "fact_sales_build": f"SELECT {FACT} FROM valid_fact",
    "star_join": STAR_JOIN,
    "star_join_top10": f"""SELECT * FROM ({STAR_JOIN}) AS j
        ORDER BY transaction_id, product_name NULLS FIRST, total_price, store_id, unit_price LIMIT 10""",
    "table_counts": _union(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {step}"
        for label, step in (
            ("fact_sales", "fact"),
            ("dim_product", "dim_product"),
            ("dim_store", "dim_store"),
            ("dim_payment_method", "dim_payment_method"),
            ("dim_client_type", "dim_client_type"),
        )
    ),
    "dedupe_latest": f"SELECT {SALES} FROM silver",
    "upsert_silver": f"SELECT {SALES} FROM merged_silver",
    "upsert_fact": f"SELECT {FACT} FROM merged_fact",
    "upsert_dim_product": _merged(
        "history_product", "batch_product", ["product_key"], ["product_name", "product_category"], ["product_id"]
    ),
    "upsert_null_overwrite": _merged(
        "history", "batch", ["transaction_id", "product_id"], ["product_name"], ["quantity", "store_id"]
    ),
    "upsert_idempotent": f"SELECT {SALES} FROM merged_silver",
    "insert_absent_dim_store": _absent("history_store", "batch", "store_key", "store_id"),
    "insert_absent_dim_payment_method": _absent("history_payment", "batch", "payment_method_key", "payment_method"),
    "insert_absent_dim_client_type": _absent("history_client", "batch", "client_type_key", "client_type"),
    "pk_duplicates": _union(
        [
            _repeated("valid", "pk_sales_silver", ["transaction_id", "product_id"]),
            _repeated("valid_fact", "uq_fact_sales", ["transaction_id", "product_key"]),
            _repeated(
                "(SELECT DISTINCT md5(product_id) AS product_key, product_name, product_category FROM valid) AS p",
                "pk_dim_product",
                ["product_key"],
            ),
        ]
    ),
    "fk_orphans": _union(
        [
            _orphans("product_key", "history_product"),
            _orphans("store_key", "history_store"),
            _orphans("date_key", "history_dates"),
            _orphans("payment_method_key", "history_payment"),
            _orphans("client_type_key", "history_client"),
        ]
    ),
    "assign_sale_key": """SELECT m.transaction_id, m.product_key, h.transaction_id IS NOT NULL AS kept,
        h.transaction_id IS NULL AS new_and_above, CAST(1 AS BIGINT) AS rows_with_key
        FROM merged_fact AS m LEFT JOIN history_fact AS h
        ON m.transaction_id = h.transaction_id AND m.product_key = h.product_key""",
    "serve_silver_rejects": f"""SELECT transaction_id, product_id,
        CASE WHEN length(repeat(product_name, quantity)) > 100 THEN 'varchar:product_name'
             WHEN {_rounded('total_price * 10000')} >= 100000000 THEN 'decimal:total_price' ELSE 'none' END AS broken_constraint
        FROM silver""",
    "serve_gold_rejects": """SELECT transaction_id, product_key,
        CASE WHEN product_key NOT IN (SELECT product_key FROM history_product) THEN 'fk:product_key'
             WHEN store_key NOT IN (SELECT store_key FROM history_store) THEN 'fk:store_key'
             WHEN date_key NOT IN (SELECT date_key FROM history_dates) THEN 'fk:date_key'
             WHEN payment_method_key NOT IN (SELECT payment_method_key FROM history_payment) THEN 'fk:payment_method_key'
             WHEN client_type_key NOT IN (SELECT client_type_key FROM history_client) THEN 'fk:client_type_key'
             ELSE 'none' END AS broken_constraint
        FROM renamed_fact""",
    "serving_merge_silver": f"""SELECT {_priced(SALES)}, strftime(sale_timestamp, '%Y%m') AS sale_period FROM moved_silver""",
    "serving_merge_fact": f"""SELECT {_priced(FACT)}, strftime(sale_timestamp, '%Y%m') AS sale_period FROM moved_fact""",
    "serving_merge_admitted": f"""SELECT {_priced(SALES)}, sale_period, hit_period AS admitted, hit_period AS rewritten
        FROM (SELECT * REPLACE (CASE WHEN hit THEN concat(product_name, ' (corrected)') ELSE product_name END AS product_name,
                     CASE WHEN hit THEN quantity + 1 ELSE quantity END AS quantity,
                     CASE WHEN hit THEN {_rounded('unit_price * (quantity + 1)')} ELSE total_price END AS total_price)
              FROM (SELECT *, hit_period AND quantity % 3 = 0 AS hit
                    FROM (SELECT *, strftime(sale_timestamp, '%Y%m') AS sale_period,
                                 strftime(sale_timestamp, '%Y%m') IN {CORRECTED} AS hit_period FROM silver) AS p) AS h) AS c""",
    "star_quarter": f"""SELECT * REPLACE ({_decimal_text('unit_price')} AS unit_price, {_decimal_text('total_price')} AS total_price)
        FROM ({STAR_JOIN} WHERE d.year = {QUARTER[0]} AND d.quarter = {QUARTER[1]}) AS q""",
    "tables_from_specs": _union(
        [
            f"""SELECT '{table}' AS table_name, phase, '{column}' AS column_name, {position} AS position, '{kind}' AS data_type,
                CASE WHEN phase = 'loaded' THEN filled ELSE 0 END AS filled
                FROM (SELECT count({'1' if column in ('sale_key', 'processed_at') else column}) AS filled FROM {source}) AS c
                CROSS JOIN (VALUES ('loaded'), ('recreated')) AS p(phase)"""
            for table, (source, columns) in TABLES.items()
            for position, (column, kind) in enumerate(columns.items(), 1)
        ]
    ),
    "schema_drift": _union(
        [
            *[
                f"""SELECT '{field}' AS field, '{kind}' AS kind, count(*) AS lines, count(*) FILTER (WHERE {null}) AS nulls,
                    '{status}' AS status FROM landed"""
                for field, kind, null, status in (
                    *[(f, "text", f"{NULLABLE[f]} IS NULL" if f in NULLABLE else "false", "declared") for f in TEXT_FIELDS],
                    ("unit_price", "number", "false", "declared"),
                    ("total_price", "number", "total_price IS NULL", "declared"),
                )
            ],
            f"""SELECT 'quantity', CASE WHEN bool_or(l_orderkey % {QUOTED_EVERY} = 0) THEN 'mixed' ELSE 'number' END, count(*), 0,
                CASE WHEN bool_or(l_orderkey % {QUOTED_EVERY} = 0) THEN 'changed' ELSE 'declared' END FROM landed""",
            *[
                f"""SELECT '{name}', '{JSON_KINDS[value[0]]}', count(*), {'count(*)' if value == 'null' else 0}, 'new' FROM landed
                    WHERE l_orderkey % {every} = 0 HAVING count(*) > 0"""
                for name, (every, value) in PLANTED.items()
            ],
        ]
    ),
    "dense_sale_key": f"""SELECT row_number() OVER (ORDER BY delivery, transaction_id, product_key) AS sale_key,
        transaction_id, product_key, quantity, strftime(sale_timestamp, '%Y%m') AS sale_period
        FROM (SELECT *, CASE {' '.join(f"WHEN sale_timestamp < TIMESTAMP '{end} 00:00:00' THEN {k}" for k, (_, end) in enumerate(DELIVERIES))}
              END AS delivery FROM fact) AS f""",
    "plan_silver_days": f"SELECT {SALES}, year, month, day, quarantine_reason FROM landed_tagged",
    "plan_gold_days": _union(
        [
            f"""SELECT 'fact_sales' AS name, key, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS units, {CENTS} AS cents,
                CAST(NULL AS VARCHAR) AS member FROM (SELECT *, CASE WHEN coalesce(sale_timestamp, ship_ts)
                >= TIMESTAMP '{BATCH_STARTS} 00:00:00' THEN '19980702' ELSE '19980701' END AS key FROM landed_valid) AS d GROUP BY key""",
            """SELECT 'dim_product', product_key, NULL, NULL, NULL, concat_ws('/', product_id, product_name, product_category)
                FROM landed_product""",
            *[
                f"SELECT 'dim_{name}', md5({natural}), NULL, NULL, NULL, {natural} "
                f"FROM (SELECT DISTINCT {natural} FROM landed_valid) AS {name}_members"
                for name, natural in (
                    ("store", "store_id"),
                    ("payment_method", "payment_method"),
                    ("client_type", "client_type"),
                )
            ],
        ]
    ),
    "day_replacement": _union(
        [
            *[
                f"""SELECT '{phase}' AS phase, year, month, day, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units,
                    {CENTS} AS cents FROM landed_valid GROUP BY year, month, day"""
                for phase in ("before", "staged", "decided")
            ],
            f"""SELECT 'after', year, month, day, count(*), CAST(sum(quantity + CASE WHEN year >= '{REPLACED_FROM}' THEN 1 ELSE 0 END) AS BIGINT),
                {CENTS} FROM landed_valid WHERE concat_ws('-', year, month, day) <> '{EMPTIED_DAY}' GROUP BY year, month, day""",
        ]
    ),
    "bronze_compact_day": f"SELECT {BRONZE}, strftime(arrived, {TS}) AS ingested_at, {ARRIVAL_DAY} FROM landed",
    "fk_accepted": f"""SELECT {FACT} FROM (SELECT * FROM history_fact UNION ALL SELECT * FROM unmoved_fact) AS f
        WHERE product_key IN (SELECT product_key FROM history_product)
          AND store_key IN (SELECT md5(store_id) FROM history WHERE NOT regexp_matches(store_id, '[05]$'))
          AND date_key IN (SELECT date_key FROM history_dates)
          AND payment_method_key IN (SELECT payment_method_key FROM history_payment)
          AND client_type_key IN (SELECT client_type_key FROM history_client)""",
    "not_null_violations": _union(
        [
            _violating("tagged_fact", f"not_null:{c}", f"{c} IS NULL", FACT_KEY)
            for c in ("transaction_id", *KEYS, "date_key")
        ]
    ),
    "varchar_violations": _union(
        [
            _violating(GROWN, "varchar:product_name", "length(product_name) > 100", LINE_KEY),
            _violating(GROWN, "varchar:store_id", "length(store_id) > 50", LINE_KEY),
        ]
    ),
    "decimal_overflow": _union(
        [
            _violating("valid", f"decimal:{c}", f"{_rounded(c + ' * 10000')} >= 100000000", LINE_KEY)
            for c in ("unit_price", "total_price")
        ]
    ),
    "bronze_ndjson_roundtrip": f"SELECT {BRONZE}, strftime(arrived, {TS}) AS ingested_at, {ARRIVAL_DAY} FROM landed",
    "bronze_day_scan": f"""SELECT * FROM (SELECT {BRONZE}, strftime(arrived, {TS}) AS ingested_at, {ARRIVAL_DAY} FROM landed)
        AS b WHERE {DELIVERED}""",
    "encode_json_lines": f"""SELECT transaction_id, product_id, CAST(quantity AS VARCHAR) AS quantity, store_id,
        strftime(sale_timestamp, {TS}) AS sale_timestamp, CAST(5 AS INTEGER) AS fields FROM valid""",
    "partition_from_path": f"""SELECT year, month, day, count(*) AS lines FROM (SELECT {ARRIVAL_DAY} FROM landed) AS b
        GROUP BY year, month, day""",
    "silver_day_scan": f"SELECT {SALES}, year, month, day FROM landed_valid WHERE {DELIVERED}",
    "silver_overwrite_idempotent": f"SELECT {SALES}, year, month, day FROM landed_valid",
    "quarantine_roundtrip": f"""SELECT {SALES}, year, month, day, quarantine_reason FROM landed_tagged
        WHERE quarantine_reason IS NOT NULL""",
    "fact_overwrite_idempotent": f"SELECT {FACT}, year, month, day FROM landed_fact",
    "decode_messages": f"""SELECT {', '.join(_message_value(c) for c in MESSAGE_FIELDS.split(', '))},
        {', '.join(_message_value(c) for c in ('quantity', 'unit_price', 'total_price'))},
        CASE WHEN {CUT_OFF} THEN NULL ELSE strftime(sale_ts, {TS}) END AS sale_ts, {CUT_OFF} AS malformed
        FROM sales_events""",
    "required_fields_filter": "SELECT transaction_id, product_id, store_id FROM landed",
    "missing_field_report": _union(
        f"""SELECT '{field}' AS field, count(*) AS messages FROM sales_events
            WHERE NOT ({CUT_OFF}) AND {_missing(column)} HAVING count(*) > 0"""
        for field, column in NULLABLE.items()
    ),
    "ingest_metrics": f"""SELECT count(*) AS messages,
        count(*) FILTER (WHERE NOT ({CUT_OFF}) AND NOT {ANY_MISSING}) AS accepted,
        count(*) FILTER (WHERE NOT ({CUT_OFF}) AND {ANY_MISSING}) AS incomplete,
        count(*) FILTER (WHERE {CUT_OFF}) AS malformed FROM sales_events""",
    "lineage_stamp": f"""SELECT CASE WHEN {CUT_OFF} THEN cut_id ELSE transaction_id END AS transaction_id,
        '{CLOCK_TEXT}' AS ingested_at, 'kinesis_producer' AS source_system
        FROM (SELECT *, CAST(NULL AS VARCHAR) AS cut_id FROM sales_events) AS e""",
    "late_arrivals": f"""SELECT transaction_id, product_id, strftime(sale_ts, {DAY}) AS event_day,
        strftime(ship_ts, {DAY}) AS ingest_day, CAST(date_diff('day', sale_ts, ship_ts) AS INTEGER) AS days_late
        FROM sales_events WHERE date_trunc('day', sale_ts) <> date_trunc('day', ship_ts)""",
    "repartition_by_transaction": """SELECT transaction_id, CAST(1 AS BIGINT) AS partitions, count(*) AS lines
        FROM sales_events WHERE transaction_id IS NOT NULL GROUP BY transaction_id""",
    "stream_ingest": f"SELECT {BRONZE} FROM landed",
    "stream_dead_letter": f"""SELECT CASE WHEN {CUT_OFF} THEN 'malformed' ELSE 'missing_fields' END AS reject_reason,
        CASE WHEN {CUT_OFF} THEN '' ELSE {MISSING_LIST} END AS missing_fields,
        CASE WHEN {CUT_OFF} THEN NULL ELSE transaction_id END AS transaction_id
        FROM sales_events WHERE {CUT_OFF} OR {ANY_MISSING}""",
    "stream_restart_no_dup": f"SELECT {BRONZE} FROM landed",
    "stream_shards": f"""SELECT transaction_id, product_id, store_id, client_type, 'kinesis_producer' AS source_system, quantity,
        CAST(l_orderkey % {SHARDS} AS INTEGER) AS shard, phase FROM landed CROSS JOIN (VALUES ('broken'), ('repaired')) AS p(phase)
        WHERE phase = 'repaired' OR l_orderkey % {SHARDS} <> {BROKEN_SHARD}""",
    "stream_batch_metrics": f"""SELECT count(*) AS messages,
        count(*) FILTER (WHERE NOT ({CUT_OFF}) AND NOT {ANY_MISSING}) AS accepted,
        count(*) FILTER (WHERE NOT ({CUT_OFF}) AND {ANY_MISSING}) AS incomplete,
        count(*) FILTER (WHERE {CUT_OFF}) AS malformed FROM sales_events""",
    "stream_dedupe": f"""SELECT DISTINCT {MESSAGE_FIELDS}, quantity, unit_price, total_price,
        strftime(sale_ts, {TS}) AS sale_ts FROM sales_events""",
    "sales_velocity": """SELECT product_key, store_key, date_key, CAST(units AS BIGINT) AS units,
        CAST(sum(units) OVER w AS DOUBLE) / count(*) OVER w AS avg_units FROM daily
        WINDOW w AS (PARTITION BY product_key, store_key ORDER BY sale_day
                     RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
    "stock_level": "SELECT * FROM stock",
    "low_stock_alerts": """SELECT k.*, p_size AS safety_units FROM stock AS k
        JOIN part ON k.product_key = md5(concat('P', CAST(p_partkey AS VARCHAR))) WHERE stock_units < p_size""",
    "demand_baseline": """SELECT product_key, store_key, date_key, CAST(units AS BIGINT) AS units,
        CAST(isodow(sale_day) AS INTEGER) AS day_of_week,
        CASE WHEN count(*) OVER w > 0 THEN CAST(sum(units) OVER w AS DOUBLE) / count(*) OVER w END AS expected_units
        FROM daily WINDOW w AS (PARTITION BY product_key, store_key, isodow(sale_day) ORDER BY date_key
                                ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""",
    "calendar_velocity": """SELECT product_key, store_key, CAST(strftime(sale_day, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(units AS BIGINT) AS units, avg_units
        FROM (SELECT *, CAST(sum(units) OVER w AS DOUBLE) / count(*) OVER w AS avg_units FROM shelf_days
              WINDOW w AS (PARTITION BY product_key, store_key ORDER BY sale_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) AS v
        WHERE sold""",
    "calendar_baseline": """SELECT product_key, store_key, CAST(strftime(sale_day, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(units AS BIGINT) AS units, CAST(isodow(sale_day) AS INTEGER) AS day_of_week, expected_units
        FROM (SELECT *, CASE WHEN count(*) OVER w > 0 THEN CAST(sum(units) OVER w AS DOUBLE) / count(*) OVER w END AS expected_units
              FROM shelf_days WINDOW w AS (PARTITION BY product_key, store_key, isodow(sale_day) ORDER BY sale_day
                                           ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)) AS v
        WHERE sold""",
    "velocity_spans": f"""SELECT product_key, store_key, strftime(min(sale_day), {DAY}) AS from_day, strftime(max(sale_day), {DAY}) AS to_day,
        CAST(window_units AS BIGINT) AS window_units, CAST(window_units AS DOUBLE) / 7 AS avg_units
        FROM (SELECT *, sum(CASE WHEN window_units IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER
                     (PARTITION BY product_key, store_key ORDER BY sale_day) AS span
              FROM (SELECT *, lag(window_units) OVER (PARTITION BY product_key, store_key ORDER BY sale_day) AS before
                    FROM (SELECT *, sum(units) OVER (PARTITION BY product_key, store_key ORDER BY sale_day
                                                     ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS window_units
                          FROM shelf_days) AS a) AS b) AS c
        WHERE window_units > 0 GROUP BY product_key, store_key, span, window_units""",
    "low_stock_events": f"""SELECT product_key, store_key, strftime(day, {DAY}) AS day, units, safety_units,
        CASE WHEN below THEN 'below' ELSE 'recovered' END AS event
        FROM (SELECT *, lag(below, 1, false) OVER (PARTITION BY product_key, store_key ORDER BY day) AS was_below
              FROM (SELECT m.product_key, store_key, day, CAST(p_size AS BIGINT) AS safety_units,
                           CAST({OPENING_UNITS} + sum(change) OVER w AS BIGINT) AS units,
                           {OPENING_UNITS} + sum(change) OVER w < p_size AS below
                    FROM (SELECT product_key, store_key, day, sum(change) AS change FROM movements GROUP BY product_key, store_key, day) AS m
                    JOIN part ON m.product_key = md5(concat('P', CAST(p_partkey AS VARCHAR)))
                    WINDOW w AS (PARTITION BY m.product_key, store_key ORDER BY day)) AS s) AS e
        WHERE below <> was_below""",
    "anomaly_flags": f"""SELECT * FROM (SELECT {FACT.replace('product_key', 'f.product_key AS product_key', 1)},
        CAST(n * CAST(round(total_price * 100) AS HUGEINT) - s AS DOUBLE) / sqrt(CAST(n * q - s * s AS DOUBLE)) AS z_score
        FROM fact AS f JOIN moments AS m ON f.product_key = m.product_key WHERE n * q - s * s > 0) AS z
        WHERE abs(z_score) > 2.5""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with_steps(sql) for name, sql in QUERIES.items()}
