"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tillworks.llm import byte_fst, collocations, compression_classifier, entropy_mix, lattice_lm, merkle, minhash, projection_dedup, quality_rules, sentence_pieces, shard_table, token_records, url_templates
from tillworks.llm.texts import id_remainder, lean_batches
from tillworks.session import work_dir

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-records")
    token_records.write(_table(spark, sf_dir, "documents"), path, BYTE_TOKENIZER)
    return token_records.digest(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "shard")


def op2_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = compression_classifier.fit(documents, labels.where(id_remainder("doc_id", 3) != 1))
    scored = documents.select("doc_id", compression_classifier.score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = entropy_mix.mix(_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), "copies"
    )


SHARDS = [f"shard-{k:03d}" for k in range(256)]


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_table.place(_table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)
    return placed.select("doc_id", "slot", "shard")


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 7) == 2
    model = lattice_lm.fit(documents, PIECE_MODEL, ~held_out)
    return lattice_lm.score(documents, model, carry=(held_out.alias("held_out"),))


URL_RULES = {  # fixed values of the task
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    lean_batches(spark)
    documents = _table(spark, sf_dir, "documents")
    return documents.select("doc_id", sentence_pieces.round_trip_digest(F.col("text"), PIECE_MODEL).alias("d")).select("doc_id", "d.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"), keep=("doc_id",))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[F.col("quality")[name].alias(name) for name in names])


def op11_byte_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    lean_batches(spark)
    documents = _table(spark, sf_dir, "documents")
    return documents.select("doc_id", byte_fst.round_trip_digest(F.col("text"), BYTE_RANKS).alias("d")).select("doc_id", "d.*")


LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")  # fixed values of the task
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "merkle")
    lowered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in LEAF_COLUMNS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    manifest = merkle.build(
        _table(spark, sf_dir, "documents"), f"{path}/manifest", "doc_id", "source", LEAF_COLUMNS, carry={"tampered": F.when(chosen, merkle.leaf(lowered))}
    )
    found = merkle.proofs(manifest, manifest.leaves.drop("group"), f"{path}/descent")
    subroots = manifest.trees.select(F.col("tree").alias("of"), "subroot")
    checked = found.join(subroots, F.col("tree") == F.col("of")).select(
        F.col("id").alias("doc_id"), F.col("found").alias("leaf"), "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"), "rank",
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


# What of an operator's result is fixed by its input alone, for SQL to check; the rest depends on the method.


def base_op5_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op5_entropy_mix(spark, sf_dir)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), (F.col("taken") <= 3 * F.col("size")).alias("bounded"))


def base_op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = op6_sharding(spark, sf_dir)
    held = placed.groupBy("slot").agg(F.countDistinct("shard").alias("shards"))
    return placed.join(held, "slot").select("doc_id", "slot", "shards")


def base_op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = op7_lattice_lm(spark, sf_dir)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def base_op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled")
    return op8_url_filters(spark, sf_dir).select("page_id", "host", "path", "rule", ruled)


def base_op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = op10_quality_rules(spark, sf_dir)
    return judged.withColumn("refused", F.col("base_failed") & F.col("kept")).drop("kept")  # never both


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_records,
        op2_projection_dedup,
        op3_minhash_near_dedup,
        op4_quality_classifier,
        op5_entropy_mix,
        op6_sharding,
        op7_lattice_lm,
        op8_url_filters,
        op9_sentence_pieces,
        op10_quality_rules,
        op11_byte_fst,
        op12_merkle_manifest,
        op13_collocations,
        base_op5_entropy_mix,
        base_op6_sharding,
        base_op7_lattice_lm,
        base_op8_url_filters,
        base_op10_quality_rules,
    )
}

_REACHED = """
    reached(id, least) AS (SELECT DISTINCT id, id FROM ids UNION SELECT both_ways.b, reached.least
                           FROM reached JOIN both_ways ON reached.id = both_ways.a),
    parts AS (SELECT id, min(least) AS component_id FROM reached GROUP BY id)"""

# Unsigned crc32 of an id's decimal text, bit by bit (fixed value: the reversed polynomial 0xEDB88320).
_CRC32 = """xor(list_reduce([ascii(x) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')],
    lambda crc, byte: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, byte)), 4294967295), 4294967295)"""


_WORDS = "[y FOR y IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF y <> '']"
_LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"


def _merkle_sql(heights: int = 8, top_heights: int = 3) -> str:
    """The trees level by level; a tree that has come down to one node stays as it is."""
    def leaf(text: str) -> str:
        parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END" for c in (*LEAF_COLUMNS[:-1], text)]
        return f"sha256({' || '.join(parts)})"

    def climb(tree: str, highest: int) -> str:
        out = ""
        for k in range(highest):
            out += f"""{tree}{k + 1} AS (
                SELECT s, p // 16 AS p, list(d ORDER BY p) AS children, max(n) = 1 AS lone,
                       CASE WHEN max(n) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY p)) END AS d
                FROM (SELECT s, p, d, count(*) OVER (PARTITION BY s) AS n FROM {tree}{k}) GROUP BY s, p // 16),"""
        return out

    def siblings(tree: str, rank: str, s: str, highest: int, start: str) -> str:
        out = ""
        for k in range(highest):
            digit = f"CAST({rank} // {16**k} % 16 AS INT)"
            out += f"""{tree}_path{k + 1} AS (
                SELECT x.* EXCLUDE (proof, fold, lone, l, r), CASE WHEN lone THEN proof ELSE proof || l || r END AS proof,
                       CASE WHEN lone THEN fold ELSE sha256(l || fold || r) END AS fold
                FROM (SELECT x.*, lone, array_to_string(children[:{digit}], '') AS l, array_to_string(children[{digit} + 2:], '') AS r
                      FROM {start} AS x JOIN {tree}{k + 1} AS t ON t.s = {s} AND t.p = {rank} // {16 ** (k + 1)}) AS x),"""
            start = f"{tree}_path{k + 1}"
        return out

    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""
        WITH leaves AS (
            SELECT doc_id, source, {leaf("text")} AS leaf, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                   CASE WHEN {_CRC32} % 5 = 0 THEN {leaf(lower)} END AS tampered FROM documents),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves),
        g0 AS (SELECT tree AS s, rank AS p, leaf AS d FROM ranked),
        {climb("g", heights)}
        t0 AS (SELECT 0 AS s, s AS p, d FROM g{heights}),
        {climb("t", top_heights)}
        start AS (SELECT *, '' AS proof, coalesce(tampered, leaf) AS fold FROM ranked),
        {siblings("g", "rank", "tree", heights, "start")}
        {siblings("t", "tree", "0", top_heights, f"g_path{heights}")}
        found AS (SELECT x.*, g{heights}.d AS subroot, t{top_heights}.d AS root
                  FROM t_path{top_heights} AS x JOIN g{heights} ON g{heights}.s = x.tree CROSS JOIN t{top_heights})
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, rank, fold = root AS verified FROM found"""


#: SQL for those whose results are fixed by their inputs, the near-duplicates over all pairs. Sketches, trained models, library
#: encoders and a table filled by turns are not plain SQL; tests compare those with brute force instead.
ORACLE_SQL: dict[str, str] = {
    "op2_projection_dedup": f"""
        WITH RECURSIVE ids AS (SELECT vec_id AS id FROM embeddings),
        sound AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                  WHERE label IS NOT NULL AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
                    AND len([x for x in embedding if x <> 0]) > 0),
        links AS (SELECT a.id AS a, b.id AS b FROM sound AS a JOIN sound AS b ON a.label = b.label AND a.id < b.id
                  AND len(a.e) = len(b.e)
                  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        {_REACHED}
        SELECT id AS vec_id, (SELECT count(*) FROM both_ways WHERE a = parts.id) AS n_links, component_id,
               id = component_id AS kept
        FROM parts""",
    "op3_minhash_near_dedup": f"""
        WITH RECURSIVE ids AS (SELECT doc_id AS id FROM documents),
        split AS (SELECT doc_id AS id, [x for x in string_split_regex(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS w
                  FROM documents),
        shingles AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                         ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS s FROM split),
        sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
        common AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.id < b.id
                   GROUP BY a.id, b.id),
        links AS (SELECT a, b FROM common JOIN sizes AS x ON x.id = a JOIN sizes AS y ON y.id = b
                  WHERE 100 * k >= 75 * (x.n + y.n - k)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        {_REACHED}
        SELECT parts.id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, parts.id = component_id AS kept
        FROM parts LEFT JOIN sizes ON sizes.id = parts.id""",
    "op12_merkle_manifest": _merkle_sql(),
    "base_op5_entropy_mix": f"""
        WITH sized AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
        sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
                    FROM sized GROUP BY source),
        shares AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS weights,
                          coalesce(sum(3 * source_size) OVER before, 0) AS full_size, coalesce(sum(w) OVER before, 0) AS full_w
                   FROM sources WINDOW before AS (ORDER BY 3 * source_size / w, w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        levels AS (SELECT *, (total - full_size) / (weights - full_w) AS level FROM shares),
        water AS (SELECT max(level) AS surface FROM levels WHERE level <= 3 * source_size / w),
        targets AS (SELECT source, source_size, least(3 * source_size, w * coalesce(surface, 1e300)) AS target FROM levels CROSS JOIN water)
        SELECT doc_id, size, source_size, round(CAST(target AS DOUBLE), 3) AS target, true AS bounded
        FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source""",
    "base_op6_sharding": f"""
        SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {shard_table.SLOTS} AS INTEGER)
               AS slot, CAST(1 AS BIGINT) AS shards FROM documents""",
    "base_op7_lattice_lm": f"""
        WITH split AS (SELECT row_number() OVER () AS row, doc_id, {_CRC32} % 7 = 2 AS held_out, {_WORDS.replace("text", _LOWERED)} AS w FROM documents),
        tokens AS (SELECT row, held_out, unnest(w) AS token FROM split UNION ALL SELECT row, held_out, NULL FROM split),
        counts AS (SELECT token, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY token),
        sums AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM counts),
        scored AS (SELECT row, count(*) AS n_tokens, count(c) AS n_known, sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) AS base_score
                   FROM tokens LEFT JOIN counts ON tokens.token IS NOT DISTINCT FROM counts.token CROSS JOIN sums GROUP BY row)
        SELECT doc_id, held_out, n_tokens, n_known, n AS train_tokens, round(base_score, 4) AS base_score
        FROM split JOIN scored USING (row) CROSS JOIN sums""",
    "base_op8_url_filters": f"""
        WITH rules(rule, given) AS (VALUES {", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES.items())}),
        rests AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        hosts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS own, rest FROM rests),
        parts AS (SELECT row_number() OVER () AS row, page_id, translate(own, '{UPPER}', '{LOWER}') AS host,
                         regexp_extract(substr(rest, length(own) + 1), '^[^?#]*') AS path FROM hosts),
        fits AS (SELECT row, arg_max(rule, length(rule)) AS rule, arg_max(given, length(rule)) AS ruled
                 FROM parts JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
                  AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY row)
        SELECT page_id, host, path, rule, ruled FROM parts LEFT JOIN fits USING (row)""",
    "base_op10_quality_rules": f"""
        WITH split AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
                              [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF len({_WORDS.replace("text", "x")}) > 0] AS lines FROM documents),
        windows AS (SELECT row, i, array_to_string(w[i:i + 7], ' ') AS window_text
                    FROM (SELECT row, w, unnest(range(1, len(w) - 6)) AS i FROM split)),
        twice AS (SELECT row, window_text FROM windows GROUP BY row, window_text HAVING count(*) > 1),
        covered AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + 8)) AS place FROM windows SEMI JOIN twice USING (row, window_text))
                    GROUP BY row)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(list_sum([length(x) FOR x IN w]) AS BIGINT) AS word_chars,
               CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
               len(w) < 20 OR 100 * coalesce(n, 0) > 30 * len(w) AS base_failed, false AS refused
        FROM split LEFT JOIN covered USING (row)""",
    "op13_collocations": f"""
        WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
        pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
        words AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS w FROM pieces),
        placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
        counted AS MATERIALIZED (
            SELECT lang, w1, w2, w3, count(*) AS n
            FROM (SELECT lang, w[i] AS w1, CASE WHEN width > 1 THEN w[i + 1] ELSE '' END AS w2, CASE WHEN width > 2 THEN w[i + 2] ELSE '' END AS w3
                  FROM placed CROSS JOIN (VALUES (1), (2), (3)) AS widths(width) WHERE i + width - 1 <= len(w))
            GROUP BY ALL HAVING n >= 10 OR w2 = ''),
        totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counted WHERE w2 = '' GROUP BY lang),
        cuts AS (SELECT *, n AS a, 1 AS k, '' AS l2, w2 AS r1, w3 AS r2 FROM counted WHERE w2 <> ''
                 UNION ALL SELECT *, n, 2, w2, w3, '' FROM counted WHERE w3 <> ''),
        scored AS (SELECT c.*, x.n AS l, y.n AS r, CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
                   FROM cuts AS c JOIN counted AS x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.l2 AND x.w3 = ''
                   JOIN counted AS y ON y.lang = c.lang AND y.w1 = c.r1 AND y.w2 = c.r2 AND y.w3 = ''),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w1, w2, w3 ORDER BY score, k) = 1),
        inner_parts AS (SELECT lang, w1, w2, n FROM counted WHERE w3 <> '' UNION ALL SELECT lang, w2, w3, n FROM counted WHERE w3 <> ''),
        around AS (SELECT lang, w1, w2, '' AS w3, max(n) AS most FROM inner_parts GROUP BY ALL),
        kept AS (SELECT best.* EXCLUDE (n), trim(w1 || ' ' || w2 || ' ' || w3, ' ') AS phrase
                 FROM best LEFT JOIN around USING (lang, w1, w2, w3) WHERE 100 * coalesce(most, 0) < 50 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
}
