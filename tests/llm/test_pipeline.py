"""The pipeline stage by stage on awkward documents, and its registration."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_operators import DOCUMENTS, PIECES, awkward, expected_components, plain_counts
from tillworks.llm import compression_classifier, entropy_mix, quality_rules, sentence_pieces
from tillworks.llm.queries import ORACLE_SQL, QUERIES
from tillworks.llm.texts import id_remainder

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return awkward(seed=12)


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS)


def test_stage_order_and_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "minhash near-dedup", "entropy mix", "sentence pieces",
    ]
    dealt = [name for name in QUERIES if not name.startswith("base_")]
    assert sorted(int(name[2:].split("_")[0]) for name in dealt) == list(range(1, 14))
    assert {name.removeprefix("base_") for name in QUERIES} == set(dealt)
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_each_stage_decides_on_its_input(spark, docs, rows):
    key = lambda r: tuple(r)
    given = Counter(map(key, docs.collect()))

    kept = corpus_pipeline.quality_classifier(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where(id_remainder("doc_id", 3) != 1)
    model = compression_classifier.fit(docs, labels)
    expected = Counter(key(r) for r in docs.collect() if model.scores([r.text])[0] >= corpus_pipeline.LEAST_SCORE)
    assert Counter(map(key, kept.collect())) == expected

    ruled = corpus_pipeline.rules(spark, docs, SF_DIR)
    assert ruled.columns == docs.columns
    judged = quality_rules.judge(docs, out="verdict").where("verdict.kept").drop("verdict")
    assert Counter(map(key, ruled.collect())) == Counter(map(key, judged.collect())) <= given
    assert all(plain_counts(r.text)[0] >= 20 for r in ruled.collect())

    single = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    bearers = {i for i, _, c in expected_components(rows) if i == c}
    assert Counter(map(key, single.collect())) == Counter(key(r) for r in docs.collect() if r.doc_id in bearers)

    mixed = corpus_pipeline.source_mix(spark, docs, SF_DIR)
    assert mixed.columns == docs.columns
    dealt = Counter()
    for r in entropy_mix.mix(docs).collect():
        dealt[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +dealt

    encoder = sentence_pieces.encoder(PIECES)
    encoded = corpus_pipeline.encode(spark, docs, SF_DIR).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in encoded) == Counter((r[0], len(encoder.encode(r[1]))) for r in rows)


def test_stages_of_nothing(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF_DIR).collect()
        docs = spark.createDataFrame(rows, stage(spark, docs, SF_DIR).schema)
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == Counter(map(tuple, rows))
    assert len(rows) > 0 and docs.select(F.max("n_tokens")).first()[0] > 0
