"""A training corpus in stages: classify, filter by rules, drop near-duplicates, mix sources, encode.

Every stage takes and returns documents; ``run`` stores each stage's rows before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tillworks.functions import with_computed
from tillworks.llm import compression_classifier, entropy_mix, minhash, quality_rules, sentence_pieces
from tillworks.llm.texts import id_remainder, lean_batches
from tillworks.session import scratch, stored, work_dir

#: No stage's decisions can be written in SQL as a whole; tests compare with plain Python instead.
ORACLE_SQL = None
LEAST_SCORE = 0.5
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is at least ``LEAST_SCORE``; a third of the labels is held out from the fit."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(id_remainder("doc_id", 3) != 1)
    model = compression_classifier.fit(docs, labels)
    scored = with_computed(docs, "__lw_score", compression_classifier.score(model, F.col("text")))
    return scored.where(F.col("__lw_score") >= LEAST_SCORE).select(*docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fences of their language and source."""
    judged = quality_rules.judge(docs, out="__lw_quality")
    return judged.where(F.col("__lw_quality")["kept"]).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__lw_id"))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__lw_id")), "left_semi")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, so a source's words come near its target.

    Rows get a number of their own first, as ids may be NULL or repeat.
    """
    numbered = stored(docs.withColumn("__lw_row", F.monotonically_increasing_id()), "mix-documents")
    dealt = entropy_mix.mix(numbered, doc_id="__lw_row").where("copies > 0")
    dealt = dealt.select(F.col("doc_id").alias("__lw_row"), F.col("copies").alias("__lw_copies"))
    taken = numbered.join(dealt, "__lw_row")
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__lw_copies"))).alias("__lw_copy")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids, hash of the ids and hash of the decoded text of each document."""
    lean_batches(spark)
    digest = sentence_pieces.round_trip_digest(F.col("text"), PIECE_MODEL)
    return docs.select("doc_id", "source", digest.alias("d")).select("doc_id", "source", "d.*")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("minhash near-dedup", near_dedup),
    ("entropy mix", source_mix),
    ("sentence pieces", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table ``documents``. What a stage stores on its way goes when its documents are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
