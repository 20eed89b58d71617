"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from good and one from bad labelled texts. A text is cut
into blocks, all of which are compressed with either dictionary and with none; the difference of the
two sizes per byte, with the plain ratio and the length, goes through a logistic calibration.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.texts import lean_batches

BLOCK = 512
LEVEL = 3
DICTIONARY_BYTES = 65_536
#: Documented bounds of the fitting sample: documents per class for the dictionaries and for the
#: calibration, and blocks per document, spread evenly over its text, for the dictionaries.
DICTIONARY_DOCUMENTS = 600
DICTIONARY_BLOCKS = 32
CALIBRATION_DOCUMENTS = 1_500


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; ``weights`` and ``scale`` are those of ``_design``'s columns."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...] = (0.0,) * 6
    centre: tuple[float, ...] = (0.0,) * 6
    scale: tuple[float, ...] = (1.0,) * 6

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated share of good texts among those alike, from 0 to 1."""
        x = (_design(self.features(texts)) - np.array(self.centre)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -500, 500)))

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Bytes, and compressed sizes with the good, the bad and no dictionary, of each whole text."""
        return np.array([_sizes(t or "", self.good, self.bad) for t in texts], float).reshape(len(texts), 4)


@functools.lru_cache(maxsize=16)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=loaded, write_content_size=False, write_dict_id=False)


def _blocks(data: bytes) -> Iterator[bytes]:
    return (data[i : i + BLOCK] for i in range(0, max(1, len(data)), BLOCK))


def _sizes(text: str, good: bytes, bad: bytes) -> tuple[int, int, int, int]:
    data = text.encode("utf-8", "surrogatepass")
    with_good, with_bad, plain = _compressor(good).compress, _compressor(bad).compress, _compressor(b"").compress
    g = b = p = 0
    for block in _blocks(data):
        g, b, p = g + len(with_good(block)), b + len(with_bad(block)), p + len(plain(block))
    return len(data), g, b, p


def _design(features: np.ndarray) -> np.ndarray:
    n, good, bad, plain = features.T
    size = np.maximum(n, 1)
    difference, length = (bad - good) / size, np.log1p(n)
    return np.column_stack([np.ones(len(n)), difference, good / size, plain / size, length, difference * length])


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary; too few blocks to train from serve as one themselves, none gives none."""
    blocks = [b for b in blocks if len(b) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def _calibrate(design: np.ndarray, good: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method; ``rows``: how many labelled rows each sampled one stands for."""
    centre, scale = design.mean(0), design.std(0)
    centre[0], scale[scale == 0] = 0, 1
    x = (design - centre) / scale
    w, rows = np.zeros(x.shape[1]), rows / rows.mean()
    ridge = 0.02 * np.eye(len(w))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (rows * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (rows * (good - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w, centre, scale


def fit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> Model:
    """Train on labelled documents; ``labels`` holds ``doc_id`` and ``quality`` (1 good, 0 bad, else unused).

    The sample is the documents with the smallest hashes of their id, up to the module's bounds, one half
    of all ids serving the dictionaries and the other the calibration. Repeated ids count once, with the text of the
    smallest hash, ids without a document and NULL ids are left out. With no label of either class every score is 0.5.
    """
    lean_batches(documents.sparkSession)
    labelled = (
        labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{quality}`").cast("int").alias("good"))
        .where(F.col("id").isNotNull() & F.col("good").isin(0, 1))
        .groupBy("id")
        .agg(F.max("good").alias("good"))
        .withColumn("rank", F.xxhash64("id"))
        .withColumn("for_dictionary", F.pmod(F.xxhash64("rank"), F.lit(2)) == 0)
    )
    totals = {r["good"]: r["n"] for r in labelled.groupBy("good").agg(F.count("*").alias("n")).collect()}
    parts = [
        labelled.where((F.col("good") == good) & (F.col("for_dictionary") == use)).orderBy("rank").limit(most)
        for good in (0, 1)
        for use, most in ((True, DICTIONARY_DOCUMENTS), (False, CALIBRATION_DOCUMENTS))
    ]
    chosen = functools.reduce(DataFrame.union, parts)  # at most 2 * (600 + 1,500) ids
    sampled = (
        documents.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "rank", "good", "for_dictionary")  # one row of each id, whatever its number of rows
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    )
    spread = T.ArrayType(T.BinaryType())
    blocks = sampled.where("for_dictionary").select("rank", "good", F.arrow_udf(_spread_blocks, spread)("text").alias("blocks"))
    by_class: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sorted(blocks.collect(), key=lambda r: (r["rank"], r["blocks"])):
        by_class[row["good"]] += map(bytes, row["blocks"])
    model = Model(_dictionary(by_class[1]), _dictionary(by_class[0]))

    sizes = T.ArrayType(T.DoubleType())
    measure = F.arrow_udf(lambda column: pa.array(model.features(column.to_pylist()).tolist(), pa.list_(pa.float64())), sizes)
    rows = sampled.where(~F.col("for_dictionary")).select("rank", "good", measure("text").alias("sizes")).collect()
    rows.sort(key=lambda r: (r["rank"], r["sizes"]))
    good = np.array([r["good"] for r in rows], float)
    if len(set(good.tolist())) < 2:
        return model
    stands_for = np.where(good == 1, totals[1] / good.sum(), totals[0] / (1 - good).sum())
    fitted = _calibrate(_design(np.array([r["sizes"] for r in rows])), good, stands_for)
    return Model(model.good, model.bad, *(tuple(map(float, x)) for x in fitted))


def _spread_blocks(column: pa.Array) -> pa.Array:
    def chosen(text: str | None) -> list[bytes]:
        blocks = list(_blocks((text or "").encode("utf-8", "surrogatepass")))
        return blocks[:: max(1, -(-len(blocks) // DICTIONARY_BLOCKS))]

    return pa.array([chosen(t) for t in column.to_pylist()], pa.list_(pa.binary()))


def score(model: Model, text: Column) -> Column:
    """Score of a whole text; NULL counts as empty, and an empty text gets the calibration's value for length 0."""
    return F.arrow_udf(lambda column: pa.array(model.scores(column.to_pylist()), pa.float64()), T.DoubleType())(text)
