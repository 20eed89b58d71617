"""Near-duplicate documents by MinHash.

Every text's distinct word shingles get ``HASHES`` universal-hash minima, cut into bands. Texts with
the same shingle set are one node. Nodes that share a band are candidates; their signatures are
compared first and their full sets decide. Components come from alternating large-star and small-star.

Candidates are taken in two steps. First each node meets one centre per shared band, of which the
``FIRST_CENTRES`` most alike are verified: that joins most of a group with few pairs. Then every band
whose nodes are still in several components is compared, all its pairs across components, so nothing
is left out and a group is never expanded within a component. Bands of up to ``FEW_NODES`` nodes give
candidate pairs to verify; in larger ones the full sets come along, block by block, and only links leave.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.functions import with_computed
from tillworks.llm import texts
from tillworks.llm.components import components
from tillworks.session import in_few_files, stored

WIDTH = 5
SIMILAR = (75, 100)
HASHES = 200
BAND_ROWS = 5  # 40 bands: a pair of similarity 0.75 shares none of them once in 50,000 times
FIRST_CENTRES = 2
FEW_NODES = 64
BLOCK_NODES = 512
#: A signature of 200 minima estimates 0.75 as less than 0.60 about once in two million times.
LEAST_ESTIMATE = 0.60

_random = np.random.default_rng(20240609)
_FACTORS = (_random.integers(0, 1 << 31, HASHES, dtype=np.uint32) * 2 + 1)[:, None]
_SHIFTS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_BAND_FACTORS = _random.integers(1, 1 << 63, (HASHES // BAND_ROWS, BAND_ROWS), dtype=np.uint64) | np.uint64(1)
_CHUNK = 2048

_SKETCH = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("minima", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)
_SET = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.BinaryType())])


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, data, offsets in texts.slices(column):
        data = texts.LOWER[data]
        starts, ends, at = texts.words(data, offsets)
        hashes = texts.word_hashes(data, starts, ends)
        for k in range(len(offsets) - 1):
            yield texts.shingles(hashes[at[k] : at[k + 1]], width)


def _node(shingles: np.ndarray) -> int | None:
    """64 bits that stand for a shingle set; None for the empty one."""
    if not len(shingles):
        return None
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash over a set."""
    values = (shingles >> np.uint64(17)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(values), _CHUNK):
        np.minimum(out, (_FACTORS * values[i : i + _CHUNK] + _SHIFTS).min(1), out=out)
    return out


def _sketch_column(width: int):
    @F.arrow_udf(_SKETCH)
    def sketch(column: pa.Array) -> pa.Array:
        n, nodes, signatures, bands = [], [], [], []
        for s in _sets(column, width):
            n.append(len(s))
            nodes.append(_node(s))
            signature = minima(s)
            signatures.append((texts.mix(signature.astype(np.uint64)) & np.uint64(0xFF)).astype(np.uint8).tobytes() if len(s) else None)
            keys = texts.mix((signature.astype(np.uint64).reshape(_BAND_FACTORS.shape) * _BAND_FACTORS).sum(1, dtype=np.uint64))
            bands.append(keys.view(np.int64).tolist() if len(s) else None)
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(signatures, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            [f.name for f in _SKETCH],
        )

    return sketch


def _set_column(width: int):
    @F.arrow_udf(_SET)
    def full_set(column: pa.Array) -> pa.Array:
        sets = list(_sets(column, width))
        return pa.StructArray.from_arrays(
            [pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], [f.name for f in _SET]
        )

    return full_set


@F.arrow_udf(T.DoubleType())
def _estimate(left: pa.Array, right: pa.Array) -> pa.Array:
    """Share of equal bytes of two signatures."""
    a = np.frombuffer(b"".join(left.to_pylist()), np.uint8).reshape(-1, HASHES)
    b = np.frombuffer(b"".join(right.to_pylist()), np.uint8).reshape(-1, HASHES)
    return pa.array((a == b).mean(1), pa.float64())


def _similar(similar: tuple[int, int]):
    @F.arrow_udf(T.BooleanType())
    def decide(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = ((np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(left, right))
        return pa.array([alike(a, b, similar) for a, b in pairs], pa.bool_())

    return decide


def alike(a: np.ndarray, b: np.ndarray, similar: tuple[int, int]) -> bool:
    """Whether enough of the union of two sorted sets is common to both."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if similar[1] * len(small) < similar[0] * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
    return similar[1] * common >= similar[0] * (len(a) + len(b) - common)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _verified(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Those of the pairs whose full sets are similar, as edges."""
    with_sets = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    checked = with_sets.select("a", "b", _similar(similar)("sa", "sb").alias("ok"))
    return stored(checked, "minhash-pairs").where("ok").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _first_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each node with the centres most like it."""
    met = members.where("node <> centre").select("node", "centre").distinct()
    signatures = nodes.select("node", "minima")
    both = met.join(signatures, "node").join(
        signatures.select(F.col("node").alias("centre"), F.col("minima").alias("other")), "centre"
    )
    best = Window.partitionBy("node").orderBy(F.desc("estimate"), "centre")  # a node has a centre per band at most
    # Else the filter takes a copy of the estimate: two Python steps in a task, and a worker of its own for each.
    return (
        with_computed(both, "estimate", _estimate("minima", "other"))
        .where(F.col("estimate") >= LEAST_ESTIMATE)
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= FIRST_CENTRES)
        .select(*_pair("node", "centre"))
        .distinct()
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys of a sorted stream."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if not held.num_rows:
            continue
        columns = [held.column(k).to_numpy() for k in keys]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for i, j in zip(np.r_[0, changes[:-1]], changes):
            yield held.slice(i, j - i)
        held = held.slice(changes[-1]) if len(changes) else held
    if held is not None and held.num_rows:
        yield held


def _signatures(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("minima").to_pylist()), np.uint8).reshape(-1, HASHES)


def _few_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs across components, within small buckets, whose signatures are alike."""
    found: list[tuple[int, int]] = []
    for group in _groups(batches, ["key"]):
        node, part = (group.column(c).to_numpy() for c in ("node", "component"))
        signatures = _signatures(group)
        for k in range(len(node)):
            other = np.flatnonzero((part != part[k]) & (node > node[k]))
            like = other[(signatures[other] == signatures[k]).mean(1) >= LEAST_ESTIMATE] if len(other) else other
            found += [(int(node[k]), int(node[x])) for x in like]
        if len(found) > 10_000:
            yield _pairs_batch(found, "a", "b")
            found = []
    yield _pairs_batch(found, "a", "b")


def _pairs_batch(found: list[tuple[int, int]], *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], list(names))


def _block_links(similar: tuple[int, int]):
    """Links across components between two blocks of a large bucket, as many as it takes to join what they join."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["key", "i", "j"]):
            node, part, block = (group.column(c).to_numpy() for c in ("node", "component", "block"))
            key, i, j = (group.column(c)[0].as_py() for c in ("key", "i", "j"))
            signatures = _signatures(group)
            bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in group.column("shingles").chunks for x in c]
            sizes = np.array([len(x) for x in sets])
            part = part.copy()
            found = []
            right = np.flatnonzero(block == j)
            for k in np.flatnonzero(block == i):
                other = right[(part[right] != part[k]) & ((node[right] > node[k]) if i == j else True)]
                lower, upper = np.minimum(sizes[other], sizes[k]), np.maximum(sizes[other], sizes[k])
                other = other[similar[1] * lower >= similar[0] * upper]
                if not len(other):
                    continue
                other = other[(signatures[other] == signatures[k]).mean(1) >= LEAST_ESTIMATE]
                shared = bands[other] == bands[k]  # a pair is looked at in the first of the bands that it shares
                other = other[bands[k][shared.argmax(1)] == key] if len(other) else other
                for x in other:
                    if part[x] != part[k] and alike(sets[x], sets[k], similar):
                        found.append((int(node[k]), int(node[x])))
                        part[part == part[x]] = part[k]
            if found:
                yield _pairs_batch(found, "u", "v")

    return links


def _remaining_links(
    members: DataFrame, nodes: DataFrame, sets: DataFrame, parts: DataFrame, similar: tuple[int, int], most: int
) -> DataFrame:
    """Links across components within buckets that hold several; every such pair is looked at."""
    component = F.coalesce("component", "node").alias("component")
    placed = members.select("key", "node").join(parts, "node", "left").select("key", "node", component)
    placed = stored(in_few_files(placed, most), "minhash-placed")
    mark = F.sum(F.xxhash64("node").cast("decimal(20,0)"))
    buckets = placed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"), mark.alias("mark")
    )
    buckets = stored(in_few_files(buckets.where("low <> high"), most), "minhash-buckets")
    # small bands often hold the same nodes: once is enough
    few = buckets.where(F.col("n") <= FEW_NODES).groupBy("n", "mark", "low", "high").agg(F.min("key").alias("key")).select("key")
    rows = placed.join(few, "key").join(nodes.select("node", "minima"), "node")
    pairs = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_few_pairs, "a bigint, b bigint").distinct()

    many = buckets.where(F.col("n") > FEW_NODES).select("key", F.ceil(F.col("n") / BLOCK_NODES).cast("int").alias("blocks"))
    rows = (
        placed.join(many, "key")
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .join(nodes.select("node", "minima", "bands"), "node")
        .join(sets, "node")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
        .withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")})
        .drop("blocks", "with")
    )
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    links = stored(dealt.mapInArrow(_block_links(similar), "u bigint, v bigint"), "minhash-links")
    return _verified(pairs, sets, similar).union(links)


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row; other columns are not looked at.

    Two documents are linked when ``similar[0] / similar[1]`` of the union of their shingle sets is
    common to both. A-Z count as lower case. A text with fewer than ``width`` words is one shingle; a
    NULL, empty or blank text has none, is linked with nothing and keeps its own id. ``component_id``
    is the smallest id reachable over links, ``kept`` marks the document that bears it. Rows that repeat
    an id are linked by their texts like any others and all kept if it is the smallest. NULL ids take part
    but never name a component with other ids.
    """
    texts.lean_batches(df.sparkSession)
    rows = stored(
        df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
        .withColumn("sketch", _sketch_column(width)("text"))
        .select("doc_id", "sketch.*"),
        "minhash-rows",
    )
    nodes = stored(
        rows.where("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("bearer"), F.first("minima").alias("minima"), F.first("bands").alias("bands")),
        "minhash-nodes",
    )
    keys = nodes.select("node", F.explode("bands").alias("key"))
    buckets = (
        keys.groupBy("key")
        .agg(F.count("*").alias("n"), F.min(F.col("node").bitwiseXOR(F.col("key"))).alias("least"))
        .where("n > 1")
        .select("key", F.col("least").bitwiseXOR(F.col("key")).alias("centre"))
    )
    most = nodes.count() * (HASHES // BAND_ROWS)  # rows that the tables of bands have at most
    members = stored(in_few_files(keys.join(buckets, "key"), most), "minhash-members")

    bearers = members.select("node").distinct().join(nodes.select("node", "bearer"), "node").select("bearer").distinct()
    sets = stored(
        df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
        .join(bearers, F.col("doc_id").eqNullSafe(F.col("bearer")), "left_semi")
        .withColumn("full", _set_column(width)("text"))
        .select("full.*")
        .dropDuplicates(["node"]),
        "minhash-sets",
    )
    first = _verified(_first_pairs(members, nodes), sets, similar)
    parts = components(first)
    rest = _remaining_links(members, nodes, sets, parts, similar, most)
    parts = components(rest.union(parts.select(F.col("node").alias("u"), F.col("component").alias("v"))))

    placed = rows.select("doc_id", "n_shingles", "node").join(parts, "node", "left")
    placed = placed.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("part"))
    ids = placed.where("part IS NOT NULL").groupBy("part").agg(F.min("doc_id").alias("least_id"))
    out = placed.join(ids, "part", "left").select("doc_id", "n_shingles", F.coalesce("least_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
