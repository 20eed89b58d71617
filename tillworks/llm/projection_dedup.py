"""Near-duplicate vectors by sorted projection passes.

In every pass the vectors of a label get a code of concatenated random hashes (the sides of random planes through the
label's centre), lie in the order of their codes, and are compared with a bounded window of neighbours. The pairs
found, united over the passes, make groups; within each group all pairs are compared block by block, so that dense
groups get all their links. Probes, sampled vectors turned to just the threshold, tell for each label how often
a pass misses a pair; passes go on until a pair is missed by all of them with a probability of at most
``MISSED``. A label that does not get there in ``MOST_PASSES`` is compared as one group, which misses none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.components import components
from tillworks.llm.minhash import _groups as groups
from tillworks.llm.texts import lean_batches, mix
from tillworks.session import stored

SIMILAR = 0.98
#: Neighbours on one side that a vector is compared with in a pass, and hashes of a code.
NEIGHBOURS, BITS = 64, 48
#: Probability with which all passes may miss a pair at the threshold, passes of a round, and most passes.
MISSED, ROUND, MOST_PASSES = 1e-4, 8, 64
#: Sampled vectors of a label, whatever its size: their mean is its centre, and each is a probe.
SAMPLED = 256
#: Vectors of a block, and how many of them are compared with another block at a time.
WINDOW = 1024
SLAB = 256
_SEED = 20240611


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, each of ``dim`` numbers, scaled to length 1 in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)  # keeps squares of extreme numbers finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _spanning(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For n rows the smallest row that each is joined with by the pairs, directly or not."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compared(similar: float):
    """``node, links, least`` of linked nodes: links within two blocks, and the smallest row's node that they join it with."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["label", "dim", "part", "i", "j"]):
            node, block, copies = (group.column(c).to_numpy() for c in ("node", "block", "copies"))
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            units = unit_rows(group.column("vector").combine_chunks(), group.column("dim")[0].as_py())
            a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
            others, out, least = units[b].T, np.zeros(len(node), np.int64), np.arange(len(node))
            for k in range(0, len(a), SLAB):
                some = a[k : k + SLAB]
                linked = (units[some] @ others >= similar) & (some[:, None] != b)
                left, right = np.nonzero(linked)
                if not len(left):
                    continue
                out[some] += linked @ copies[b]
                if i != j:
                    out[b] += linked.T @ copies[some]
                joined = np.flatnonzero(least != np.arange(len(node)))
                least = _spanning(np.r_[joined, some[left]], np.r_[least[joined], b[right]], len(node))
            found = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(node[found]), pa.array(out[found]), pa.array(node[least[found]])], ["node", "links", "least"])

    return compare


def _planes(passes: range, dim: int) -> np.ndarray:
    """Normals of the planes of all passes, one pass after the other."""
    return np.concatenate([np.random.default_rng([_SEED, k, dim]).standard_normal((BITS, dim)) for k in passes])


def _turned(units: np.ndarray, node: np.ndarray, similar: float) -> np.ndarray:
    """Of each vector one at a cosine of ``similar``, in a direction that only the node's number decides."""
    count = np.arange(units.shape[1], dtype=np.uint64)
    off = mix(mix(node.astype(np.uint64))[:, None] + count * np.uint64(0x9E3779B97F4A7C15)).astype(np.float64) / 2.0**64 - 0.5
    off -= (off * units).sum(1, keepdims=True) * units
    size = np.sqrt((off * off).sum(1, keepdims=True))
    return similar * units + np.sqrt(1 - similar**2) * off / np.where(size > 0, size, 1)


_CODED = "label string, dim int, pass int, code bigint, node bigint, probe boolean, vector array<double>"


def _coded(passes: range, similar: float):
    """A row per vector, probe and pass, with its code and its unit vector."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                units, node = unit_rows(some.column("vector"), dim), some.column("node").to_numpy()
                probe = some.column("probe").to_numpy(zero_copy_only=False)
                units = np.where(probe[:, None], _turned(units, node, similar), units)
                centre = some.column("centre").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                sides = ((units - centre) @ _planes(passes, dim).T > 0).reshape(len(units), len(passes), BITS)
                codes = sides @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                flat = pa.array(units.reshape(-1))
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(units) + 1, dtype=np.int32) * dim), flat)
                for k, number in enumerate(passes):
                    columns = [some.column("label"), some.column("dim"), pa.array(np.full(len(units), number, np.int32))]
                    columns += [pa.array(codes[:, k]), some.column("node"), some.column("probe"), vectors]
                    yield pa.RecordBatch.from_arrays(columns, ["label", "dim", "pass", "code", "node", "probe", "vector"])

    return code


def _neighbours(similar: float):
    """Of rows in the order of their codes: links within the window, as few as join what they join, and probes met."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            old = 0 if held is None else held.num_rows
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = [table.column(c).to_numpy() for c in ("label", "dim", "pass")]
            changes = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            for start, end in zip(np.r_[0, changes], np.r_[changes, table.num_rows]):
                if end > old:
                    yield _met(table.slice(start, end - start), max(0, old - start), similar)
            held = table.slice(max(0, table.num_rows - NEIGHBOURS))

    return compare


def _met(run: pa.Table, new: int, similar: float) -> pa.RecordBatch:
    """Links and probes met between the rows from ``new`` on and their neighbours before them."""
    node, probe = (run.column(c).to_numpy() for c in ("node", "probe"))
    dim = run.column("dim")[0].as_py()
    units = run.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
    place = np.arange(len(node))
    after = place[new:, None]
    near = (place < after) & (place >= after - NEIGHBOURS)
    own = probe[new:, None] != probe
    hits = int((near & own & (node[new:, None] == node)).sum())
    linked = near & ~own & ~probe & (units[new:] @ units.T >= similar)
    right, left = np.nonzero(linked)
    least = _spanning(left, right + new, len(node))
    joined = np.flatnonzero(least != place)
    n = len(joined) + 1
    return pa.RecordBatch.from_arrays(
        [pa.array([run.column("label")[0].as_py()] * n, pa.string()), pa.array(np.full(n, dim, np.int32)),
         pa.array([*node[joined].tolist(), None], pa.int64()), pa.array([*node[least[joined]].tolist(), None], pa.int64()),
         pa.array([0] * (n - 1) + [hits], pa.int64())],
        ["label", "dim", "u", "v", "hits"],
    )


def _unit(vector: str) -> Column:
    size = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(vector, lambda x: x.cast("double") / size)


def candidate_groups(nodes: DataFrame, similar: float = SIMILAR, most_passes: int = MOST_PASSES) -> tuple[DataFrame, DataFrame]:
    """``node, part`` of vectors that belong together by what the passes have found, and a report on the labels.

    ``nodes`` holds node (long), label, dim, vector. The report holds ``label, dim, passes, missed``: the passes made and
    the estimated probability that all of them miss a pair at the threshold. Nodes without a partner have no row.
    """
    group = ["label", "dim"]
    in_order = Window.partitionBy(*group).orderBy(F.xxhash64("node"), "node")
    sampled = nodes.withColumn("_place", F.row_number().over(in_order)).where(F.col("_place") <= SAMPLED).drop("_place")
    sampled = stored(sampled.select("node", *group, "vector"), "vector-sample")
    means = sampled.select(*group, F.posexplode(_unit("vector")).alias("at", "x")).groupBy(*group, "at").agg(F.avg("x").alias("x"))
    means = means.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("m"))  # a vector a label
    centres = stored(
        means.select(*group, F.col("m.x").alias("centre"))
        .join(sampled.groupBy(*group).agg(F.count("*").alias("probes")), group)
        .withColumns({"hits": F.lit(0).cast("bigint"), "passes": F.lit(0), "missed": F.lit(1.0)}),
        "vector-labels",
    )
    edges: list[DataFrame] = []
    for first in range(0, most_passes, ROUND):
        passes = range(first, min(first + ROUND, most_passes))
        # Labels that pairs can still be missed in; the others lie untouched.
        open_labels = centres.where(F.col("missed") > MISSED).select(*group, "centre")
        if not open_labels.head(1):
            break
        rows = nodes.select("node", *group, "vector", F.lit(False).alias("probe"))
        rows = rows.unionByName(sampled.withColumn("probe", F.lit(True))).join(open_labels, group)
        coded = rows.select("node", *group, "vector", "probe", "centre").mapInArrow(_coded(passes, similar), _CODED)
        order = ["label", "dim", "pass", "code", F.xxhash64("pass", "node"), "node", "probe"]  # ties in another order in each pass
        placed = coded.repartitionByRange(*order).sortWithinPartitions(*order)
        found = stored(placed.mapInArrow(_neighbours(similar), "label string, dim int, u bigint, v bigint, hits bigint"), "vector-passes")
        edges.append(found.where("u IS NOT NULL").select("u", "v"))
        hits = found.groupBy(*group).agg(F.sum("hits").alias("more"))
        done = centres.join(hits, group, "left").withColumns(
            {
                "hits": F.col("hits") + F.coalesce("more", F.lit(0)),
                "passes": F.when(F.col("missed") > MISSED, len(passes)).otherwise(0) + F.col("passes"),
            }
        )
        tries = F.col("probes") * F.col("passes")
        rate = F.greatest(tries - F.col("hits"), F.lit(0)) + 1  # one more than were missed, so never zero
        centres = stored(done.drop("more").withColumn("missed", F.pow(rate / (tries + 1), F.col("passes"))), "vector-labels")
    if not edges:
        return nodes.select("node", F.lit(None).cast("bigint").alias("part")).limit(0), centres.select(*group, "passes", "missed")
    united = edges[0]
    for more in edges[1:]:
        united = united.union(more)
    joined = components(united).withColumnRenamed("component", "part")
    parts = joined.union(joined.select("part", "part").distinct())  # with the nodes that groups are named after
    # What the passes cannot promise is compared as a whole.
    whole = nodes.join(centres.where(F.col("missed") > MISSED).select(*group), group, "left_semi").select("node", F.lit(-1).cast("bigint").alias("part"))
    report = centres.select(*group, "passes", F.when(F.col("missed") > MISSED, 0.0).otherwise(F.col("missed")).alias("missed"))
    return parts.join(whole.select("node"), "node", "left_anti").union(whole), report


def near_duplicates(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    similar: float = SIMILAR, window: int = WINDOW, exact: bool = False,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row; other columns are not looked at.

    Vectors of one label (of any plain type) and one length are linked when their cosine is at least ``similar``. NULL labels and
    vectors that are NULL, empty, all zero or hold a NULL, NaN or infinity are linked with nothing.
    Equal vectors of a label are one node with so many copies, each linked with all others; rows that
    repeat an id count as different vectors. ``component_id`` is the smallest id reachable, ``kept`` marks
    the vector that bears it. NULL ids take part but never name a component with other ids.
    ``window`` is the size of a block; results do not depend on it. A pair at the threshold is missed with a probability of
    at most ``MISSED``, a closer one less often, and one whose vectors are joined through others never; ``exact`` compares
    all pairs of a label instead, which takes time in proportion to their square.
    """
    lean_batches(df.sparkSession)
    values = F.col("vector")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("label").isNotNull() & values.isNotNull() & finite & F.exists(values, lambda x: x != 0)
    rows = df.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").alias("vector"))
    key = ["label", "hash_1", "hash_2"]  # 128 bits stand for a vector's numbers
    hashed = rows.select(
        "vec_id", "label", "vector", F.coalesce(sound, F.lit(False)).alias("sound"),
        F.xxhash64(F.lit(1), "vector").alias("hash_1"), F.xxhash64(F.lit(2), "vector").alias("hash_2"),
    )
    nodes = stored(
        hashed.where("sound")
        .groupBy(*key)
        .agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .select("*", F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("node")),
        "vector-nodes",
    )
    if exact:
        parts = nodes.select("node", F.lit(-1).cast("bigint").alias("part"))
    else:
        parts = candidate_groups(nodes, similar)[0]
    group = ["label", "dim", "part"]
    members = stored(nodes.select("node", "label", "dim", "copies", "vector").join(parts, "node"), "vector-groups")
    sizes = stored(members.groupBy(*group).agg(F.ceil(F.count("*") / window).cast("int").alias("blocks")), "vector-blocks")
    placed = members.join(sizes, group).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    paired = (
        placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
        .withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")})
        .drop("blocks", "with")
    )
    tile = [*group, "i", "j"]
    dealt = paired.repartition(*tile).sortWithinPartitions(*tile)
    found = stored(dealt.mapInArrow(_compared(similar), "node bigint, links bigint, least bigint"), "vector-pairs")
    members = components(found.select(F.col("node").alias("u"), F.col("least").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))

    in_parts = stored(
        nodes.select("node", *key, "least_id", "copies")
        .join(members, "node", "left")
        .join(links, "node", "left")
        .select(*key, "least_id", F.coalesce("component", "node").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "vector-links",
    )
    ids = in_parts.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = in_parts.join(ids, "component").select(*key, "n_links", "component_id")
    out = hashed.select("vec_id", *[F.when(F.col("sound"), F.col(c)).alias(c) for c in key]).join(known, key, "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
