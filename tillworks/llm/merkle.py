"""Merkle manifest of a dataset: a content-addressed graph of digests, and proofs found by descending from its root.

Rows are leaves, in trees by group; the trees' roots are the leaves of one more tree. Digests and what they are
made of lie in a store as (digest, children) records, so a node is found by its digest alone. A leaf request is
a tree and a rank: it starts at the root, and at every height a digit of the rank, to the base of the fan-out,
picks the child that it goes on with. The children not picked are its proof, read backwards from leaf to root.
Requests that share a node descend to it as one row. All of this is SQL functions and joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillworks.session import file_system

FAN_OUT = 16
_MOST_HEIGHT = 15  # FAN_OUT ** 15 still is a 64-bit number; no tree is higher
_POSITION = (1 << 33) - 1  # the part of a generated row number that counts within its partition
_TOP = -1  # number of the tree above the groups' trees


def field(column: Column) -> Column:
    """A value as it enters a leaf: ``-`` for NULL, else its number of UTF-8 bytes, a colon and the value as text."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of texts one after the other."""
    return F.sha2(F.concat(*texts), 256)


def leaf(columns: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in columns])


@dataclass(frozen=True)
class Manifest:
    """A written manifest: ``leaves``, one row per input row; ``trees``, one per group; ``records/height=…``."""

    spark: SparkSession
    path: str
    height: int  # of the highest group's tree
    top_height: int

    @property
    def leaves(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/leaves")

    @property
    def trees(self) -> DataFrame:
        """``tree, group, n, height, subroot``; the number ``tree`` is the group's rank, NULL first."""
        return self.spark.read.parquet(f"{self.path}/trees")

    @property
    def root(self) -> str | None:
        """The root; None of an empty dataset."""
        row = self.spark.read.parquet(f"{self.path}/root").first()
        return row and row["root"]

    def records(self, tree_kind: str, height: int) -> DataFrame:
        """``digest, children`` of the nodes of a height, each digest once."""
        return self.spark.read.parquet(f"{self.path}/records/{tree_kind}/height={height}")


def _height(leaves: Column) -> Column:
    """How often runs of ``FAN_OUT`` are replaced by one until a single node is left."""
    return sum(((leaves > FAN_OUT**k).cast("int") for k in range(_MOST_HEIGHT)), F.lit(0))


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _placed(df: DataFrame, path: str, order: Sequence[str]) -> DataFrame:
    """Rows stored in ``order`` with their ``part`` and their ``place`` in it; parts are ranges of even size."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))
    return _kept(placed.select("*", F.spark_partition_id().alias("part"), place.alias("place")), path)


def _shifts(placed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group and part what turns a place into a rank within the group: a row for each that occur together."""
    counts = placed.groupBy(*group, "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*group, "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))


def build(df: DataFrame, path: str, doc_id: str, group: str, columns: Sequence[str], carry: dict[str, Column] | None = None) -> Manifest:
    """Write the manifest of all rows of ``df`` under the new folder ``path``.

    Leaves are made of ``columns`` and ordered within their ``group`` (text) by ``doc_id`` (NULL first), then by leaf;
    rows alike in both are leaves of their own. Groups are ordered as UTF-8 bytes, NULL first; an empty text is a
    group like any other. ``carry`` names further expressions to keep with the leaves; clashing and extra columns
    of ``df`` are not looked at. An empty table gives a manifest without a root.

    Parts are ranges of (group, id, leaf, row), so a group or an id that holds most rows lies in many of them.
    """
    spark = df.sparkSession
    read = df.select(
        F.col(f"`{group}`").alias("group"), F.col(f"`{doc_id}`").alias("id"), leaf([F.col(f"`{c}`") for c in columns]).alias("leaf"),
        *[value.alias(f"carry_{name}") for name, value in (carry or {}).items()], F.monotonically_increasing_id().alias("row"),
    )
    placed = _placed(_kept(read, f"{path}/read"), f"{path}/placed", ["group", "id", "leaf", "row"])
    sizes = _kept(placed.groupBy("group").agg(F.count("*").alias("n")), f"{path}/sizes")
    ranked = _placed(sizes, f"{path}/ranked", ["group"])
    trees = ranked.join(_shifts(ranked, []), "part").select(
        "group", (F.col("place") + F.col("shift")).alias("tree"), "n", _height(F.col("n")).alias("height")
    )
    shifts = _shifts(placed, ["group"]).alias("s").join(trees.alias("t"), F.col("s.group").eqNullSafe(F.col("t.group")))
    shifts = shifts.select(F.col("s.group").alias("of"), F.col("part").alias("at"), "shift", "tree", "height")
    leaves = placed.join(shifts, F.col("group").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at")))
    carried = [F.col(f"carry_{name}").alias(name) for name in carry or {}]
    leaves = _kept(
        leaves.select("tree", "height", (F.col("place") + F.col("shift")).alias("rank"), "group", "id", "leaf", *carried), f"{path}/leaves"
    )
    heights = trees.agg(F.max("height"), _height(F.count("*")))
    height, top_height = heights.first()
    manifest = Manifest(spark, path, height or 0, top_height)
    nodes = leaves.select("tree", "height", F.col("rank").alias("place"), F.col("leaf").alias("digest"))
    subroots = _climb(nodes, manifest, "groups", manifest.height).withColumnsRenamed({"tree": "of", "digest": "subroot"})
    trees = trees.join(subroots, F.col("tree") == F.col("of")).drop("of")
    trees = _kept(trees, f"{path}/trees")
    top = F.lit(_TOP).cast("bigint").alias("tree"), F.lit(top_height).alias("height")
    nodes = trees.select(*top, F.col("tree").alias("place"), F.col("subroot").alias("digest"))
    _kept(_climb(nodes, manifest, "top", top_height).select(F.col("digest").alias("root")), f"{path}/root")
    for folder in ("read", "placed", "sizes", "ranked", "nodes"):  # only on the way
        fs, place = file_system(spark, f"{path}/{folder}")
        fs.delete(place, True)
    return manifest


def _climb(nodes: DataFrame, manifest: Manifest, kind: str, highest: int) -> DataFrame:
    """Store the records of every height above ``nodes``; returns ``tree, digest`` of what remains of each tree."""
    remains = nodes.where(F.col("height") == 0).select("tree", "digest")
    for height in range(1, highest + 1):
        child = F.struct("place", "digest")
        runs = nodes.where(F.col("height") >= height).groupBy("tree", "height", F.shiftright("place", 4).alias("place"))
        runs = runs.agg(F.sort_array(F.collect_list(child)).alias("run"))  # at most FAN_OUT
        runs = runs.select("tree", "height", "place", F.col("run.digest").alias("children"))
        runs = runs.withColumn("digest", F.sha2(F.array_join("children", ""), 256))
        nodes = _kept(runs, f"{manifest.path}/nodes/{kind}/height={height}")
        # Equal runs have equal digests: one record for all of them.
        nodes.groupBy("digest").agg(F.min("children").alias("children")).write.parquet(f"{manifest.path}/records/{kind}/height={height}")
        nodes = nodes.drop("children")
        remains = remains.unionByName(nodes.where(F.col("height") == height).select("tree", "digest"))
    return remains


def _descended(reached: DataFrame, records: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (``tree, place`` and more) with the ``digest`` of their place and the ``path`` to it.

    ``reached`` holds ``tree, place, digest, path`` of their parents. Each has one row, a record has one row, and a
    parent gets at most ``FAN_OUT`` different places; equal digests in many places are split like any skewed join.
    """
    parents = reached.join(records, "digest").select(
        F.col("tree").alias("of"), F.col("place").alias("above"), "children", F.col("path").alias("before")
    )
    met = requests.alias("r").join(parents, (F.col("tree") == F.col("of")) & (F.shiftright("place", 4) == F.col("above")))
    digit = F.col("place").bitwiseAND(F.lit(FAN_OUT - 1)).cast("int")
    left = F.array_join(F.slice("children", F.lit(1), digit), "")
    right = F.array_join(F.slice("children", digit + 2, F.lit(FAN_OUT)), "")
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    found = F.get("children", digit).alias("digest")
    return met.select(*[F.col(f"r.{c}") for c in requests.columns], found, F.concat("before", step).alias("path")).where("digest is not null")


_REACHED = "tree bigint, place bigint, digest string, path array<struct<left: string, right: string>>"


def proofs(manifest: Manifest, requests: DataFrame, work: str) -> DataFrame:
    """Requests (``tree, height, rank`` and more columns) with ``found``, the digest there, ``path`` and ``root``.

    ``path`` holds, from the leaf up to the root, the siblings left and right of every node passed, as joined digests.
    Requests may repeat; one for a rank that does not exist has no row. Further columns of requests must be named
    otherwise than these and than ``place, digest, of, above, children, before``. Places reached are stored height by height
    under the new folder ``work``; the last step, with a row per request, is not.
    """
    wanted = requests.select("tree", "height", F.col("rank").alias("place")).distinct()
    trees = _kept(wanted.select("tree", "height").distinct(), f"{work}/trees")
    top = F.lit(_TOP).cast("bigint")
    root = manifest.root
    reached = manifest.spark.createDataFrame([(_TOP, 0, root, [])] if root else [], _REACHED)
    for height in range(manifest.top_height, 0, -1):
        places = trees.select(top.alias("tree"), F.shiftright("tree", 4 * (height - 1)).alias("place")).distinct()
        reached = _kept(_descended(reached, manifest.records("top", height), places), f"{work}/top-{height}")
    # The subroots: of each tree asked for, at its own height.
    subroots = reached.select(F.col("place").alias("of"), "digest", "path").join(trees, F.col("of") == F.col("tree"))
    subroots = _kept(subroots.select("tree", "height", F.lit(0).cast("bigint").alias("place"), "digest", "path"), f"{work}/subroots")

    asked = requests.withColumnRenamed("rank", "place")
    lone = asked.where((F.col("height") == 0) & (F.col("place") == 0))
    lone = lone.join(subroots.select(F.col("tree").alias("of"), "digest", "path"), F.col("tree") == F.col("of")).drop("of")
    reached = subroots.drop("height").limit(0)
    for height in range(manifest.height, 0, -1):
        starting = subroots.where(F.col("height") == height).drop("height")
        reached = reached.unionByName(starting)
        if height > 1:
            places = wanted.where(F.col("height") >= height).select("tree", F.shiftright("place", 4 * (height - 1)).alias("place"))
            reached = _kept(_descended(reached, manifest.records("groups", height), places.distinct()), f"{work}/groups-{height}")
    found = lone
    if manifest.height:
        found = lone.unionByName(_descended(reached, manifest.records("groups", 1), asked.where(F.col("height") > 0)))
    found = found.withColumn("path", F.reverse("path")).withColumnsRenamed({"place": "rank", "digest": "found"})
    return found.withColumn("root", F.lit(root))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda below, step: F.sha2(F.concat(step["left"], below, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)
