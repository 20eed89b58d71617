"""Merkle manifests against a plain Python tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tillworks.llm import merkle, queries
from tillworks.session import work_dir

TYPES = "doc_id bigint, source string, lang string, n_chars bigint, text string, rank string, leaf int"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return h(*[field(v) for v in row[:5]])


def climbed(nodes):
    """All levels from the leaves up, and the siblings of each leaf."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[k : k + 16]) for k in range(0, len(below), 16)])
    paths = []
    for at in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            run = level[at // 16 * 16 : at // 16 * 16 + 16]
            path.append((run[: at % 16], run[at % 16 + 1 :]))
            at //= 16
        paths.append(path)
    return levels[-1][0], paths


def brute_force(rows):
    """Per row: leaf, subroot, root, proof digest, folded root of the tampered leaf, whether it is the root."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        members = [r for r in rows if r[1] == source]
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[source] = (members, *climbed([leaf_of(r) for r in members]))
    root, tops = climbed([trees[s][1] for s in sources])
    out = []
    for source, top in zip(sources, tops):
        members, subroot, paths = trees[source]
        for row, path in zip(members, paths):
            path = path + top
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]) if changed else row[4]
            node = leaf_of((*row[:4], text))
            for left, right in path:
                node = h(*left, node, *right)
            out.append((row[0], leaf_of(row), subroot, root, h(*[x for left, right in path for x in left + right]), node, node == root))
    return out


def awkward():
    rows = [(i, "hot", "en", i, f"Text {i}", "x", 1) for i in range(300)]
    rows += [(i, f"s{i % 20}", None, None, f"Other Text {i}" if i % 3 else f"plain {i}", None, None) for i in range(300, 380)]
    rows += [(500, "lone", "de", 1, "É Ä 漢字", None, 2)] + [(501, None, "de", 1, t, None, 2) for t in (None, "", "A" * 100_000)]
    rows += [(7, "copies", "en", 5, "Same", None, 1)] * 40 + [(None, "copies", "en", 5, t, None, 1) for t in ("Same", "Same", None)]
    rows += [(600 + i, "", "en", 0, "-", None, None) for i in range(17)] + [(700, "-", "-", 0, "-", None, None), (None,) * 7]
    return rows


def as_table(spark, rows, folder):
    spark.createDataFrame(rows, TYPES).repartition(7).write.parquet(f"{folder}/documents.parquet")
    return folder


NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("rows", [awkward(), awkward()[:1], awkward()[:2], awkward()[:16], awkward()[:257]], ids=lambda r: str(len(r)))
def test_every_leaf_against_plain_python(spark, rows, tmp_path):
    got = queries.op12_merkle_manifest(spark, as_table(spark, rows, str(tmp_path))).select(*NAMES).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_force(rows)))


def test_no_rows(spark, tmp_path):
    folder = as_table(spark, [], str(tmp_path))
    assert queries.op12_merkle_manifest(spark, folder).count() == 0


def test_requests_find_their_leaves_and_repeat(spark):
    path = work_dir(spark, "test-merkle")
    manifest = merkle.build(spark.createDataFrame(awkward(), TYPES), f"{path}/m", "doc_id", "source", COLUMNS)
    asked = manifest.leaves.where("rank % 7 = 0").select("tree", "height", "rank", F.col("leaf").alias("expected"))
    beyond = asked.limit(1).select("tree", "height", F.lit(1 << 40).alias("rank"), "expected")
    found = merkle.proofs(manifest, asked.unionByName(asked).unionByName(beyond), f"{path}/d").collect()
    assert len(found) == 2 * asked.count()
    for row in found:
        assert row.found == row.expected
        node = row.found
        for step in row.path:
            node = h(step.left, node, step.right)
        assert node == row.root == manifest.root


def test_records_are_addressed_by_content(spark):
    path = work_dir(spark, "test-merkle")
    manifest = merkle.build(spark.createDataFrame(awkward(), TYPES), f"{path}/m", "doc_id", "source", COLUMNS)
    for kind, highest in (("groups", manifest.height), ("top", manifest.top_height)):
        for height in range(1, highest + 1):
            records = manifest.records(kind, height).collect()
            assert len({r.digest for r in records}) == len(records)
            assert all(r.digest == h(*r.children) and 1 <= len(r.children) <= 16 for r in records)
    assert manifest.height == 3 and manifest.top_height == 2
