"""Byte-level BPE by the transducer, against the tiktoken library and by round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillworks.llm import byte_fst, queries

PATHS = [public_tokenizers.path(f"{name}.tiktoken") for name in ("byte_bpe_multi_50k", "byte_bpe_50k")]
PATH = PATHS[0]


def library(path=PATH):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


LIBRARY, MACHINE = library(), byte_fst.encoder(PATH).machine
PARTS = ["a", "ing", "th", "e", " ", "  ", "\n", "\t", "é", "ß", "中文", "😀", "́", "19", "!", "--", "нов", "ی", "'s", " ", "\u0085", "ルー"]


@given(st.lists(st.sampled_from(PARTS) | st.characters(exclude_categories=["Cs"]), max_size=40).map("".join))
@settings(max_examples=400, deadline=None)
def test_same_ids_as_the_library(text):
    assert byte_fst.encoder(PATH).encode(text).tolist() == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("path", PATHS)
def test_joined_tokens_are_merged_as_defined(path):
    machine, rng = byte_fst.encoder(path).machine, random.Random(3)
    tokens = [t for t in machine.ranks if len(t) < 20]
    for _ in range(4000):
        data = b"".join(rng.choices(tokens, k=rng.randint(2, 5)))
        given_out = list(machine.run(data[k : k + 3] for k in range(0, len(data), 3)))
        assert np.frombuffer(b"".join(given_out), "<u4").tolist() == machine.merge(data)


def test_pairs_fit_as_merging_says():
    rng, tokens = random.Random(4), [i for i, t in MACHINE.tokens.items() if len(t) < 16 and MACHINE.whole(i)]
    for left, right in zip(rng.choices(tokens, k=3000), rng.choices(tokens, k=3000)):
        assert MACHINE.fits(left, right) == (MACHINE.merge(MACHINE.tokens[left] + MACHINE.tokens[right]) == [left, right])


def test_ids_come_after_a_bounded_lookahead():
    longest = max(map(len, MACHINE.tokens.values()))
    data, pending = b"thequickbrownfoxjumps" * 400, 0
    for state in _states(data):
        pending = max(pending, *(sum(len(MACHINE.tokens[t]) for t in path) for _, _, path in MACHINE._states[state]))
    assert pending <= 2 * longest


def _states(data):
    state = 0
    for byte in data:
        key = state << 8 | byte
        state = (MACHINE._steps[key] if key in MACHINE._steps else MACHINE._step(key)) >> 1
        yield state


def test_full_memory_changes_nothing(monkeypatch):
    for name in ("STEPS", "PAIRS", "PIECES"):
        monkeypatch.setattr(byte_fst, name, 5)
    small, rng = byte_fst.Encoder(PATH), random.Random(5)
    for _ in range(200):
        text = "".join(rng.choices("abehtsion ", k=60))
        assert small.encode(text).tolist() == LIBRARY.encode_ordinary(text)
    assert len(small._recent.young) <= 5


def test_stream_decoding_of_tokens_with_parts_of_characters():
    rng = random.Random(6)
    broken = [i for i in MACHINE.tokens if not MACHINE.complete[i]]
    for _ in range(500):
        ids = [rng.choice(broken) if rng.random() < 0.5 else rng.randrange(50_000) for _ in range(12)]
        stream = byte_fst.StreamDecoder(MACHINE)
        fed = [stream.feed(ids[:3]), stream.feed([]), stream.feed(ids[3:7]), stream.feed(ids[7:])]
        whole = b"".join(MACHINE.tokens[i] for i in ids)
        rest = stream.finish()
        assert b"".join(fed) + rest == whole
        assert "".join(f.decode("utf-8", "replace") for f in fed) + rest.decode("utf-8", "replace") == whole.decode("utf-8", "replace")


@given(st.binary(max_size=30), st.integers(1, 5))
@settings(max_examples=400, deadline=None)
def test_stream_decoding_cuts_only_between_characters(data, width):
    ids = [MACHINE.ranks[bytes([b])] for b in data]
    stream, parts = byte_fst.StreamDecoder(MACHINE), []
    for k in range(0, len(ids), width):
        parts.append(stream.feed(ids[k : k + width]))
        assert len(stream._rest) <= 3
    assert b"".join([*parts, stream.finish()]) == data
    whole = b"".join(parts).decode("utf-8", "replace")
    assert "".join(p.decode("utf-8", "replace") for p in parts) == whole


def test_columns_and_awkward_texts(spark):
    rows = [(1, "Plain text, twice."), (1, "Plain text, twice."), (2, None), (3, ""), (None, "\n \t "), (4, "中文😀" * 3), (5, "x" * 300_000 + " end")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("other"))
    got = df.select("text", byte_fst.encode(F.col("text"), PATH).alias("found"))
    got = got.select("text", "found", byte_fst.decode(F.col("found"), PATH).alias("back")).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.found == LIBRARY.encode_ordinary(row.text or "")
        assert row.back == (row.text or "")
    assert df.limit(0).select(byte_fst.encode(F.col("text"), PATH).alias("x")).count() == 0


def test_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op11_byte_fst(spark, folder).collect()}
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = LIBRARY.encode_ordinary(row.text or "")
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
