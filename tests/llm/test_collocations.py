"""Phrase counts and collocations against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillworks.llm import collocations, hat_trie

TYPES = "doc_id bigint, text string, lang string, source string, n bigint, phrase string, width int"


def pieces(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def brute_counts(rows, longest):
    found, totals = defaultdict(Counter), Counter()
    for row in rows:
        lang = "und" if row[2] is None else row[2]
        for words in pieces(row[1]):
            totals[lang] += len(words)
            for width in range(1, longest + 1):
                found[lang].update(tuple(words[k : k + width]) for k in range(len(words) - width + 1))
    return found, totals


def brute_collocations(rows, longest, least, share, top):
    out = []
    found, totals = brute_counts(rows, longest)
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            around = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if all(100 * b < share * a for b in around):
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def awkward(seed=1, n=150):
    r = random.Random(seed)
    words = ["the", "of", "New", "York", "City", "x", "é", "漢字", "a|b", " ", "Ärger", "the", "the"]
    rows = []
    for i in range(n):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ", ", ":"]) for _ in range(r.randrange(0, 60)))
        rows.append((i, text, r.choice(["en", "en", "de", None, "und", ""]), None, 1, "other", 2))
    rows += [(900, t, "en", "s", None, None, None) for t in (None, "", " \t ", ".,;:!?", "one", "New York City " * 3000, "w" * 50_000)]
    return rows + rows[:20] + [(None,) * 7]


def got(df, **options):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(row) for row in collocations.collocations(df, **options).select(*names).collect())


@pytest.mark.parametrize("longest, least, share, top", [(3, 10, 50, 2000), (2, 2, 50, 15), (4, 3, 100, 40), (3, 10, 0, 5)])
def test_against_plain_python(spark, longest, least, share, top):
    rows = awkward()
    df = spark.createDataFrame(rows, TYPES).repartition(5)
    assert got(df, longest=longest, least=least, share=share, top=top) == brute_collocations(rows, longest, least, share, top)


def test_bursts_spills_and_new_numbers_change_nothing(spark, monkeypatch):
    rows = awkward(2, 200)
    whole = got(spark.createDataFrame(rows, TYPES).coalesce(1), least=4)
    # Run in this process, with bounds that are reached all the time.
    monkeypatch.setattr(hat_trie, "MOST", 60)
    monkeypatch.setattr(hat_trie, "WORDS", 7)
    monkeypatch.setattr(collocations, "_WORDS_AT_ONCE", 40)
    for width in (1, 2, 3, 4):
        counted = Counter()
        one = collocations._Language("en", width, None)
        one.trie.burst, one.full, one.stretch = 3, 6, 40
        for row in rows:
            if row[2] == "en":
                for batch in [*one.add((row[1] or "").encode()), *one.leave(20)]:
                    phrases = batch.column("phrase").to_pylist()
                    assert phrases == sorted(phrases, key=lambda p: p.encode().split(b" "))
                    counted.update(dict(zip(phrases, batch.column("n").to_pylist())))
        for batch in one.end():
            for phrase, n in zip(batch.column("phrase").to_pylist(), batch.column("n").to_pylist()):
                counted[phrase] += n
        expected, totals = brute_counts([r for r in rows if r[2] == "en"], 4)
        assert {tuple(p.split(" ")): n for p, n in counted.items() if p} == {p: n for p, n in expected["en"].items() if len(p) == width}
        assert width > 1 or counted[""] == totals["en"]
    assert whole == brute_collocations(rows, 3, 4, 50, 2000)


def test_a_trie_bursts_and_gives_back_what_it_was_given():
    r, trie, expected = np.random.default_rng(3), hat_trie.Trie(3, burst=8), Counter()
    for _ in range(20):
        ids = r.integers(0, 9, 200)
        packed, whole = hat_trie.windows(ids, 3)
        keys, counts = np.unique(packed[whole], return_counts=True)
        trie.add(keys, counts)
        expected.update(dict(zip(keys.tolist(), counts.tolist())))
    assert type(trie.root) is hat_trie.Branch and trie.size == len(expected)
    first = trie.release(trie.size // 2)
    assert trie.size <= len(expected) // 2 and len(first[0])
    given = Counter()
    for keys, counts in [first, trie.release(0), trie.release(0)]:
        given.update(dict(zip(keys.tolist(), counts.tolist())))
    assert given == expected and trie.size == 0


def test_the_bitmap_holds_every_frequent_phrase(spark):
    phrases = [("en", f"w{i} v{i % 7}") for i in range(500)] + [("de", "é 漢字")]
    bits = np.frombuffer(collocations._bitmap(spark.createDataFrame(phrases, "lang string, phrase string")), np.uint8)
    assert len(bits) * 8 == collocations.FILTER_BITS and int(np.unpackbits(bits).sum()) <= len(phrases)
    words = hat_trie.Words()
    for lang, phrase in phrases:
        hashes = [words.hashes[[i]] for i in words.number(phrase.encode().split(b" "))]
        at = int(collocations.positions(hashes, lang)[0])
        assert bits[at >> 3] >> (at & 7) & 1


def test_prefix_partitions_are_even_and_the_same_for_every_run(monkeypatch):
    monkeypatch.setattr(collocations, "PARTS", 40)
    r = random.Random(7)
    vocabulary = ["hot"] * 300 + [f"w{i:03d}" for i in range(600)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(400)).encode() for _ in range(30)]
    words = Counter(w for t in texts for w in t.split())
    known = sorted(words.items())[::2] + [(b"hot", words[b"hot"])]  # cuts may know some words only
    cuts = collocations.Cuts([w for w, _ in sorted(set(known))], np.array([n for _, n in sorted(set(known))]))
    part_of, rows = {}, Counter()
    for half in (texts[:15], texts[15:]):
        one = collocations._Language("en", 2, None, cuts)
        for text in half:
            assert not list(one.add(text))
        for batch in one.end():
            for part, phrase in zip(batch.column("part").to_pylist(), batch.column("phrase").to_pylist()):
                assert part_of.setdefault(phrase, part) == part
                rows[part] += 1
    in_order = [part_of[p] for p in sorted(part_of, key=lambda p: p.encode().split(b" "))]
    assert in_order == sorted(in_order)  # ranges
    assert len({p for phrase, p in part_of.items() if phrase.startswith("hot ")}) >= 8
    assert max(rows.values()) < 4 * sum(rows.values()) / 40


def test_counts_beyond_64_bits_are_exact(spark):
    rows = [("en", "", 0, 10**14), ("en", "a", 1, 999_999_999_999), ("en", "b", 1, 999_999_999_989), ("en", "a b", 2, 999_999_999_961)]
    scored = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, width int, n bigint")).collect()
    assert [r.score for r in scored] == [1_000_000 * 999_999_999_961**2 // (999_999_999_999 * 999_999_999_989)]


def test_no_rows(spark):
    none = spark.createDataFrame([], TYPES)
    assert got(none) == []
    assert got(spark.createDataFrame([(1, None, None, None, 1, "", 1)], TYPES).withColumn("rank", F.lit(1))) == []
    with pytest.raises(ValueError):
        got(none, longest=9)
