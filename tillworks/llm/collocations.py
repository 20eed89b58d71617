"""Phrases whose words stand together far more often than their parts would by chance.

Words and word sequences are counted per language, width by width, in HAT-tries (``hat_trie``). A sequence can only be
frequent if the sequences inside it are, so each width counts what passes a bitmap of the frequent sequences one
word shorter. The bitmap may let others pass, but what it lets pass is counted in full, so no count depends on it.
Every task's sorted runs are dealt out to prefix partitions and merged there. These are ranges of the phrases' order, cut
by the counts of single words so that they are of even size; a hot first word has several. Whole texts are read
once for each width.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm import hat_trie
from tillworks.llm.texts import lean_batches, mix
from tillworks.session import stored

#: Bits of the bitmap that goes to every worker (16 MB) whatever the input; a fuller one only lets more pass.
FILTER_BITS = 1 << 27
_STRETCH = 1 << 18  # bytes of a text that are split into words at a time
#: Prefix partitions; a parameter of the cuts alone, Spark's setting decides on its partitions.
PARTS = 4_096
SHARES = 64  # of a language that are ranked apart before they are ranked together
_ROWS = 20_000  # of a run that leave a worker at a time
_WORDS_AT_ONCE = 1 << 20  # that are put into a trie together
_CUT_WORDS = 20_000  # frequent words that the cuts follow
_LANGUAGES = 500  # that a worker counts at a time
NO_LANGUAGE = "und"
ALL_WORDS = ""  # in counts: the phrase of no word, which stands for all word occurrences

# Fixed values of the contract: A-Z become lower case, pieces end at these characters, words at space and tab.
_PIECE_ENDS, _SPACE, _TAB = b".,;:!?\x0a\x0b\x0c\x0d", 32, 9
_TABLE = bytes(
    hat_trie.BREAK[0] if b in _PIECE_ENDS else _SPACE if b == _TAB else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_FACTORS = np.random.default_rng(20240613).integers(1, 1 << 63, hat_trie.WIDEST, dtype=np.uint64) | np.uint64(1)


def stretches(text: bytes, size: int = _STRETCH) -> Iterator[list[bytes]]:
    """A text's words, and a ``BREAK`` between its pieces, about ``size`` bytes at a time."""
    data, start = text.translate(_TABLE), 0
    while start < len(data):
        end = len(data)
        if start + size < end:  # up to the next space or end of a piece
            found = [x for x in (data.find(b" ", start + size), data.find(hat_trie.BREAK, start + size)) if x >= 0]
            end = min(found, default=end)
        yield data[start:end].replace(hat_trie.BREAK, b" " + hat_trie.BREAK + b" ").split()
        start = end


def positions(hashes: list[np.ndarray], language: str) -> np.ndarray:
    """Places in the bitmap of sequences whose words have the given hashes."""
    out = np.full(len(hashes[0]), xxhash.xxh64_intdigest(language.encode()), np.uint64)
    for k, one in enumerate(hashes):
        out = mix(out + one * _FACTORS[k])
    return (out % np.uint64(FILTER_BITS)).astype(np.int64)


class Cuts:
    """Where prefix partitions begin, by the first two words of a phrase, from the counts of a language's words.

    A partition takes words in a row with some ``1 / PARTS`` of all occurrences; a word with more has
    as many of its own as it has shares, cut by the second word as if that were spread like all words.
    """

    def __init__(self, words: list[bytes], counts: np.ndarray):
        """``words`` with their counts; a sample of them will do."""
        self.words, self.counts, self.total = words, counts, int(counts.sum())
        self.share = max(1.0, self.total / PARTS)

    def places(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For words in ascending order the occurrences of all words before each, and its own."""
        more, own = np.zeros(len(words) + 1, np.int64), np.zeros(len(words), np.int64)
        for word, count in zip(self.words, self.counts.tolist()):
            at = bisect.bisect_left(words, word)
            if at < len(words) and words[at] == word:
                own[at] = count
                at += 1
            more[at] += count
        return np.cumsum(more[:-1]), own

    def parts(self, columns: list[np.ndarray], words: list[bytes]) -> np.ndarray:
        """Partition of each phrase, given as the places of its words among ``words``."""
        before, own = self.places(words)
        at = before[columns[0]].astype(np.float64)
        if len(columns) > 1 and self.total:
            at += own[columns[0]] * (before[columns[1]] / self.total)
        return (at / self.share).astype(np.int32)


_END = np.zeros(1, np.int64)  # a break, as between texts


class _Language:
    """What a task has counted of one language."""

    def __init__(self, name: str, width: int, bitmap: np.ndarray | None, cuts: Cuts | None = None):
        self.name, self.width, self.bitmap, self.cuts = name, width, bitmap, cuts
        self.trie, self.words = hat_trie.Trie(width), hat_trie.Words()
        self.total, self._ids, self._held = 0, [], 0  # numbers of the words not counted yet, and how many
        self.stretch = min(_STRETCH, 1 << self.trie.bits - 2)
        self.full = 1 << self.trie.bits - 1

    def add(self, text: bytes) -> Iterator[pa.RecordBatch]:
        for words in stretches(text, self.stretch):
            self.total += len(words) - words.count(hat_trie.BREAK)
            self._hold(self.words.number(words))
            if self._held > _WORDS_AT_ONCE:
                self.count()
            if len(self.words) > self.full:  # numbering starts anew; the last words go on with new numbers
                self.count()
                words = self.words.words
                last = [words[i] for i in self._ids[0].tolist()]
                yield from self.leave(0)
                self.words = hat_trie.Words()
                self._ids = [self.words.number(last)]
        self._hold(_END)

    def _hold(self, ids: np.ndarray) -> None:
        self._ids.append(ids)
        self._held += len(ids)

    def count(self) -> None:
        """Put the sequences of the words so far into the trie; what the next ones may begin with stays."""
        ids = np.concatenate([_END, *self._ids])
        packed, counted = hat_trie.windows(ids, self.width)
        if self.bitmap is not None and len(packed):
            hashes, n = self.words.hashes[ids], len(ids) - self.width + 2
            at = positions([hashes[k : k + n] for k in range(self.width - 1)], self.name)
            passed = self.bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0
            counted &= passed[:-1] & passed[1:]
        self.trie.add(*np.unique(packed[counted], return_counts=True))
        self._ids = [ids[max(0, len(ids) - self.width + 1) :]]
        self._held = len(self._ids[0])

    def leave(self, keep: int) -> Iterator[pa.RecordBatch]:
        """The largest subtrees as one sorted run, until at most ``keep`` sequences are left."""
        keys, counts = self.trie.release(keep)
        if not len(keys):
            return
        ranks, words = self.words.order()
        columns, counts = hat_trie.run_of(keys, counts, self.width, ranks)
        if self.cuts is None:
            parts = (self.words.hashes % np.uint64(PARTS)).astype(np.int32)[np.argsort(ranks)][columns[0]]
        else:
            parts = self.cuts.parts(columns, words)
        names = pa.array(words[:-1], pa.binary()).cast(pa.string())  # the last one is the break
        for k in range(0, len(counts), _ROWS):
            texts = [pc.take(names, pa.array(column[k : k + _ROWS])) for column in columns]
            phrases = pc.binary_join_element_wise(*texts, " ") if self.width > 1 else texts[0]
            yield _rows(self.name, phrases, counts[k : k + _ROWS], parts[k : k + _ROWS])

    def end(self) -> Iterator[pa.RecordBatch]:
        self.count()
        yield from self.leave(0)
        if self.width == 1:
            yield _rows(self.name, pa.array([ALL_WORDS]), [self.total], [0])


def _rows(language: str, phrases: pa.Array, n, parts) -> pa.RecordBatch:
    arrays = [pa.array(parts, pa.int32()), pa.array([language] * len(phrases), pa.string()), phrases, pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["part", "lang", "phrase", "n"])


def _runs(texts: DataFrame, width: int, bitmap: bytes | None, cuts: dict[str, Cuts]) -> DataFrame:
    """``part, lang, phrase, n`` of every task's runs; a phrase has a row for each run that it is in."""
    shared = texts.sparkSession.sparkContext.broadcast((bitmap, cuts))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, cuts = shared.value
        bits = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        languages: dict[str, _Language] = {}
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            for name, text in zip(batch.column("lang").to_pylist(), column):
                one = languages.get(name)
                if one is None:
                    one = languages[name] = _Language(name, width, bits, cuts.get(name))
                yield from one.add(text.as_py())
            if len(languages) > _LANGUAGES or sum(len(x.words) for x in languages.values()) > hat_trie.WORDS:
                for one in languages.values():
                    yield from one.end()
                languages = {}
            size = sum(x.trie.size for x in languages.values())
            if size > hat_trie.MOST:
                for one in languages.values():
                    yield from one.leave(one.trie.size * hat_trie.MOST // (2 * size))
        for one in languages.values():
            yield from one.end()

    return texts.mapInArrow(count, "part int, lang string, phrase string, n bigint")


def _cuts(words: DataFrame) -> dict[str, Cuts]:
    """Cuts of the languages with the most words, from the words with the most occurrences: ``_CUT_WORDS`` at most.

    They only say which partition a phrase goes to; phrases of other languages are dealt out by their first word's hash.
    """
    frequent = words.where(F.col("phrase") != ALL_WORDS).orderBy(F.desc("n"), "lang", "phrase").limit(_CUT_WORDS).collect()
    found: dict[str, list[tuple[bytes, int]]] = {}
    for row in frequent:
        found.setdefault(row.lang, []).append((row.phrase.encode(), row.n))
    return {lang: Cuts([w for w, _ in pairs], np.array([n for _, n in pairs], np.int64)) for lang, pairs in found.items()}


def _bitmap(frequent: DataFrame) -> bytes:
    """Bitmap of the frequent sequences of one width; ``FILTER_BITS`` bits, however many there are."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                hashes = [np.array([xxhash.xxh64_intdigest(w)], np.uint64) for w in phrase.encode().split(b" ")]
                yield pa.RecordBatch.from_arrays([pa.array(positions(hashes, name))], ["at"])

    at = frequent.select("lang", "phrase").mapInArrow(places, "at bigint")
    chunks = at.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits")
    )
    out = bytearray(FILTER_BITS // 8)
    for chunk, bits in chunks.collect():  # at most FILTER_BITS / 32,768 rows of 4 KB
        start = (chunk - 1) * 4096
        out[start : start + len(bits)] = bits
    return bytes(out)


def counts(df: DataFrame, longest: int, least: int, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, phrase, width, n`` of all sequences of up to ``longest`` words with at least ``least`` occurrences.

    The phrase ``ALL_WORDS`` (width 0) has the number of all word occurrences, also where that is less. NULL
    languages count as ``und``, NULL texts as empty; other columns are not looked at. An empty table, or one
    without words, gives no phrases.
    """
    spark = df.sparkSession
    lean_batches(spark)
    hat_trie.bits_of(longest)
    texts = df.select(F.coalesce(F.col(f"`{lang}`"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    bitmap, cuts, out = None, {}, []
    for width in range(1, longest + 1):
        if width > 1:
            bitmap = _bitmap(out[-1].where(F.col("width") == width - 1))
            cuts = cuts or _cuts(out[0])
        merged = _runs(texts, width, bitmap, cuts).repartition("part").groupBy("part", "lang", "phrase").agg(F.sum("n").alias("n"))
        frequent = merged.where((F.col("n") >= least) | (F.col("phrase") == ALL_WORDS))
        numbered = F.when(F.col("phrase") == ALL_WORDS, 0).otherwise(width).alias("width")
        out.append(stored(frequent.select("lang", "phrase", numbered, "n"), "phrases"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _joined(words: Column, first: Column | int, n: Column) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def _part(frequent: DataFrame, name: str) -> DataFrame:
    return frequent.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(f"{name}_phrase"), F.col("n").alias(name))


def _whole(name: str) -> Column:
    """A count as an exact number of 15 digits; the products below have up to 38."""
    return F.col(name).cast("decimal(15,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, width, a, l, r, score`` of all phrases of two words or more, by their lowest-scoring cut."""
    words = F.split("phrase", " ", -1)
    cuts = frequent.where("width > 1").select("lang", "phrase", "width", F.col("n").alias("a"), words.alias("words"))
    cuts = cuts.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("width") - 1)))
    cuts = cuts.withColumns(
        {"first": _joined(F.col("words"), 1, F.col("cut")), "rest": _joined(F.col("words"), F.col("cut") + 1, F.col("width") - F.col("cut"))}
    ).drop("words")
    left, right = _part(frequent.where("width > 0"), "l"), _part(frequent.where("width > 0"), "r")
    cuts = cuts.join(left, (F.col("lang") == F.col("l_lang")) & (F.col("first") == F.col("l_phrase")))
    cuts = cuts.join(right, (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_phrase")))
    square = F.lit(1_000_000).cast("decimal(7,0)") * (_whole("a") * _whole("a"))
    cuts = cuts.withColumns({"square": square, "product": _whole("l") * _whole("r")}).withColumn("score", F.expr("square div product"))
    best = cuts.groupBy("lang", "phrase", "width", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "width", "a", "best.l", "best.r", "best.score")


def outside_longer(candidates: DataFrame, share: int = 50) -> DataFrame:
    """Candidates that are not inside a longer one with at least ``share`` percent of their occurrences."""
    words = F.split("phrase", " ", -1)
    longer = candidates.where("width > 2").select("lang", "width", F.col("a").alias("around"), words.alias("words"))
    longer = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("width") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("width") - F.col("size") + 1)))
    inside = longer.select(F.col("lang").alias("of"), _joined(F.col("words"), F.col("at"), F.col("size")).alias("inner"), "around")
    inside = inside.groupBy("of", "inner").agg(F.max("around").alias("around"))
    met = candidates.join(inside, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("inner")), "left")
    return met.where(F.col("around").isNull() | (_whole("around") * 100 < _whole("a") * share)).select(*candidates.columns)


def collocations(df: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of 2 to ``longest`` words (at most 4) with ``a >= least`` occurrences is a candidate. Cut into a first part
    with ``l`` and a rest with ``r`` occurrences it scores ``floor(1000000 * a * a / (l * r))``; its lowest-scoring cut
    counts, the earliest of ties. Candidates mostly inside a longer one are dropped (``outside_longer``). Ranks go by
    score and ``a`` descending, then by the phrase's UTF-8 bytes. ``n`` is the number of the language's words.
    NULL, empty and very long texts, empty tables and other columns: as for ``counts``; repeated rows count each time.
    """
    frequent = counts(df, longest, least, lang, text)
    candidates = stored(scored(frequent), "candidates")
    totals = frequent.where("width = 0").select(F.col("lang").alias("of"), F.col("n"))
    order = F.desc("score"), F.desc("a"), "phrase"
    # First within shares of a language, so that its last task reads some rows of each share, however many were ranked.
    dealt = outside_longer(candidates, share).withColumn("dealt", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "dealt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    ranked = ranked.join(totals, F.col("lang") == F.col("of"))
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
