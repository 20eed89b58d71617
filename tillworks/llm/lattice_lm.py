"""Language-model scores of texts from a subword lattice.

The tokens are the pieces of an existing vocabulary, all bytes, and every word of the training texts. The
piece scores are trained here, by expectation and maximisation over the counts of all training words; a
word never seen gets its probability from all its segmentations, a seen one from its count as well, the
two weighed by the share of words seen once (the mass of unseen words after Good and Turing). There is
one such model per language of the training documents, and a text's probability is their mixture, so a
score needs nothing but the text.

Words and their scores stay in tables: only the ``HEAD`` most frequent go to every worker, the rest is
matched by a join, in which every word is rare.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.lattice import Lattice
from tillworks.llm.texts import gathered, lean_batches
from tillworks.session import stored

HEAD = 200_000
LANGUAGES = 7  # languages with a model of their own, by documents; the others share one
ROUNDS = 2
ADDED = 0.01
FLUSH = 300_000
WORD_ROWS = 20_000


def vocabulary(path: str) -> list[bytes]:
    """The pieces of a SentencePiece model that can occur in a lower-cased word, the word mark as a space."""
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    out = set()
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i)) and "▁" not in piece[1:]:
            out.add(piece.replace("▁", " ").encode().lower())
    return sorted(out)


@functools.lru_cache(maxsize=2)
def _lattice(path: str) -> Lattice:
    return Lattice(vocabulary(path))


def split(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


@dataclass(frozen=True)
class Model:
    """Trained figures. ``words`` holds ``word, count, logs``: a natural logarithm per language."""

    words: DataFrame
    tokens: int
    types: int
    documents: int
    shares: tuple[float, ...]  # of the training documents, per language
    ends: tuple[float, ...]  # probability of the end as the next token, per language

    def base(self, count: float | np.ndarray) -> float | np.ndarray:
        """Add-one log10 probability of a token with this count."""
        return np.log10((count + 1) / (self.tokens + self.types + 1))


def count_words(df: DataFrame, text: str, language: Column, train: Column) -> DataFrame:
    """``word, language, n`` summed over all rows: training words by language, the others with n = 0."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for k, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(counts.keys(), pa.binary()),
                        pa.array(np.full(len(counts), k, np.int32)),
                        pa.array([0] * len(counts) if k < 0 else list(counts.values()), pa.int64()),
                    ],
                    ["word", "language", "n"],
                )
            held.clear()

        for batch in batches:
            for t, k in zip(batch.column(0), batch.column(1).to_pylist()):
                held.setdefault(k, Counter()).update(split(t.as_py()))
                if sum(map(len, held.values())) > FLUSH:
                    yield from flush()
        yield from flush()

    rows = df.select(F.col(f"`{text}`").alias("text"), F.when(train, language).otherwise(-1).cast("int").alias("k"))
    return rows.mapInArrow(counted, "word binary, language int, n bigint").groupBy("word", "language").agg(F.sum("n").alias("n"))


def _expect(counts: DataFrame, path: str, scores: list[np.ndarray | None], languages: int) -> np.ndarray:
    """Expected uses ``[language, token]`` over all training words."""

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(path)
        total = np.zeros((languages, len(lattice.tokens)))
        for batch in gathered(batches, WORD_ROWS):
            k, n = batch.column("language").to_numpy(), batch.column("n").to_numpy().astype(float)
            words = batch.column("word").to_pylist()
            for one in np.unique(k):
                at = np.flatnonzero(k == one)
                lattice.scores = _uniform(lattice) if scores[one] is None else scores[one]
                total[one] += lattice.expected_counts([words[i] for i in at], n[at])
        used = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[0].astype(np.int32)), pa.array(used[1].astype(np.int32)), pa.array(total[used])], ["language", "token", "uses"]
        )

    summed = (
        counts.where("language >= 0")
        .mapInArrow(expected, "language int, token int, uses double")
        .groupBy("language", "token")
        .agg(F.sum("uses").alias("uses"))
        .toArrow()  # at most a row per language and vocabulary token, whatever the corpus
    )
    out = np.zeros((languages, len(_lattice(path).tokens)))
    language, token, uses = (summed.column(c).to_numpy() for c in ("language", "token", "uses"))
    out[language, token] = uses
    return out


def _uniform(lattice: Lattice) -> np.ndarray:
    return np.full(len(lattice.tokens), -math.log(len(lattice.tokens)))


def fit(df: DataFrame, path: str, train: Column, text: str = "text", lang: str = "lang") -> Model:
    """Train on the rows of ``df`` for which ``train`` holds, over all their words.

    Words of the other rows are scored along with count 0. NULL texts
    count as empty, NULL languages as one of those that share a model. Without training rows every word
    gets the lattice of equal scores.
    """
    lean_batches(df.sparkSession)
    groups = (
        df.where(train & F.col(f"`{lang}`").isNotNull())
        .groupBy(F.col(f"`{lang}`").alias("lang"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "lang")
        .limit(LANGUAGES)
        .collect()
    )
    names = [r["lang"] for r in groups]
    k_all = len(names) + 1
    language = F.lit(len(names))
    for k, name in enumerate(names):
        language = F.when(F.col(f"`{lang}`") == name, F.lit(k)).otherwise(language)
    counts = stored(count_words(df, text, language, train), "lm-counts")

    documents = np.zeros(k_all)
    for row in df.where(train).groupBy(language.alias("k")).agg(F.count("*").alias("n")).collect():
        documents[row["k"]] = row["n"]
    sums = np.zeros((k_all, 2))
    for row in (
        counts.where("language >= 0").groupBy("language").agg(F.sum("n").alias("n"), F.sum((F.col("n") == 1).cast("int")).alias("once")).collect()
    ):
        sums[row["language"]] = row["n"], row["once"]

    scores: list[np.ndarray | None] = [None] * k_all
    for _ in range(ROUNDS):
        uses = _expect(counts, path, scores, k_all) + ADDED
        scores = [np.log(u / u.sum()) for u in uses]
    unseen = np.clip(sums[:, 1] / np.maximum(sums[:, 0], 1), 1 / (sums[:, 0] + 1), 0.5)
    unseen[sums[:, 0] == 0] = 1.0

    by_word = counts.groupBy("word").agg(
        *[F.sum(F.when(F.col("language") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(k_all)]
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(path)
        for batch in gathered(batches, WORD_ROWS):
            words = batch.column("word").to_pylist()
            n = np.column_stack([batch.column(f"n{k}").to_numpy() for k in range(k_all)]).astype(float)
            spelled = lattice.log_probabilities(words, scores)
            logs = np.log((1 - unseen) * n / np.maximum(sums[:, 0], 1) + unseen * np.exp(spelled) + 1e-300)
            logs = np.where(n > 0, logs, np.log(unseen) + spelled)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word").combine_chunks(), pa.array(n.sum(1).astype(np.int64)), pa.array(logs.tolist(), pa.list_(pa.float64()))],
                ["word", "count", "logs"],
            )

    words = stored(by_word.mapInArrow(scored, "word binary, count bigint, logs array<double>"), "lm-words")
    types = words.where("count > 0").count()
    n_documents = int(documents.sum())
    model = Model(
        words,
        int(sums[:, 0].sum()) + n_documents,
        types + (n_documents > 0),
        n_documents,
        tuple((documents / max(1, n_documents)).tolist() if n_documents else [0.0] * (k_all - 1) + [1.0]),
        tuple(((documents + 0.5) / (documents + sums[:, 0] + 1)).tolist()),
    )
    return model


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    """``doc_id``, the carried columns and ``n_tokens, n_known, train_tokens, base_score, score`` of every row.

    A text's words and one end are its tokens; NULL counts as empty, which leaves the end. Rows that repeat
    an id are scored one by one. The words of ``df`` must have been among those the model was fitted over.
    """
    spark = df.sparkSession
    languages = len(model.shares)
    head = model.words.where("count > 0").orderBy(F.desc("count"), "word").limit(HEAD).toArrow()  # bounded by HEAD
    head = head.combine_chunks()
    logs = head.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, languages)
    shared = spark.sparkContext.broadcast((head.select(["word"]), logs, model.base(head.column("count").to_numpy().astype(float))))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of_head, logs, base = shared.value
        get = {word: i for i, word in enumerate(words_of_head.column("word").to_pylist())}.get
        for batch in batches:
            n, known, bases, sums, tails = [], [], [], [], []
            for t in batch.column("text"):
                words = split(t.as_py())
                at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                found = at[at >= 0]
                n.append(len(words))
                known.append(len(found))
                bases.append(float(base[found].sum()))
                sums.append(logs[found].sum(0).tolist())
                tails.append([words[i] for i in np.flatnonzero(at < 0)])
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1]
                + [
                    pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(bases, pa.float64()),
                    pa.array(sums, pa.list_(pa.float64())),
                    pa.array(tails, pa.list_(pa.binary())),
                ],
                batch.schema.names[:-1] + ["n", "known", "base", "logs", "tail"],
            )

    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), *carry, F.col(f"`{text}`").alias("text")
    )
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    more = "n bigint, known bigint, base double, logs array<double>, tail array<binary>"
    head_sums = stored(rows.mapInArrow(summed, f"{kept}, {more}"), "lm-sums")

    base = F.log10((F.col("count") + 1) / F.lit(float(model.tokens + model.types + 1)))
    tail_sums = (
        head_sums.select("row", F.explode("tail").alias("word"))
        .join(model.words, "word")
        .groupBy("row")
        .agg(
            F.sum((F.col("count") > 0).cast("bigint")).alias("tail_known"),
            F.sum(base).alias("tail_base"),
            *[F.sum(F.col("logs")[k]).alias(f"tail_{k}") for k in range(languages)],
        )
    )
    parts = [
        F.lit(math.log(share) + math.log(end))
        + F.col("n") * math.log1p(-end)
        + F.col("logs")[k]
        + F.coalesce(f"tail_{k}", F.lit(0.0))
        for k, (share, end) in enumerate(zip(model.shares, model.ends))
        if share > 0
    ]
    top = F.array_max(F.array(*parts))
    total = functools.reduce(lambda x, y: x + y, [F.exp(part - top) for part in parts])
    kept_columns = [f.name for f in rows.schema.fields[1:-1]]
    return head_sums.join(tail_sums, "row", "left").select(
        *[F.col(f"`{c}`") for c in kept_columns],
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("tail_known", F.lit(0)) + (1 if model.documents else 0)).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0)) + float(model.base(model.documents))).alias("base_score"),
        ((top + F.log(total)) / math.log(10)).alias("score"),
    )
