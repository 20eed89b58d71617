"""Quality rules with adaptive thresholds per language and source.

Each text's counts become ratios; a mergeable quantile sketch of every ratio is kept per (language,
source); a document is rejected where a ratio lies beyond its group's fence. Sketches are counts per
logarithmic bin, so they merge by addition, in any order, and their quantiles are within ``ACCURACY``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm import texts
from tillworks.session import stored

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ACCURACY = 0.01
SMALLEST = 1e-4  # ratios below this share the zero bin

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_BLANK = " \t\n\r\x0b\x0c"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")
_COUNTS_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])

#: ratio -> (numerator, denominator, margin). A fence never lies nearer to the middle half than the margin,
#: so groups whose documents are all alike do not reject their ordinary variation.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words", 0.15),
    "duplicate_line_share": ("n_dup_lines", "n_lines", 0.50),
    "repeated_word_share": ("n_repeat_words", "n_words", 0.30),
    "upper_case_share": ("n_upper", "n_letters", 0.40),
    "chars_per_word": ("word_chars", "n_words", 4.0),
}


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return len(lines), len(lines) - len(set(lines))


def _repeated_words(hashes: np.ndarray, width: int) -> int:
    """Words inside windows of ``width`` words that occur at least twice."""
    windows = texts.window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[: len(windows)] += twice
    edges[width : width + len(windows)] -= twice
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def count_batch(column: pa.Array, window: int = WINDOW) -> pa.StructArray:
    """The counts of each text of an Arrow batch."""
    out = np.zeros((len(COUNTS), len(column)), np.int64)
    for first, data, offsets in texts.slices(column):
        rows = slice(first, first + len(offsets) - 1)
        starts, ends, at = texts.words(data, offsets)
        points = (data & 0xC0) != 0x80
        upper = (data >= 65) & (data <= 90)
        lower = (data >= 97) & (data <= 122)
        out[0, rows] = np.diff(at)
        out[1, rows] = texts.per_text(points & ~texts.SPACES[data], offsets)
        out[2, rows] = texts.per_text(_SYMBOLS[data], offsets)
        out[6, rows] = texts.per_text(upper, offsets)
        out[7, rows] = texts.per_text(upper | lower, offsets)
        hashes = texts.word_hashes(data, starts, ends)
        raw = data.tobytes()
        for k in range(len(offsets) - 1):
            out[4, first + k] = _repeated_words(hashes[at[k] : at[k + 1]], window)
            lines, repeats = _lines(raw[offsets[k] : offsets[k + 1]].decode("utf-8", "replace"))
            out[3, first + k], out[5, first + k] = repeats, lines
    return pa.StructArray.from_arrays([pa.array(x) for x in out], list(COUNTS))


@F.arrow_udf(_COUNTS_TYPE)
def text_counts(text: pa.Array) -> pa.Array:
    """Counts of a whole text as a struct; NULL counts as empty."""
    return count_batch(text)


def base_failed(counts: Column) -> Column:
    """Too few words, or too large a share of them in repeated windows."""
    n = counts["n_words"]
    return (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)


def ratio(counts: Column, name: str) -> Column:
    top, bottom, _ = RATIOS[name]
    return F.when(counts[bottom] > 0, counts[top] / counts[bottom]).otherwise(F.lit(0.0))


def _bin(value: Column) -> Column:
    """Bin 0 holds values up to ``SMALLEST``; bin k those whose logarithm rounds up to k."""
    step = math.log((1 + ACCURACY) / (1 - ACCURACY))
    return F.when(value <= SMALLEST, F.lit(0)).otherwise(F.ceil(F.log(value / SMALLEST) / step)).cast("int")


def _middle(bin_: Column) -> Column:
    """A bin's value, within ``ACCURACY`` of all in it."""
    growth = (1 + ACCURACY) / (1 - ACCURACY)
    return F.when(bin_ == 0, F.lit(0.0)).otherwise(SMALLEST * F.pow(F.lit(growth), bin_) * 2 / (growth + 1))


def sketch(counted: DataFrame, groups: tuple[str, ...], counts: str) -> DataFrame:
    """``groups, metric, bin, n``: a row per filled bin, summed on the map side before the shuffle."""
    bins = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), _bin(ratio(F.col(counts), m)).alias("bin")) for m in RATIOS]))
    return (
        counted.select(*groups, bins.alias("b"))
        .groupBy(*groups, F.col("b.metric").alias("metric"), F.col("b.bin").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """One sketch of all rows the given sketches cover."""
    merged = sketches[0]
    for other in sketches[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy(*[c for c in merged.columns if c != "n"]).agg(F.sum("n").alias("n"))


def quantiles(sketched: DataFrame, groups: tuple[str, ...], wanted: dict[str, float]) -> DataFrame:
    """``groups, metric`` and a column per wanted quantile: the value of the bin in which it falls.

    A group has at most some hundred bins per metric, whatever its number of rows.
    """
    bins = sketched.groupBy(*groups, "metric").agg(
        F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("total")
    )

    def at(share: float) -> Column:
        run = F.aggregate(
            "bins",
            F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("bin")),
            lambda acc, b: F.struct(
                (acc["seen"] + b["n"]).alias("seen"),
                F.when(acc["bin"].isNull() & (acc["seen"] + b["n"] >= share * F.col("total")), b["bin"])
                .otherwise(acc["bin"])
                .alias("bin"),
            ),
        )
        return _middle(run["bin"])

    return bins.select(*groups, "metric", *[at(share).alias(name) for name, share in wanted.items()])


def fences(sketched: DataFrame, groups: tuple[str, ...], reach: float = 3.0) -> DataFrame:
    """``groups`` and a map from ratio to its upper fence.

    The fence lies ``reach`` times the middle half's width above the third quartile, or the ratio's
    margin above it if that is more.
    """
    margin = F.create_map(*[x for m, (_, _, least) in RATIOS.items() for x in (F.lit(m), F.lit(least))])
    width = F.greatest(reach * (F.col("q3") - F.col("q1")), margin[F.col("metric")])
    return (
        quantiles(sketched, groups, {"q1": 0.25, "q3": 0.75})
        .groupBy(*groups)
        .agg(F.map_from_entries(F.collect_list(F.struct("metric", (F.col("q3") + width).alias("fence")))).alias("fences"))
    )


def judge(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", out: str = "quality", keep: tuple[str, ...] = ()
) -> DataFrame:
    """All rows of ``df`` with its columns (or those named in ``keep``) and a struct ``out``: the counts,
    ``base_failed`` and ``kept``.

    NULL texts count as empty and fail the base rules, as do empty ones. NULL language or source is
    a group of its own. Equal rows get equal verdicts. An existing column ``out`` is replaced.
    Fences are learned from the documents that pass the base rules. Matching groups is NULL-safe.
    """
    texts.lean_batches(df.sparkSession)
    kept_columns = [F.col(f"`{c}`") for c in (keep or df.columns) if c != out]
    groups = ("__lw_lang", "__lw_source")
    own = [F.col(f"`{c}`").alias(name) for c, name in zip((lang, source), groups)]
    counted = stored(df.select(*kept_columns, *own, text_counts(F.col(f"`{text}`")).alias("__lw_counts")), "quality-counts")
    counts = F.col("__lw_counts")
    failed = base_failed(counts)
    learned = fences(sketch(counted.where(~failed), groups, "__lw_counts"), groups)
    learned = learned.select(*[F.col(g).alias(f"{g}_of") for g in groups], F.col("fences").alias("__lw_fences"))
    learned = stored(learned, "quality-fences")  # of known size: within its bound Spark broadcasts it and leaves the texts in place
    same_group = F.col(groups[0]).eqNullSafe(F.col(f"{groups[0]}_of")) & F.col(groups[1]).eqNullSafe(F.col(f"{groups[1]}_of"))
    joined = counted.join(learned, same_group, "left")
    within = F.lit(True)
    for name in RATIOS:
        within = within & F.coalesce(ratio(counts, name) <= F.col("__lw_fences")[name], F.lit(True))
    verdict = F.struct(
        *[counts[name].alias(name) for name in COUNTS], failed.alias("base_failed"), (~failed & within).alias("kept")
    )
    return joined.select(*kept_columns, verdict.alias(out))
