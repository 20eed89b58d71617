"""Mixing sources to target weights by entropy balancing.

Document rates stay as near to one, in relative entropy, as each source's token constraint and the
bound on copies allow: the solution is ``min(max_copies, exp(multiplier * size))`` with a multiplier per
source that solves the convex dual. Newton's method runs on counts per (source, size), which hold all
that the dual needs; the rates are then rounded into whole copies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.session import stored

MAX_COPIES = 3
CLOSE = 1e-10  # relative distance from the target at which Newton's method ends
MOST_STEPS = 60
MOST_REPAIRS = 40
RANKED_ROWS = 4096  # documents of one source and size ranked together

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a whole text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cyclic_weights(key: str = "source_key") -> Column:
    """1, 2, 3 and again, over the sources in code point order, NULL last. It ranks sources, not rows."""
    return ((F.row_number().over(Window.orderBy(key)) - 1) % 3 + 1).cast("double")


def source_targets(totals: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """Add ``target``: the share of all tokens by ``weight``, but at most ``max_copies`` times ``source_size``.

    What a bound cuts off goes to the others by weight until none is above its bound.
    """
    bound = F.col("source_size") * float(max_copies)
    whole = totals.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # the level rises as sources reach their bounds, so at least one more does in every round
        over = F.col("weight") * level >= bound
        cut, left = totals.agg(F.sum(F.when(over, bound)), F.sum(F.when(~over, F.col("weight")))).first()
        if left is None:
            break
        higher = (whole - (cut or 0.0)) / left
        if higher <= level:
            break
        level = higher
    return totals.withColumn("target", F.least(F.col("weight") * level, bound).cast("double"))


def _rate(multiplier: str, size: str, mean: str, max_copies: int) -> Column:
    return F.exp(F.least(F.col(multiplier) * F.col(size) / F.col(mean), F.lit(math.log(max_copies))))


def solve_dual(cells: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source_key, multiplier`` for every source with tokens, by Newton steps inside a bracket.

    A source whose target is its bound has no finite multiplier and gets +infinity.
    """
    sizes = cells.where("size > 0").join(targets.where("source_size > 0").select("source_key"), "source_key")
    full = F.col("target") >= F.col("source_size") * float(max_copies) * (1 - 1e-12)
    now = stored(
        targets.where("source_size > 0").select(
            "source_key",
            "target",
            (F.col("source_size") / F.col("n_sized")).alias("mean"),
            F.when(full, F.lit(float("inf"))).otherwise(F.lit(0.0)).alias("multiplier"),
            F.lit(float("-inf")).alias("low"),
            F.lit(float("inf")).alias("high"),
            full.alias("solved"),
        ),
        "dual",
    )
    for _ in range(MOST_STEPS):
        if not now.where("NOT solved").limit(1).count():
            break
        rate = _rate("multiplier", "size", "mean", max_copies)
        tokens = F.col("n") * F.col("size") * rate
        curved = F.when(rate < max_copies, tokens * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            sizes.join(now.where("NOT solved").select("source_key", "multiplier", "mean"), "source_key")
            .groupBy("source_key")
            .agg(F.sum(tokens).alias("tokens"), F.sum(curved).alias("curve"))
        )
        low = F.when(F.col("tokens") <= F.col("target"), F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(F.col("tokens") >= F.col("target"), F.col("multiplier")).otherwise(F.col("high"))
        step = now.join(sums, "source_key", "left").select(
            "source_key", "target", "mean", "multiplier", "tokens", "curve", "solved", low.alias("low"), high.alias("high")
        )
        newton = F.col("multiplier") + (F.col("target") - F.col("tokens")) / F.col("curve")
        inside = (F.col("curve") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        middle = (
            F.when(F.col("high") == float("inf"), F.greatest(F.col("low") * 2, F.lit(1.0)))
            .when(F.col("low") == float("-inf"), F.least(F.col("high") * 2, F.lit(-1.0)))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        done = F.col("solved") | (F.abs(F.col("tokens") - F.col("target")) <= CLOSE * F.col("target"))
        now = stored(
            step.select(
                "source_key",
                "target",
                "mean",
                F.when(done, F.col("multiplier")).when(inside, newton).otherwise(middle).alias("multiplier"),
                "low",
                "high",
                done.alias("solved"),
            ),
            "dual",
        )
    return now.select("source_key", "multiplier", "mean")


def round_cells(cells: DataFrame, multipliers: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """Add ``copies``: whole copies of all documents of a (source, size), whose tokens come near the target.

    Rates are summed up along the sizes and rounded there, which leaves at most about the longest
    document over; then one copy at a time goes to, or comes from, the size that brings the source
    nearest to its target, as long as that helps.
    """
    along = Window.partitionBy("source_key").orderBy("size")  # sizes of one source, not rows
    wanted = F.when(F.col("size") == 0, F.col("n")).otherwise(
        F.col("n") * F.coalesce(_rate("multiplier", "size", "mean", max_copies), F.lit(0.0))
    )
    up_to = F.floor(F.sum("wanted").over(along) + F.lit(0.5))
    now = cells.join(multipliers, "source_key", "left").withColumn("wanted", wanted.cast("double"))
    now = now.withColumn("up_to", up_to).withColumn("copies", F.col("up_to") - F.coalesce(F.lag("up_to").over(along), F.lit(0)))
    copies = F.greatest(F.lit(0), F.least("copies", F.col("n") * max_copies)).cast("bigint")
    now = stored(now.select("source_key", "size", "n", copies.alias("copies")), "rounded")
    for _ in range(MOST_REPAIRS):
        missing = (
            now.groupBy("source_key")
            .agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
            .join(targets.select("source_key", "target"), "source_key")
            .select("source_key", (F.col("target") - F.col("taken")).alias("missing"))
        )
        room = F.when(F.col("missing") > 0, F.col("copies") < F.col("n") * max_copies).otherwise(F.col("copies") > 0)
        left = F.abs(F.abs("missing") - F.col("size"))
        moves = (
            now.join(missing, "source_key")
            .where((F.col("size") > 0) & room & (left < F.abs("missing")))
            .groupBy("source_key")
            .agg(F.min_by(F.struct("size", F.signum("missing").cast("bigint").alias("by")), F.struct(left, "size")).alias("move"))
        )
        moves = stored(moves.select("source_key", F.col("move.size").alias("size"), F.col("move.by").alias("by")), "repair")
        if not moves.limit(1).count():
            break
        now = stored(
            now.join(moves, ["source_key", "size"], "left").select(
                "source_key", "size", "n", (F.col("copies") + F.coalesce("by", F.lit(0))).alias("copies")
            ),
            "rounded",
        )
    return now


def copies_per_document(sized: DataFrame, cells: DataFrame) -> DataFrame:
    """Deal each cell's copies to its documents: all get the whole part, those of the smallest hashes one more.

    A cell of many documents is cut into parts by hash, each of which gets its share, so that no task
    ranks more than some thousand rows.
    """
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.ceil(F.col("n") / RANKED_ROWS)).cast("int")
    cell = ["source_key", "size"]
    placed = sized.join(cells, cell).withColumn("part", part)
    before = Window.partitionBy(*cell).orderBy("part")  # parts of a cell, a few thousandths of its rows
    extra = F.col("copies") % F.col("n")
    shares = (
        placed.groupBy(*cell, "part", "n", "copies")
        .agg(F.count("*").alias("n_part"))
        .withColumn("up_to", F.floor(F.sum("n_part").over(before) * extra / F.col("n")))
        .withColumn("extra", F.col("up_to") - F.coalesce(F.lag("up_to").over(before), F.lit(0)))
        .select(*cell, "part", "extra")
    )
    ranked = F.row_number().over(Window.partitionBy(*cell, "part").orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id"))
    return placed.join(shares, [*cell, "part"]).select(
        "doc_id", *cell, (F.floor(F.col("copies") / F.col("n")) + F.when(ranked <= F.col("extra"), 1).otherwise(0)).alias("copies")
    )


def mix(
    df: DataFrame, doc_id: str = "doc_id", source: str = "source", size: Column | None = None,
    weight: Column | None = None, max_copies: int = MAX_COPIES,
) -> DataFrame:
    """``doc_id, source_key, size, source_size, weight, target, copies`` for each row.

    ``size`` is the tokens of a row (words of ``text`` unless given), ``weight`` an expression over the
    sources, of which there is a row with ``source_key`` ('0' and the name, or '1' for NULL) and
    ``source_size``. Sources of NULL form one. Rows of size 0 are taken once and no source without tokens
    has a target. Rows that repeat an id count on their own; equal rows may get different copies, but the
    same ones in every run.
    """
    key = F.when(F.col(f"`{source}`").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(f"`{source}`")))
    tokens = word_count(F.col("`text`")) if size is None else size
    sized = stored(df.select(F.col(f"`{doc_id}`").alias("doc_id"), key.alias("source_key"), tokens.alias("size")), "sized")
    cells = stored(sized.groupBy("source_key", "size").agg(F.count("*").alias("n")), "cells")
    totals = cells.groupBy("source_key").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("n_sized")
    )
    weighed = stored(totals.withColumn("weight", cyclic_weights() if weight is None else weight), "sources")
    targets = stored(source_targets(weighed, max_copies), "targets")
    rounded = round_cells(cells, solve_dual(cells, targets, max_copies), targets, max_copies)
    dealt = copies_per_document(sized, rounded)
    return dealt.join(targets.select("source_key", "source_size", "weight", "target"), "source_key")
