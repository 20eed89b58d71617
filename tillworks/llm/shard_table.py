"""Placing keys on shards by a lookup table filled from permutations.

Each shard orders the slots of a prime-sized table by a permutation of its own. The shards take turns,
each claiming the first slot of its order that is still free, until all are taken. Every shard so gets
the same number of slots, give or take one, and when a shard comes or goes few slots change hands. A key
is placed by one look into the table.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime; about a hundred times the number of shards keeps them even to a hundredth.
SLOTS = 65_537
MOST_SLOTS = 1 << 22  # the table goes to every executor: 16 bytes a slot at most


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """Index of the shard in ``shards`` that holds each slot.

    The names must differ and be no more than the slots, of which there must be a prime number.
    """
    if not is_prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"the number of slots must be a prime up to {MOST_SLOTS}")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be different names, at least one and no more than the slots")
    starts, steps = [], []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        starts.append(int.from_bytes(digest[:8], "big") % slots)
        steps.append(int.from_bytes(digest[8:16], "big") % (slots - 1) + 1)
    table, places, taken = [-1] * slots, list(starts), 0
    while taken < slots:
        for k, step in enumerate(steps):
            place = places[k]
            while table[place] >= 0:
                place = (place + step) % slots
            table[place], places[k] = k, (place + step) % slots
            taken += 1
            if taken == slots:
                break
    return np.array(table, np.int32)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key by 60 bits of the MD5 of its text; NULL counts as an empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``slot, shard``: the filled table, a row per slot."""
    owners = fill(shards, slots)
    return spark.createDataFrame([(i, shards[k]) for i, k in enumerate(owners.tolist())], "slot int, shard string")


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """All rows of ``df`` with the columns ``slot`` and ``shard`` (replacing any of these names).

    Rows of equal keys, NULL included, are on one shard. The table has a row per slot, at most
    ``MOST_SLOTS``, and is broadcast; rows are not shuffled.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (slot, shard)]
    table = lookup(df.sparkSession, shards, slots).select(F.col("slot").alias("__lw_slot"), F.col("shard").alias("__lw_shard"))
    placed = df.withColumn("__lw_key_slot", slot_of(F.col(f"`{key}`"), slots))
    joined = placed.join(F.broadcast(table), F.col("__lw_key_slot") == F.col("__lw_slot"))
    return joined.select(*kept, F.col("__lw_slot").alias(slot), F.col("__lw_shard").alias(shard))


def write_shards(df: DataFrame, path: str, key: str, shards: list[str], slots: int = SLOTS) -> None:
    """Write ``df`` as Parquet with a folder per shard; a large shard is written by several tasks."""
    placed = place(df, key, shards, slots)
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
