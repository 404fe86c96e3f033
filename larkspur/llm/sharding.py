"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size; the shards take
turns, each claiming its next free slot, until the table is full.  A key's hash picks a slot and the
slot names the shard.  Shards get nearly equal numbers of slots, and a lost shard's slots are taken
over with few other slots changing hands.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime; the table has so many rows of two integers, about 1 MB, whatever the data.
SLOTS = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> list[int]:
    """For each slot the index of its shard.  A shard of weight w takes w turns a round.

    Raises if `slots` is not a prime or there are no shards, more shards than slots or repeated names.
    """
    if not _is_prime(slots):
        raise ValueError(f"{slots} is not a prime")
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, one at least and no more than slots")
    turns = weights or [1] * len(shards)
    if len(turns) != len(shards) or min(turns) < 0 or not any(turns):
        raise ValueError("weights need one number a shard, none negative, one above zero")
    walk = []
    for name in shards:
        seed = hashlib.sha256(name.encode()).digest()
        walk.append([int.from_bytes(seed[:8], "big") % slots, int.from_bytes(seed[8:16], "big") % (slots - 1) + 1 if slots > 2 else 1])
    table, left = [-1] * slots, slots
    while left:
        for k, (at, skip) in enumerate(walk):
            for _ in range(min(turns[k], left)):
                while table[at] >= 0:
                    at = (at + skip) % slots
                table[at] = k
                left -= 1
            walk[k][0] = at
            if not left:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of its text's md5; null counts as the empty text."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long") % slots).cast("int")


def placed(df: DataFrame, shards: list[str], key_col: str = "doc_id", slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    """`df` with slot and shard.  The table has a fixed number of rows, so it is broadcast; rows
    with equal keys, null ones too, share a shard.  Columns of those names are replaced."""
    rows = [(k, shards[s]) for k, s in enumerate(lookup_table(shards, slots, weights))]
    table = df.sparkSession.createDataFrame(rows, "slot int, shard string")
    kept = df.drop("slot", "shard") if key_col not in ("slot", "shard") else df
    if key_col in ("slot", "shard"):
        raise ValueError("rename the key column")
    return kept.withColumn("slot", slot_of(F.col(key_col), slots)).join(F.broadcast(table), "slot").select(*kept.columns, "slot", "shard")


def moved_share(before: list[str], after: list[str], slots: int = SLOTS) -> float:
    """Share of slots that change hands between two sets of shards, by name."""
    a, b = lookup_table(before, slots), lookup_table(after, slots)
    return sum(before[x] != after[y] for x, y in zip(a, b)) / slots


def write_shards(df: DataFrame, path: str, shards: list[str], key_col: str = "doc_id", files: int = 8) -> None:
    """Write one folder a shard.  Each shard's rows are dealt over `files` tasks by the slot, so a
    large shard is not one task."""
    rows = placed(df, shards, key_col)
    rows.repartition(len(shards) * files, "shard", F.col("slot") % files).write.partitionBy("shard").parquet(path)
