"""Operator 10, sharding by a permutation-filled lookup table.

Every shard has a permutation of the slots of a table of prime size, given by an offset
and a step from its name's hash.  Shards take turns, each claiming the first
slot of its permutation that is still free, until the table is full; so shares differ by
one slot at most, and when a shard comes or goes few other slots change hands.
A row's slot is a hash of its key modulo the table size: one broadcast join with
the table, whose size is fixed by ``slots``, places it in constant time, without a shuffle.

Built-in functions only on the rows; the table itself is a parameter of at most ``slots`` entries.

Edge cases: a null key is placed as the empty string is; equal keys get the same
shard; an empty table gives no rows; other columns pass through; names that
clash with the added ``slot`` and ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 5003


def _hash(text: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{text}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Index of the shard that owns each slot; ``slots`` is a prime of at least ``len(shards)``."""
    if slots < max(2, len(shards)) or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} is not a prime of at least {len(shards)}")
    if not shards:
        raise ValueError("no shards")
    at = [_hash(s, "offset") % slots for s in shards]
    step = [_hash(s, "skip") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for k in range(len(shards)):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + step[k]) % slots
            owner[at[k]] = k
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def place(df: DataFrame, key: Column, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """Add ``slot`` and ``shard`` (the shard's name) to every row."""
    spark = df.sparkSession
    owner = spark.createDataFrame([(i, shards[k]) for i, k in enumerate(lookup_table(shards, slots))], "__slot int, __shard string")
    placed = df.withColumn("slot", slot_of(key, slots)).join(F.broadcast(owner), F.col("slot") == F.col("__slot"))
    return placed.withColumn("shard", F.col("__shard")).drop("__slot", "__shard")
