"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537  # prime, so that every skip visits all slots; bounds what is broadcast


def digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Which shard holds each slot. Shards take turns; each claims the next free slot of its own permutation.

    A shard's permutation starts at one hash of its name and goes on by another, modulo the prime number of slots.
    Shares differ by one slot at most, and a shard added or removed moves few slots besides its own."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one and no more than the slots")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    at = [digest(f"offset:{s}") % slots for s in shards]
    skip = [digest(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    table, claimed = [-1] * slots, 0
    while True:
        for k in range(len(shards)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % slots
            table[at[k]] = k
            claimed += 1
            if claimed == slots:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(docs: DataFrame, shards: list[str], slots: int = SLOTS, key: Column | None = None) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` by its doc_id: one broadcast lookup of ``slots`` rows, no shuffle.

    A row with a null id is placed by its text, and one with neither by the empty text; equal keys go to one shard.
    Columns of ``docs`` named slot or shard are replaced. An empty table gives an empty result."""
    key = key if key is not None else F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    held = docs.sparkSession.createDataFrame([(i, shards[k]) for i, k in enumerate(lookup_table(shards, slots))], "slot int, shard string")
    return docs.drop("slot", "shard").withColumn("slot", slot_of(key, slots)).join(F.broadcast(held), "slot").select(*[c for c in docs.columns if c not in ("slot", "shard")], "slot", "shard")
