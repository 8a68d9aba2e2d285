"""Placement of documents on shards by a permutation-filled lookup table.

Shard i prefers the slots (offset_i + j * skip_i) mod M, j = 0, 1, ..., both
numbers from the hash of its name; as M is prime this is a permutation. The
shards take turns, each claiming its first free slot, until all M are taken, so
shares differ by one slot at most and a lost shard moves few others. A document
goes to the shard of slot hash(id) mod M; the table has M rows and is broadcast.

Cases: null ids count as the empty string; repeated ids share a slot; the text
is not read; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Slots; the table is broadcast, so its size is a bounded parameter.
SLOTS, MOST_SLOTS = 4093, 1_000_003


def _number(text: str) -> int:
    """First 32 bits of the md5 of a text (SQL engines have it too)."""
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Index of the shard that holds each slot."""
    if not 0 < len(shards) <= slots <= MOST_SLOTS or any(slots % p == 0 for p in range(2, int(slots ** 0.5) + 1)) or slots < 3:
        raise ValueError("slots must be a prime of at least the number of shards")
    at = [_number(s + "#offset") % slots for s in shards]
    skip = [_number(s + "#skip") % (slots - 1) + 1 for s in shards]
    table, taken = [-1] * slots, 0
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            taken += 1
            if taken == slots:
                return table


def slot_of(key: Column, slots: int) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(slots))


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    rows = ", ".join(f"({k}L, '{shards[i]}')" for k, i in enumerate(lookup_table(shards, slots)))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(slot, shard)")


def place(docs: DataFrame, shards: list[str], slots: int = SLOTS, id_col: str = "doc_id") -> DataFrame:
    """doc_id, slot, shard of every row."""
    rows = docs.select(docs[id_col].alias("doc_id")).withColumn("slot", slot_of(F.col("doc_id"), slots))
    return rows.join(F.broadcast(table_frame(docs.sparkSession, shards, slots)), "slot").select("doc_id", "slot", "shard")
