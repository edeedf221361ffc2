"""Sharding by a permutation-filled lookup table (native).

The table has a prime number of slots. Each shard prefers the slots in an order of its own (an offset and a skip from
its name), and the shards take turns to claim the next slot of their order that is free. Keys are hashed to slots. Shares
differ by one slot at most, and few keys move when a shard comes or goes. The table has a fixed size, so it is broadcast.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow

#: More than a hundred slots a shard keep shares within one per cent.
SLOTS = 4099
SHARDS = 32


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (its place in ``shards``) of each slot. ``slots`` must be prime and not fewer than the shards."""
    if not _is_prime(slots) or not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("slots must be a prime, at least as many as there are shards, and the shards' names distinct")
    digests = [hashlib.md5(s.encode()).digest() for s in shards]  # noqa: S324
    place = [int.from_bytes(d[:8], "big") % slots for d in digests]
    skip = [int.from_bytes(d[8:], "big") % (slots - 1) + 1 if slots > 2 else 1 for d in digests]
    table, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            if not free:
                break
            while table[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % slots
            table[place[i]] = i
            free -= 1
    return table


def names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def slot(key: str, slots: int = SLOTS) -> F.Column:
    """Slot of a key: the first 32 bits of the md5 of its text, modulo the number of slots; null keys count as ''."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long") % slots


def assign(rows: DataFrame, shards: list[str], id_col: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """(doc_id, slot, shard, shard_without_last) of every row: where it goes, and where it would go if the last shard
    were gone. Null ids share a slot; repeated rows each give a row, in the same shard."""
    one, two = fill(shards, slots), fill(shards[:-1], slots) if len(shards) > 1 else [None] * slots
    table = rows.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(zip(one, two, strict=True))], "slot long, shard int, shard_without_last int")
    return narrow(rows, doc_id=id_col).select("doc_id", slot("doc_id", slots).alias("slot")).join(F.broadcast(table), "slot").select("doc_id", "slot", "shard", "shard_without_last")


def sharded(rows: DataFrame, shards: list[str], id_col: str = "doc_id", slots: int = SLOTS, name: str = "__shard") -> DataFrame:
    """``rows``, all columns, with ``name``: the place of its shard, from the table as a literal array. A column of that name
    isn't overwritten: it raises."""
    if name in rows.columns:
        raise ValueError(f"there is a column {name}")
    return rows.withColumn(name, F.get(F.array([F.lit(x) for x in fill(shards, slots)]), slot(id_col, slots).cast("int")))
