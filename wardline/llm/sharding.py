"""Placing records on shards by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a table whose size is a prime number.
The shards take turns: each claims its next preferred slot that is still free, until all
slots are taken. Shards then own equal numbers of slots (they differ by one at most, or
stand as their weights do), and when a shard leaves, almost only its own slots move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 1_000_003


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _numbers(name: str) -> tuple[int, int]:
    digest = hashlib.sha256(name.encode("utf-8")).digest()
    return int.from_bytes(digest[:8], "big"), int.from_bytes(digest[8:16], "big")


def lookup_table(shards: Sequence[str] | Mapping[str, int], size: int = TABLE_SIZE) -> list[int]:
    """The shard (by its place in the sorted names) that owns each slot.

    With weights, a shard takes as many turns in each round as its weight says. The order
    in which the names are given plays no part; names that repeat and weights under 1 are refused.
    """
    if not is_prime(size) or size > MAX_TABLE_SIZE:
        raise ValueError(f"the table size must be a prime of at most {MAX_TABLE_SIZE}")
    weights = dict(shards) if isinstance(shards, Mapping) else {name: 1 for name in shards}
    if not weights or len(weights) != len(shards) or len(weights) > size:
        raise ValueError("shards need distinct names, and fewer of them than slots")
    if any(not isinstance(w, int) or w < 1 for w in weights.values()):
        raise ValueError("weights are whole numbers from 1")
    names = sorted(weights)
    preferences = []
    for name in names:
        offset, skip = _numbers(name)
        preferences.append((offset % size, skip % (size - 1) + 1))
    table, turns, free = [-1] * size, [0] * len(names), size
    while free:
        for shard, (offset, skip) in enumerate(preferences):
            for _ in range(weights[names[shard]]):
                if not free:
                    break
                slot = (offset + turns[shard] * skip) % size
                while table[slot] >= 0:
                    turns[shard] += 1
                    slot = (offset + turns[shard] * skip) % size
                table[slot] = shard
                turns[shard] += 1
                free -= 1
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """60 bits of the key's MD5, modulo the table size; a null key counts as empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: Sequence[str] | Mapping[str, int], *,
          size: int = TABLE_SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """Add the slot and the shard of each row, in constant time a row and without a shuffle.

    The table is broadcast: it has ``size`` rows whatever the data, a million at most
    (about 16 MB). Rows with equal keys go to one shard; null keys all go to the shard of the empty
    text; columns of ``df`` that are already called as the new ones are replaced; an empty ``df``
    gives an empty result with the same columns.
    """
    names = sorted(shards)
    table = lookup_table(shards, size)
    owners = df.sparkSession.createDataFrame(
        [(i, names[s]) for i, s in enumerate(table)], "_slot int, _shard string")
    keep = [c for c in df.columns if c not in (slot, shard)]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")  # own columns can't clash
    placed = df.select(row, slot_of(F.col(key), size).alias("_slot")).join(
        F.broadcast(owners), "_slot", "left")
    return placed.select(*[F.col(f"_row.`{c}`") for c in keep], F.col("_slot").alias(slot),
                         F.col("_shard").alias(shard))
