"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table: an offset and a step from
its own name, which together visit each slot once. Shards take turns, each claiming its next free
slot, until the table is full. Shards then own the same number of slots within one, and when a shard
goes, few slots of the others change hands.

The table depends on the shard names alone, never on the data. It is broadcast, and a row finds its
shard by one hash and one lookup; no row moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 16_381  # prime
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Slot -> position in ``shards``; names are visited in the given order."""
    if not shards:
        raise ValueError("no shards")
    if len(set(shards)) != len(shards):
        raise ValueError("shard names repeat")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table size has to be a prime of at least the number of shards")
    place = [_number(f"{name}/offset") % slots for name in shards]
    step = [_number(f"{name}/step") % (slots - 1) + 1 for name in shards]
    table = [-1] * slots
    left = slots
    while True:
        for shard in range(len(shards)):
            while table[place[shard]] >= 0:
                place[shard] = (place[shard] + step[shard]) % slots
            table[place[shard]] = shard
            left -= 1
            if not left:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of the md5 of its text, modulo the table size. A null key
    has the slot of the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % slots


def assign_shards(
    df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """Returns key, slot and shard of every row of ``df``; other columns are not read.

    Equal keys share a shard, repeated rows stay repeated, an empty table gives no rows.
    """
    table = ",".join(map(str, fill_table(shards, slots)))
    lookup = df.sparkSession.range(1).select(
        F.posexplode(F.split(F.lit(table), ",")).alias("slot", "shard")
    )
    lookup = lookup.select(F.col("slot").cast("bigint"), F.col("shard").cast("int"))
    placed = df.select(F.col(key), slot_of(F.col(key), slots).alias("slot"))
    # The lookup has as many rows as the table has slots, whatever the data.
    return placed.join(F.broadcast(lookup), "slot").select(key, "slot", "shard")


def write_shards(df: DataFrame, path: str, key: str = "doc_id", **options) -> None:
    """Writes all columns of ``df`` to one folder per shard; large shards become several files."""
    taken = set(df.columns)
    name = next(n for n in ("shard", *(f"shard_{i}" for i in range(len(taken) + 1))) if n not in taken)
    shards, slots = options.get("shards", SHARDS), options.get("slots", SLOTS)
    numbers = F.lit(",".join(map(str, fill_table(shards, slots))))
    shard = F.element_at(F.split(numbers, ",").cast("array<int>"), slot_of(F.col(key), slots).cast("int") + 1)
    df.withColumn(name, shard).hint("rebalance", name).write.partitionBy(name).parquet(path)
