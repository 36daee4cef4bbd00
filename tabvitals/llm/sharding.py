"""Placement of keys on shards by a table that permutations fill.

Each shard prefers the slots of a prime-sized table in an order of its own, `offset + j * skip`.
The shards take turns, and each claims the first slot of its order that is still free, until none
is left. All shards get the same number of slots but for one, and when a shard goes, nearly all
slots of the others stay. A key is placed with one hash and one look-up.

The table does not depend on the data: it has as many rows as its size says (65,537 by default,
which a hash relation holds in about 1 MB), so its broadcast is bounded.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabvitals.llm.common import fresh

SIZE = 65_537  # a prime; at least 100 slots a shard keep shares even


def _numbers(shard: str) -> tuple[int, int]:
    digest = hashlib.md5(shard.encode()).hexdigest()
    return int(digest[:15], 16), int(digest[16:31], 16)


def filled(shards: list[str], size: int = SIZE) -> list[int]:
    """For each slot, the position of its shard in the list."""
    if not 0 < len(set(shards)) == len(shards) <= size:
        raise ValueError("shards must be distinct, at least one and no more than slots")
    if size > 10_000_000 or size < 2 or any(size % i == 0 for i in range(2, int(size**0.5) + 1)):
        raise ValueError("the size must be a prime of at most ten million")
    numbers = [_numbers(s) for s in shards]
    nexts = [offset % size for offset, _ in numbers]
    skips = [skip % (size - 1) + 1 for _, skip in numbers]
    slots = [-1] * size
    free = size
    while free:
        for i, skip in enumerate(skips):
            slot = nexts[i]
            while slots[slot] >= 0:
                slot = (slot + skip) % size
            slots[slot] = i
            nexts[i] = (slot + skip) % size
            free -= 1
            if not free:
                break
    return slots


def table(spark: SparkSession, shards: list[str], size: int = SIZE) -> DataFrame:
    """The look-up table: slot, shard (position in the list), shard_name."""
    slots = ",".join(map(str, filled(shards, size)))
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(slots), ",")).alias("slot", "shard"))
    names = F.array(*[F.lit(s) for s in shards])
    shard = F.col("shard").cast("int")
    return rows.select("slot", shard.alias("shard"), names[shard].alias("shard_name"))


def slot_of(key: F.Column, size: int = SIZE) -> F.Column:
    """The slot of a key: 60 bits of its MD5, modulo the size. A null key counts as ''."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(size)).cast("int")


def place(frame: DataFrame, key: str, shards: list[str], size: int = SIZE) -> DataFrame:
    """The frame with the columns slot, shard and shard_name.

    Rows with equal keys get the same shard, repeated rows stay repeated, rows without a key are
    placed like rows with an empty key, and an empty frame stays empty. Columns of the frame that
    have one of the three names are replaced.
    """
    kept = frame.drop("slot", "shard", "shard_name")
    slot = fresh(kept, "placed_slot")
    looked_up = F.broadcast(table(frame.sparkSession, shards, size)).withColumnRenamed("slot", slot)
    placed = kept.withColumn(slot, slot_of(F.col(f"`{key}`"), size)).join(looked_up, slot, "left")
    columns = [F.col(f"`{c}`") for c in kept.columns]
    return placed.select(*columns, F.col(slot).alias("slot"), "shard", "shard_name")
