from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabvitals.llm import sharding

NAMES = [f"s{i}" for i in range(10)]


def test_shares_differ_by_one_at_most():
    counts = Counter(sharding.filled(NAMES, 1009))
    assert set(counts) == set(range(10))
    assert max(counts.values()) - min(counts.values()) <= 1


def test_first_turn_takes_first_preferences():
    slots = sharding.filled(["only"], 7)
    assert slots == [0] * 7


def test_most_slots_stay_when_a_shard_goes():
    before = [NAMES[i] for i in sharding.filled(NAMES, 1009)]
    left = NAMES[:-1]
    after = [left[i] for i in sharding.filled(left, 1009)]
    moved = sum(b != a for b, a in zip(before, after, strict=True) if b in left)
    assert moved < 0.25 * len(before)


@pytest.mark.parametrize("names, size", [([], 7), (["a", "a"], 7), (["a", "b"], 8), (NAMES, 7)])
def test_bad_tables(names, size):
    with pytest.raises(ValueError):
        sharding.filled(names, size)


def test_places_all_rows(spark):
    rows = [(None, 1), ("", 2), ("x", 3), ("x", 4), ("y" * 100_000, 5)]
    frame = spark.createDataFrame(rows, "k string, shard int").withColumn("placed_slot", F.lit(9))
    placed = {r["placed_slot"]: r for r in sharding.place(frame, "k", NAMES, 101).collect()}
    rows = sharding.place(frame, "k", NAMES, 101).select("k", "slot", "shard", "shard_name").collect()
    assert len(rows) == 5 and set(placed) == {9}
    slots = sharding.filled(NAMES, 101)
    assert all(r.shard == slots[r.slot] and r.shard_name == NAMES[r.shard] for r in rows)
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k or "", set()).add(r.shard)
    assert all(len(s) == 1 for s in by_key.values())
    assert sharding.place(frame.limit(0), "k", NAMES, 101).count() == 0
