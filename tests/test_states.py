"""States of parts, merged, are the state of the whole."""

import math
import random

import pytest

import tabvitals as tv
from tabvitals.operators.rules import non_negative, positive


def rows(n, seed):
    rnd = random.Random(seed)
    return [
        (
            rnd.choice([None, math.nan, rnd.gauss(1e9, 3)]),
            rnd.choice([None, rnd.randint(-5, 5)]),
            rnd.choice([None, "", "a", "bcd"]),
            None,
        )
        for _ in range(n)
    ]


SCHEMA = "`odd ``x``` double, i int, s string, none double"


@pytest.fixture
def checks(spark):
    return {
        "rules": [non_negative("i"), positive("no_such_column")],
        "suite": [tv.not_null("s", mostly=0.7), tv.between("i", -3, 3), tv.row_count_between(300)],
    }


def test_merged_parts_are_the_whole(spark, tmp_path, checks):
    path = str(tmp_path / "states")
    parts = [rows(200, 1), rows(1, 2), rows(150, 3), []]
    for k, part in enumerate(parts):
        tv.save_state(spark.createDataFrame(part, SCHEMA), "t", f"part {k}", path, **checks)
    tv.save_state(spark.createDataFrame(rows(9, 9), SCHEMA), "other", "x", path, **checks)
    whole = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    merged = tv.merged_state(spark, "t", path, **checks)
    for mine, expected in (
        (merged.null_profile(), tv.null_profile(whole)),
        (merged.column_types(), tv.column_types(whole)),
        (merged.rule_profile(), tv.rule_profile(whole, checks["rules"])),
        (merged.validate(), tv.validate(whole, checks["suite"])),
        (merged.overview("t").drop("profiled_at"), tv.overview(whole, "t").drop("profiled_at")),
    ):
        assert mine.collect() == expected.collect()
    for a, b in zip(merged.describe().collect(), tv.describe(whole).collect(), strict=True):
        assert (a.column_name, a["count"], a["min"], a["max"]) == (b.column_name, b["count"], b["min"], b["max"])
        for k in ("mean", "std"):
            assert a[k] == b[k] or a[k] == pytest.approx(b[k], abs=0.02)
        if b.p50 is not None:
            assert b.p25 - 3 <= a.p50 <= b.p75 + 3


def test_a_part_saved_again_replaces_its_state(spark, tmp_path):
    path = str(tmp_path / "states")
    for n in (100, 30):
        tv.save_state(spark.createDataFrame(rows(n, n), SCHEMA), "t", "day 1", path)
    tv.save_state(spark.createDataFrame(rows(5, 5), SCHEMA), "t", "day 2", path)
    assert tv.merged_state(spark, "t", path).overview("t").first().row_count == 35


def test_parts_with_other_columns_do_not_merge(spark, tmp_path):
    path = str(tmp_path / "states")
    tv.save_state(spark.range(3), "t", "a", path)
    tv.save_state(spark.range(3).withColumnRenamed("id", "key"), "t", "b", path)
    with pytest.raises(ValueError, match="different columns"):
        tv.merged_state(spark, "t", path)
