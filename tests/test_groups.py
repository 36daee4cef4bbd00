"""Profiles by group are the profiles of the groups as tables of their own."""

import math
import random

import pytest
from pyspark.sql import functions as F

import tabvitals as tv
from tabvitals.operators import grouped, quantiles
from tabvitals.operators.rules import non_negative


def frame(spark, n=3000, hot=0.4):
    rnd = random.Random(5)
    rows = []
    for _ in range(n):
        group = "hot" if rnd.random() < hot else rnd.choice([None, "", "a", "b", "empty"])
        x = None if group == "empty" else rnd.choice([rnd.gauss(0, 1), math.nan, None, 0.0, -0.0, 50 * rnd.random()])
        y = rnd.choice([math.inf, -math.inf]) if group == "a" else float(rnd.randint(0, 9))
        rows.append((group, rnd.randint(0, 1), x, y, rnd.randint(-5, 2**40)))
    return spark.createDataFrame(rows, "`odd ``g``` string, side int, x double, y double, z bigint").repartition(5)


G = "odd `g`"
BY = [G, "side"]


def same_by_group(df, whole, by_group):
    """The rows by group are those of each group alone, in the same order."""
    rows = {}
    for row in by_group.orderBy("ordinal").collect():
        rows.setdefault((row[G], row["side"]), []).append(tuple(row)[2:])
    groups = df.select("`odd ``g```", "side").distinct().collect()
    assert set(rows) == {tuple(g) for g in groups}
    for g, s in groups:
        alone = df.where(F.col("`odd ``g```").eqNullSafe(F.lit(g)) & (F.col("side") == s))
        assert rows[g, s] == [tuple(r) for r in whole(alone.drop("odd `g`", "side")).collect()], (g, s)


def test_nulls_rules_and_expectations(spark):
    df = frame(spark)
    rules = [non_negative("x"), non_negative("z")]
    suite = [tv.not_null("x", mostly=0.5), tv.between("z", 0, mostly=0.9), tv.row_count_between(300)]
    same_by_group(df, tv.null_profile, tv.null_profile(df, by=BY))
    same_by_group(df, lambda d: tv.rule_profile(d, rules), tv.rule_profile(df, rules, by=BY))
    same_by_group(df, lambda d: tv.validate(d, suite), tv.validate(df, suite, by=BY))


@pytest.mark.parametrize("error", [grouped.ERROR, 1e-9])
def test_outliers(spark, monkeypatch, error):
    """Also when brackets miss, which are then widened to all numbers."""
    monkeypatch.setattr(grouped, "ERROR", error)
    if error < quantiles.ERROR:
        monkeypatch.setattr(quantiles, "_K", 8)
    df = frame(spark)
    columns = ["x", "y", "z"]
    same_by_group(df, lambda d: tv.outlier_profile(d, columns), tv.outlier_profile(df, columns, by=BY))


def test_summaries(spark):
    df = frame(spark)
    rules = [non_negative("x"), non_negative("z")]
    nulls, checked = tv.null_profile(df, by=BY), tv.rule_profile(df, rules, by=BY)
    groups = df.select("`odd ``g```", "side").distinct().count()
    for summary in (
        tv.null_summary(nulls, by=BY),
        tv.rule_summary(checked, by=BY),
        tv.health_score(nulls, checked, by=BY),
        tv.validation_summary(tv.validate(df, [tv.not_null("x")], by=BY), by=BY),
    ):
        assert summary.columns[:2] == BY and summary.count() == groups
    assert tv.rule_profile(df, [], by=BY).columns[:2] == BY


def test_empty_table_has_no_groups(spark):
    df = frame(spark, 10).limit(0)
    assert tv.null_profile(df, by=BY).count() == 0
    assert tv.outlier_profile(df, ["x"], by=BY).count() == 0


def test_many_columns_by_group(spark):
    """More aggregates than one scan takes."""
    df = spark.range(300).selectExpr("id % 3 AS g", *[f"IF(id < {i}, NULL, id) AS c{i}" for i in range(150)])
    rows = tv.null_profile(df, by=["g"]).collect()
    assert len(rows) == 3 * 150
    assert {(r.g, r.column_name): r.null_count for r in rows} == {
        (g, f"c{i}"): len(range(g, i, 3)) for g in range(3) for i in range(150)
    }


def test_names_that_clash(spark):
    df = spark.range(3).withColumn("severity", F.lit("x"))
    with pytest.raises(ValueError, match="severity"):
        tv.null_profile(df, by=["severity"])


def test_rows_are_not_shuffled_to_the_brackets_of_their_group(spark, tmp_path, monkeypatch):
    """Not either if the sketches are larger than what Spark broadcasts."""
    joined, limit = [], "spark.sql.autoBroadcastJoinThreshold"
    written, before = grouped.written, spark.conf.get(limit)

    def seen(rows, name):
        if name == "ranks":
            joined.append(rows._jdf.queryExecution().sparkPlan().toString())
        return written(rows, name)

    monkeypatch.setattr(grouped, "written", seen)
    spark.conf.set(limit, "64k")
    try:
        df = spark.range(0, 40_000, 1, 8).selectExpr("id % 2 AS g", "hash(id) * 1D AS x")
        # Read from a table, whose size is no estimate.
        df.write.parquet(f"{tmp_path}/t")
        rows = tv.outlier_profile(spark.read.parquet(f"{tmp_path}/t"), ["x"], by=["g"]).collect()
    finally:
        spark.conf.set(limit, before)
    assert [r.column_name for r in rows] == ["x", "x"]
    assert "BroadcastHashJoin" in joined[0] and "SortMergeJoin" not in joined[0]
