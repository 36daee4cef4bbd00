"""Small tables with known results, one per trap of missing values, ties and empty input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import tabvitals as tv
from tabvitals.functions import grading
from tabvitals.operators import duplicates, measure
from tabvitals.operators.rules import (
    Rule,
    expected_year,
    in_range,
    non_negative,
    ordered,
    positive,
    sum_matches,
    zero_with_positive,
)
from tabvitals.presets import taxi

NAN = float("nan")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def by(df, key):
    return {r[key]: r for r in df.collect()}


# Missing values


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (NAN,), (None,)], "x double")
    assert one(tv.null_profile(df)).null_count == 2
    rule = Rule("r", "x", "x <= 1", F.col("x") > 1)
    assert one(tv.rule_profile(df, [rule])).violations == 1
    assert one(tv.outlier_profile(df)).actual_max == 2.0
    assert one(tv.describe(df)).count == 2 or one(tv.describe(df))["count"] == 2
    assert one(tv.validate(df, [tv.between("x", 0, 5)])).passed
    assert one(tv.validate(df, [tv.not_null("x")])).violation_pct == 50.0


def test_missing_timestamp_violates_the_expected_year(spark):
    times = [None, dt.datetime(2024, 1, 2), dt.datetime(2023, 12, 31)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert one(tv.rule_profile(df, [expected_year("t", 2024)])).violations == 2


def test_missing_values_are_equal_in_duplicates(spark):
    rows = [(1, None), (1, None), (2, NAN), (2, NAN), (2, None), (3, 0.0), (3, -0.0)]
    df = spark.createDataFrame(rows, "a int, b double")
    profile = one(tv.duplicate_profile(df, ["a", "b"]))
    assert (profile.full_duplicates, profile.key_column_dupes) == (4, 4)
    assert profile.severity == "critical"


def test_null_counts_however_rare(spark):
    df = spark.range(100_000).select(F.when(F.col("id") > 0, F.col("id")).alias("x"))
    profile = tv.null_profile(df)
    row = one(profile)
    assert (row.null_count, row.null_pct, row.severity) == (1, 0.0, "ok")
    summary = one(tv.null_summary(profile))
    assert (summary.columns_with_nulls, summary.columns_critical) == (1, 0)


# Rounding and levels


def test_share_is_rounded_half_to_even(spark):
    df = spark.range(800).select(F.when(F.col("id") > 0, F.col("id")).alias("x"))
    assert one(tv.null_profile(df)).null_pct == 0.12


@pytest.mark.parametrize(
    "share, levels, expected",
    [
        (0.0, grading.NULL_LEVELS, "ok"),
        (4.99, grading.NULL_LEVELS, "warning"),
        (5.0, grading.NULL_LEVELS, "critical"),
        (20.0, grading.NULL_LEVELS, "severe"),
        (0.99, grading.OUTLIER_LEVELS, "warning"),
        (1.0, grading.OUTLIER_LEVELS, "critical"),
        (5.0, grading.OUTLIER_LEVELS, "severe"),
        (None, grading.OUTLIER_LEVELS, None),
    ],
)
def test_levels(spark, share, levels, expected):
    df = spark.createDataFrame([(share,)], "x double")
    assert df.select(grading.level(F.col("x"), levels)).first()[0] == expected


def test_grades(spark):
    scores = [90.0, 89.9, 75.0, 60.0, 59.9, None]
    df = spark.createDataFrame([(s,) for s in scores], "x double")
    grades = [r[0] for r in df.select(grading.grade(F.col("x"))).collect()]
    assert grades == ["A", "B", "B", "C", "D", None]


def test_two_percent_of_repeated_keys_is_critical(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 3, 0).otherwise(F.col("id")).alias("k"))
    row = one(tv.duplicate_profile(df, ["k"]))
    assert (row.full_duplicates, row.key_dupe_pct, row.severity) == (0, 2.0, "critical")
    df = df.where("id <> 2")
    assert one(tv.duplicate_profile(df, ["k"])).severity == "warning"
    assert one(tv.duplicate_profile(df, ["id"])).severity == "ok"


# Rules


def test_total_within_tolerance(spark):
    rows = [(1.0, 1.1), (10.0, 10.1), (5.5, 5.6), (20.3, 20.4), (3.0, 3.2), (3.0, None)]
    for total, part in rows:
        df = spark.createDataFrame([(total, part, None)], "part double, total double, other double")
        row = one(tv.rule_profile(df, [sum_matches("total", ["part", "other"], 0.10)]))
        assert row.violations == ((total, part) in [(1.0, 1.1), (3.0, 3.2)])


def test_rules_need_their_columns_spelt_exactly(spark):
    columns = [*taxi.AMOUNT_PARTS[:-1], "airport_fee", "total_amount"]
    df = spark.createDataFrame([tuple(1.0 for _ in columns)], columns)
    names = [r.rule_name for r in tv.rule_profile(df, taxi.rules()).collect()]
    assert names == ["fare_amount_must_be_positive"]


def test_rule_kinds(spark):
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [(0.0, 1.0, early, late), (-1.0, 0.0, late, late), (7.0, 2.0, late, early), (None,) * 4],
        "a double, b double, s timestamp_ntz, t timestamp_ntz",
    )
    rules = [
        positive("a"),
        non_negative("a"),
        in_range("a", 1, 6, on_fail="warning"),
        ordered("s", "t"),
        zero_with_positive("a", "b"),
        Rule("after", "s", "s <= t", F.col("s") > F.col("t"), requires=("s", "t")),
    ]
    profile = tv.rule_profile(df, rules)
    assert [r.violations for r in profile.orderBy("ordinal").collect()] == [2, 1, 3, 2, 1, 1]
    summary = one(tv.rule_summary(profile))
    assert (summary.rules_checked, summary.rules_failed, summary.total_violations) == (6, 6, 10)


# Empty input


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, b double, c string")
    nulls, rules = tv.null_profile(df), tv.rule_profile(df, [positive("a")])
    assert {(r.null_count, r.null_pct, r.severity) for r in nulls.collect()} == {(0, None, None)}
    assert one(rules).severity is None and one(rules).violation_pct is None
    assert tuple(one(tv.health_score(nulls, rules))) == (None,) * 4
    duplicate = one(tv.duplicate_profile(df, ["a"]))
    assert (duplicate.full_duplicates, duplicate.full_duplicate_pct, duplicate.severity) == (0, None, None)
    outliers = by(tv.outlier_profile(df), "column_name")
    assert outliers["b"].q1 is None and outliers["b"].severity is None
    assert one(tv.overview(df)).row_count == 0
    assert by(tv.describe(df), "column_name")["a"]["count"] == 0
    assert one(tv.validate(df, [tv.not_null("a")])).passed
    assert tv.value_counts(df, ["c"]).count() == 0


def test_column_without_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a double, b int")
    row = by(tv.outlier_profile(df), "column_name")["a"]
    assert (row.q1, row.total_outliers, row.outlier_pct, row.severity) == (None, 0, None, None)
    assert one(tv.validate(df, [tv.between("a", 1, 2)])).passed
    assert one(tv.describe_timestamps(spark.createDataFrame([(None,)], "t timestamp_ntz"))).p50 is None


def test_no_rules_score_full_marks(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    score = one(tv.health_score(tv.null_profile(df), tv.rule_profile(df, [])))
    assert (score.rule_score, score.null_score, score.score, score.grade) == (100.0, 50.0, 80.0, "B")
    assert one(tv.outlier_summary(tv.outlier_profile(df, []))).columns_checked == 0


# Expectations


def test_mostly_hides_what_it_tolerates(spark):
    df = spark.range(100).withColumn("x", F.when(F.col("id") < 4, 99).otherwise(1))
    tolerant, strict = tv.validate(
        df, [tv.between("x", 0, 5, mostly=0.95), tv.between("x", 0, 5)]
    ).orderBy("ordinal").collect()
    assert (tolerant.passed, tolerant.violation_count, tolerant.violation_pct) == (True, 0, 0.0)
    assert (strict.passed, strict.violation_count, strict.violation_pct) == (False, 4, 4.0)


def test_failed_table_expectation_has_no_count(spark):
    df = spark.range(10)
    suite = [
        tv.row_count_between(11),
        tv.row_count_between(max_value=10),
        tv.column_count_equals(2),
        tv.columns_match_set(["id", "x"], exact_match=False),
        tv.columns_match_set(["id"]),
        tv.in_set("x", [1]),
    ]
    rows = tv.validate(df, suite).orderBy("ordinal").collect()
    assert [r.passed for r in rows] == [False, True, False, False, True, False]
    assert {(r.violation_count, r.violation_pct) for r in rows} == {(0, 0.0)}
    assert [r.reason for r in rows] == [None] * 5 + ["column not found"]
    assert rows[0].column == "table-level" and rows[0].group == "general"
    summary = one(tv.validation_summary(tv.validate(df, suite)))
    assert (summary.total, summary.passed, summary.failed, summary.success_pct) == (6, 2, 4, 33.3)


def test_null_is_not_outside_a_set(spark):
    df = spark.createDataFrame([("Y",), (None,), ("X",)], "f string")
    row = one(tv.validate(df, [tv.in_set("f", ["Y", "N"])]))
    assert (row.violation_count, row.violation_pct) == (1, 50.0)


# Wide tables, odd names, nested types


def test_slices_give_the_same_row(spark, monkeypatch):
    names = [f"c {i}.`x`" for i in range(70)]
    df = spark.range(50).select(
        *[F.when(F.col("id") % (i + 2) > 0, F.col("id")).alias(n) for i, n in enumerate(names)]
    )
    sliced = tv.null_profile(df).orderBy("ordinal").collect()
    monkeypatch.setattr(measure.measure, "__defaults__", (10_000,))
    assert tv.null_profile(df).orderBy("ordinal").collect() == sliced
    assert [r.column_name for r in sliced] == names
    assert [r.null_count for r in sliced[:3]] == [25, 17, 13]


def test_nested_sizes_and_duplicates(spark):
    df = spark.range(3).selectExpr(
        "named_struct('a', 1, 'b', 'xyz') AS s",
        "array('a', 'bc', NULL) AS t",
        "map('k', 2L) AS m",
        "CAST(1.5 AS DECIMAL(10,2)) AS d",
        "true AS f",
    )
    sizes = {k: r.logical_bytes for k, r in by(tv.column_types(df), "column_name").items()}
    assert sizes == {"s": 21, "t": 9, "m": 27, "d": 24, "f": 3}
    assert one(tv.duplicate_profile(df, [])).full_duplicates == 2
    assert one(tv.duplicate_profile(df, [])).key_column_dupes == 0


def test_variant_rows_can_repeat(spark):
    df = spark.range(4).selectExpr("""parse_json('{"a": 1}') AS v""")
    assert one(tv.duplicate_profile(df, ["missing"])).full_duplicates == 3


@pytest.mark.parametrize(
    "rows, different",
    [
        ("(1, NULL), (NULL, 1), (1, 1), (NULL, NULL)", 4),
        ("(array(1, NULL), 1), (array(NULL, 1), 1), (array(1), 1), (array(), 1), (NULL, 1)", 5),
        ("(array(array(1), array(2)), 1), (array(array(1, 2)), 1), (array(array(1, 2), array()), 1)", 3),
        ("(struct(1, CAST(NULL AS INT)), 1), (struct(NULL, 1), 1), (NULL, 1)", 3),
        ("(CAST('-0.0' AS DOUBLE), 1), (0D, 1)", 1),
        ("(array(CAST('NaN' AS DOUBLE)), 1), (array(CAST('NaN' AS DOUBLE)), 1), (array(0D), 1), "
         "(array(CAST('-0.0' AS DOUBLE)), 1)", 2),
        ("(map('a', 1, 'b', 2), 1), (map('b', 2, 'a', 1), 1), (map('a', 2, 'b', 1), 1)", 2),
        ("(map('a', NULL), 1), (map('b', NULL), 1), (map(), 1), (NULL, 1)", 4),
        ("(parse_json('{\"a\": 1}'), 1), (parse_json('{\"a\": 1}'), 1), (parse_json('null'), 1)", 2),
        ("(struct(array(map(1, 'x'))), 1), (struct(array(map(1, 'x'))), 1), (struct(array(map(2, 'x'))), 1)", 2),
    ],
)
def test_what_makes_rows_equal(spark, rows, different):
    df = spark.sql(f"SELECT * FROM VALUES {rows} AS t(a, b)")
    assert one(tv.duplicate_profile(df, [])).full_duplicates == df.count() - different


def test_keys_that_do_not_exist(spark):
    df = spark.range(5).selectExpr("1 AS a", """parse_json('{"a": 1}') AS v""")
    assert [one(tv.key_duplicates(df, k)).key_column_dupes for k in ([], ["x"], ["a", "x"], ["v"])] == [0, 0, 4, 4]
    assert one(tv.key_duplicates(df.limit(0), ["a"])).key_column_dupes == 0


def test_infinite_quartiles_have_no_outliers(spark):
    df = spark.sql("SELECT * FROM VALUES (DOUBLE('inf')), (DOUBLE('inf')), (DOUBLE('inf')), (1D) AS t(a)")
    row = one(tv.outlier_profile(df, ["a"]))
    assert (row.iqr, row.lower_fence, row.total_outliers, row.severity) == (None, None, 0, "ok")


def test_zeros_are_one_value(spark):
    df = spark.sql("SELECT * FROM VALUES (-0D), (0D), (double('-0.0')), (NULL) AS t(a)")
    rows = {r.value: r["count"] for r in tv.value_counts(df, ["a"]).collect()}
    assert rows == {"0.0": 3, None: 1}


def test_none_in_a_set_says_nothing(spark):
    df = spark.sql("SELECT * FROM VALUES (0), (1), (2), (NULL) AS t(k)")
    for values in ([0], [0, None]):
        assert one(tv.validate(df, [tv.in_set("k", values)])).violation_count == 2


def test_rules_without_requires_on_other_tables(spark):
    df = spark.range(3).selectExpr("id AS a")
    rules = [Rule("x", "x", "x > 0", F.col("x") <= 0), Rule("a", "a", "a > 0", F.col("a") <= 0)]
    assert [r.rule_name for r in tv.rule_profile(df, rules).collect()] == ["a"]


def test_hot_duplicates(spark):
    """A third of the rows are copies of one."""
    df = spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 0, id) AS a", "IF(id % 3 = 0, 'x', CAST(id % 100 AS STRING)) AS fingerprint"
    )
    df = df.unionByName(df.where("a BETWEEN 1 AND 50"))
    row = one(tv.duplicate_profile(df, ["fingerprint"]))
    pandas = df.toPandas()
    assert row.full_duplicates == pandas.duplicated().sum()
    assert row.key_column_dupes == pandas.duplicated(subset=["fingerprint"]).sum()


def test_automatic_columns(spark):
    df = spark.range(1).selectExpr(
        "1 AS i", "1L AS l", "1D AS d", "1F AS f", "1S AS s", "1.0 AS dec", "true AS b", "'x' AS t"
    )
    assert tv.numeric_columns(df) == ["i", "l", "d", "dec"]
    described = [r.column_name for r in tv.describe(df).orderBy("ordinal").collect()]
    assert described == ["i", "l", "d", "f", "s", "dec"]


def test_timestamps_with_zone(spark):
    times = [dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 4)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").selectExpr(
        "t", "CAST(t AS TIMESTAMP) AS z"
    )
    for row in tv.describe_timestamps(df).collect():
        assert row["mean"] == row.p50 == dt.datetime(2024, 1, 1, 0, 0, 0, 2)
        assert (row.min, row.max) == tuple(times)


def test_clock_times_do_not_depend_on_the_zone_of_the_session(spark):
    clock = [dt.datetime(2024, 3, 10, hour, 30) for hour in (0, 1, 2, 3, 4)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(t,) for t in clock], "t timestamp_ntz")
        row = one(tv.describe_timestamps(df))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row["mean"], row.p25, row.p50, row.max) == (clock[2], clock[1], clock[2], clock[4])


def test_value_counts_show_missing_values(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("b", 2), ("b", 1)], "s string, n int")
    counts = [tuple(r) for r in tv.value_counts(df, ["s", "missing", "n"]).collect()]
    assert counts == [("s", "b", 2), ("s", "a", 1), ("s", None, 1), ("n", "1", 3), ("n", "2", 1)]
    assert tv.value_counts(df, ["missing"]).count() == 0


def test_duplicates_take_one_scan_and_one_data_exchange(spark, capsys):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    duplicates.duplicate_measures(df, ["user_id", "event_type"]).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange SinglePartition") == 1


def test_equal_parts_in_other_columns_are_no_duplicates(spark):
    rows = [(1, None, "a"), (None, 1, "a"), (1, None, None), (1, None, None), (None, None, "a")]
    df = spark.createDataFrame(rows, "x int, y int, z string")
    row = one(tv.duplicate_profile(df, ["x", "y"]))
    assert (row.full_duplicates, row.key_column_dupes) == (1, 2)
    assert one(tv.duplicate_profile(df.limit(0), ["x"])).full_duplicates == 0
