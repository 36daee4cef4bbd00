"""Known counts on the given tables (sf0.01), most with defects put in by key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import tabvitals as tv
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

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def read(spark):
    return lambda name: tv.read_table(spark, f"{FOLDER}/{name}.parquet")


def one(df):
    (row,) = df.collect()
    return row


def violations(df, rule):
    return one(tv.rule_profile(df, [rule])).violations


def _null_if(column, condition):
    return f"IF({condition}, NULL, {column}) AS {column}"


def test_nulls(read):
    df = read("lineitem").selectExpr(
        "l_orderkey",
        _null_if("l_quantity", "l_orderkey % 7 = 0"),
        _null_if("l_returnflag", "l_orderkey % 37 = 0"),
    )
    rows = [tuple(r)[2:] for r in tv.null_profile(df).orderBy("ordinal").collect()]
    assert rows == [(0, 0.0, "ok"), (8704, 14.51, "critical"), (1538, 2.56, "warning")]


def test_duplicates(read):
    events = read("events")
    copies = events.where("event_id % 50 = 0")
    rekeyed = events.where("event_id % 40 = 0").withColumn("event_id", F.col("event_id") + 1000000)
    df = events.unionByName(copies).unionByName(rekeyed)
    row = one(tv.duplicate_profile(df, ["user_id", "ts", "value"]))
    assert (row.full_duplicates, row.key_column_dupes) == (200, 450)


def test_outliers(read):
    df = read("lineitem").selectExpr(
        "IF(l_orderkey % 500 = 0, l_extendedprice * 10, l_extendedprice) AS price"
    )
    row = one(tv.outlier_profile(df))
    assert (row.q1, row.q3) == (26935.5325, 79347.3575)
    assert (row.outliers_low, row.outliers_high) == (0, 113)


def test_rules(read):
    lineitem, orders = read("lineitem"), read("orders")
    negated = lineitem.selectExpr("IF(l_orderkey % 101 = 0, -l_quantity, l_quantity) AS q")
    assert violations(negated, positive("q")) == 588
    assert violations(read("customer"), non_negative("c_acctbal")) == 122
    assert violations(read("part"), in_range("p_size", 1, 40)) == 395
    dated = lineitem.selectExpr(
        "l_shipdate AS a",
        "CASE l_linenumber WHEN 1 THEN l_shipdate - INTERVAL '1' DAY WHEN 2 THEN l_shipdate "
        "ELSE l_shipdate + INTERVAL '7' DAY END AS b",
    )
    assert violations(dated, ordered("a", "b")) == 17173
    after = Rule("after", "a", "a <= b", F.col("a") > F.col("b"))
    assert violations(dated, after) == 8590
    undated = orders.selectExpr(_null_if("o_orderdate", "o_orderkey % 53 = 0"))
    assert violations(undated, expected_year("o_orderdate", 1998)) == 12833
    assert violations(lineitem, zero_with_positive("l_discount", "l_tax")) == 2744


def test_total(read):
    parts = "coalesce(price, 0) + tax + coalesce(discount, 0)"
    df = (
        read("lineitem")
        .selectExpr(
            "l_orderkey AS k",
            "IF(l_orderkey % 13 = 0, NULL, l_extendedprice) AS price",
            "l_tax AS tax",
            "IF(l_orderkey % 17 = 0, NULL, l_discount) AS discount",
        )
        .selectExpr(
            "*", f"IF(k % 307 = 0, NULL, {parts} + IF(k % 211 = 0, 1, 0)) AS total"
        )
    )
    assert violations(df, sum_matches("total", ["price", "tax", "discount"], 0.10)) == 292
    assert df.where("total IS NULL").count() == 201


def test_expectations(read):
    lineitem = read("lineitem").withColumn(
        "l_returnflag", F.expr("IF(l_orderkey % 37 = 0, NULL, l_returnflag)")
    )
    price, flag = tv.validate(
        lineitem,
        [tv.between("l_extendedprice", 1000, 100000), tv.in_set("l_returnflag", ["A", "N"])],
    ).orderBy("ordinal").collect()
    assert (price.violation_count, price.passed) == (2869, False)
    assert (flag.violation_count, flag.violation_pct) == (19560, 33.46)
    tolerated = one(tv.validate(read("part"), [tv.between("p_size", 1, 48, mostly=0.95)]))
    assert (tolerated.passed, tolerated.violation_count) == (True, 0)


def test_statistics(read):
    orders = read("orders")
    rows = {r.column_name: r for r in tv.describe(orders).collect()}
    total = rows["o_totalprice"]
    assert (total["count"], total.min, total.max) == (15000, 1013.7, 499978.59)
    # 251485.485 is shown with 2 decimals, half to even.
    assert (total.p25, total.p50, total.p75) == (125475.5, 251485.48, 374367.44)
    times = one(tv.describe_timestamps(orders))
    assert times.p25 == dt.datetime(1996, 9, 1)


def test_value_counts(read):
    df = read("lineitem").selectExpr(_null_if("l_returnflag", "l_orderkey % 37 = 0"))
    counts = [(r.value, r["count"]) for r in tv.value_counts(df, ["l_returnflag"]).collect()]
    assert counts == [("R", 19560), ("A", 19518), ("N", 19384), (None, 1538)]


def test_nan(read):
    df = read("events").selectExpr("IF(event_id % 100 = 0, DOUBLE('NaN'), value) AS value")
    assert violations(df, Rule("r", "value", "value <= 100", F.col("value") > 100)) == 1304
    assert one(tv.null_profile(df)).null_count == 100


def test_size(read):
    rows = {r.column_name: r for r in tv.column_types(read("lineitem")).collect()}
    assert rows["l_returnflag"].logical_bytes == 60000


def test_same_numbers_as_pandas(read):
    df = read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax")
    pandas = df.toPandas()
    expected = pandas.describe().round(2)
    for row in tv.describe(df).collect():
        column = expected[row.column_name]
        assert [row["count"], row["mean"], row["std"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]] == list(column)
    for row in tv.outlier_profile(df).collect():
        q1, q3 = (pandas[row.column_name].quantile(p) for p in (0.25, 0.75))
        assert (row.q1, row.q3, row.iqr) == tuple(round(float(x), 4) for x in (q1, q3, q3 - q1))
        low = int((pandas[row.column_name] < q1 - 1.5 * (q3 - q1)).sum())
        high = int((pandas[row.column_name] > q3 + 1.5 * (q3 - q1)).sum())
        assert (row.outliers_low, row.outliers_high) == (low, high)
        assert row.outlier_pct == round((low + high) / len(pandas) * 100, 2)
