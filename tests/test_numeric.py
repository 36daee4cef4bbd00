import math
import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabvitals.functions import numeric, text
from tabvitals.operators import outliers, quantiles
from tabvitals.operators.measure import measure


def test_round_columns_rounds_as_python(spark):
    generator = random.Random(7)
    values = [0.125, 0.375, 2.675, 1.005, -0.125, 0.145, 1e15 + 0.3, 0.0, 1e300, None]
    values += [k / n * 100 for n in (7, 800, 1600, 999, 2_964_624) for k in range(1, 400)]
    values += [generator.uniform(-1e6, 1e6) for _ in range(2000)]
    values += [generator.randrange(10**6) / 200 for _ in range(2000)]
    for digits in (1, 2, 4):
        frame = spark.createDataFrame(
            [(i, v) for i, v in enumerate(values)], "i int, x double"
        ).repartition(2)
        rows = numeric.round_columns(frame, {"x": digits}).collect()
        actual = {r.i: r.x for r in rows}
        expected = {i: None if v is None else round(v, digits) for i, v in enumerate(values)}
        assert actual == expected


def test_rounded_scaled_rounds_as_numpy(spark):
    values = [0.125, 0.375, 2.675, 1.005, 0.145, -3.5, 12345.678]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    rows = frame.selectExpr(f"{numeric.rounded_scaled('x', 2)} AS x").collect()
    assert [r.x for r in rows] == list(np.round(values, 2))


def test_number_text_is_plain(spark):
    values = [14.51, 0.0, 100.0, 12345678.25, 0.0001, -1234567890.5, 99.9]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    rows = frame.selectExpr(f"{text.number_text('x')} AS x").collect()
    assert [r.x for r in rows] == [str(v) for v in values]


def test_literal_survives_quotes_and_backslashes(spark):
    value = "it's a \\ \"test\" `x` ±$0.10"
    assert spark.range(1).selectExpr(f"{text.literal(value)} AS x").first().x == value


def test_strip_takes_every_white_space(spark):
    value = "　\n\t x y \x1c \r\n"
    frame = spark.createDataFrame([(value,)], "x string").select(text.strip(F.col("x")))
    assert frame.first()[0] == value.strip()


def _columns(seed):
    random_numbers = np.random.default_rng(seed)
    n = 500
    columns = {
        "uniform": random_numbers.uniform(-5, 5, n),
        "hot": np.where(random_numbers.random(n) < 0.4, 3.25, random_numbers.normal(0, 1e6, n)),
        "hot_zero": np.where(random_numbers.random(n) < 0.6, 0.0, random_numbers.normal(0, 1, n)),
        "tiny": random_numbers.uniform(-1, 1, n) * 5e-320,
        "wide": random_numbers.choice([-1, 1], n) * 10 ** random_numbers.uniform(-300, 300, n),
        "close": 1 + random_numbers.integers(0, 50, n) * 2.0**-52,
        "whole": random_numbers.integers(-40, 40, n).astype(float),
        "constant": np.full(n, -7.5),
        "infinite": np.where(random_numbers.random(n) < 0.3, np.inf, random_numbers.normal(0, 1, n)),
        "prices": np.round(random_numbers.uniform(900, 105000, n), 2),
        "signed_zero": random_numbers.choice([0.0, -0.0, 1.0], n),
        "missing": np.where(random_numbers.random(n) < 0.9, np.nan, random_numbers.normal(0, 1, n)),
        "none": np.full(n, np.nan),
        "one": np.where(np.arange(n) == 3, 42.0, np.nan),
        "two": np.where(np.arange(n) < 2, np.arange(n) + 0.5, np.nan),
        "max": random_numbers.choice([1.7e308, 1.6e308, -1.7e308], n),
        "odd `name`": random_numbers.normal(0, 1, n),
    }
    return pd.DataFrame(columns)


@pytest.mark.parametrize("bins", [65_536, 20, 2])
def test_exact_quantiles_equal_sorting(spark, monkeypatch, bins):
    """Also when values are hardly ever few enough to be told apart one by one."""
    monkeypatch.setattr(quantiles, "_BINS", bins)
    monkeypatch.setattr(quantiles, "_SHARE", quantiles._SHARE.replace("65536", str(bins)).replace("65535", str(bins - 1)))
    frame = _columns(bins)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = spark.createDataFrame(frame).repartition(3)
    actual = quantiles.exact_quantiles(df, list(frame.columns), probabilities)
    for name in frame.columns:
        values = frame[name].dropna()
        if values.empty:
            assert actual[name] == [None] * len(probabilities)
            continue
        with np.errstate(all="ignore"):
            expected = [values.quantile(p) for p in probabilities]
        for e, a in zip(expected, actual[name]):
            assert a == e or (math.isnan(e) and name in ("infinite", "max")), (name, e, a)


def test_quantiles_of_many_computed_columns(spark):
    """Planning must not take long, however many columns there are."""
    names = [f"c{i}" for i in range(40)]
    df = spark.range(1000).selectExpr(*[f"id * {i + 1} AS c{i}" for i in range(40)])
    expected = {n: [249.75 * (i + 1), 499.5 * (i + 1)] for i, n in enumerate(names)}
    assert quantiles.exact_quantiles(df, names, [0.25, 0.5]) == expected


def test_quantiles_of_whole_numbers(spark):
    df = spark.range(101).selectExpr("CAST(id AS INT) AS a", "id * 1000 AS b")
    assert quantiles.exact_quantiles(df, ["a", "b"], [0.25, 0.5]) == {
        "a": [25.0, 50.0],
        "b": [25000.0, 50000.0],
    }


def _exact_columns(n: int):
    """Whole numbers and decimals that doubles cannot tell apart, in any order, with NULLs."""
    rnd = random.Random(n)
    wide = [rnd.randrange(-(2**63), 2**63) for _ in range(n)]
    ends = [2**63 - 1, -(2**63)] * (n // 2)
    keys = [2**53 + i // 2 for i in rnd.sample(range(n), n)]
    money = [Decimal(rnd.randint(-(10**6), 10**6)).scaleb(-2) for _ in range(n)]
    large = [Decimal(10**37 + rnd.randint(0, 30)).scaleb(-6) for _ in range(n)]
    outer = [Decimal(rnd.choice([-1, 1]) * (10**38 - 1 - rnd.randint(0, 5))) for _ in range(n)]
    none = [None] * n
    columns = [wide, ends, keys, money, large, outer, none]
    rows = [[None if rnd.random() < 0.1 else v for v in row] for row in zip(*columns, strict=True)]
    types = ["bigint", "bigint", "bigint", "decimal(12,2)", "decimal(38,6)", "decimal(38,0)", "bigint"]
    names = ["wide", "ends", "keys", "money", "large", "outer", "none"]
    return rows, ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))


@pytest.mark.parametrize("bins", [65_536, 20, 2])
def test_quantiles_that_doubles_cannot_hold(spark, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "_BINS", bins)
    monkeypatch.setattr(quantiles, "_SHARE", quantiles._SHARE.replace("65536", str(bins)).replace("65535", str(bins - 1)))
    rows, schema = _exact_columns(400 if bins > 2 else 60)
    df = spark.createDataFrame(rows, schema).repartition(3)
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = quantiles.quantiles_between(df, df.columns, probabilities)
    for i, name in enumerate(df.columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        assert found[name][0] == len(values)
        for p, q in zip(probabilities, found[name][1], strict=True):
            if not values:
                assert q is None
                continue
            at = (len(values) - 1) * Fraction(p)
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert (q.low, q.high) == (low, high), (name, p)
            assert q.value == Fraction(low) + (Fraction(high) - Fraction(low)) * (at - math.floor(at))


def test_fences_of_exact_kinds(spark):
    """Values one apart from a fence, where doubles are two or more apart."""
    base = 2**60
    values = [base + i for i in range(101)]  # quartiles 25 and 75, fences -50 and 150
    beyond = [base - 51, base - 50, base + 150, base + 151]
    quartered = [base - 1000] + values + [base + 1000]
    df = spark.createDataFrame([(v, Decimal(v).scaleb(-3)) for v in values], "w bigint, d decimal(30,3)")
    limits = outliers.fences(df, ["w", "d"])
    more = spark.createDataFrame([(v, Decimal(v).scaleb(-3)) for v in beyond], "w bigint, d decimal(30,3)")
    row = measure(more, outliers.outlier_aggregates(more, limits)).first()
    assert [row.low_0, row.high_0, row.low_1, row.high_1] == [1, 1, 1, 1]
    whole = spark.createDataFrame([(v,) for v in quartered], "w bigint")
    assert [(r.outliers_low, r.outliers_high) for r in outliers.outlier_profile(whole).collect()] == [(1, 1)]


def test_fences_outside_of_a_type(spark):
    ends = [-(2**63)] * 30 + [0] + [2**63 - 1] * 30
    df = spark.createDataFrame([(v, Decimal(v)) for v in ends], "w bigint, d decimal(19,0)")
    assert [(r.outliers_low, r.outliers_high) for r in outliers.outlier_profile(df).collect()] == [(0, 0)] * 2


def test_approximate_quantiles(spark):
    df = spark.range(200_000).selectExpr("id AS a", "CAST(id % 1000 AS DECIMAL(10,2)) AS b", "CAST('NaN' AS DOUBLE) AS c")
    found = quantiles.approximate_quantiles(df, ["a", "b", "c"], [0.25, 0.5])
    assert found["c"] == [None, None]
    for p, a, b in zip([0.25, 0.5], found["a"], found["b"], strict=True):
        assert abs(a / 200_000 - p) < 0.002 and abs(b / 1000 - p) < 0.003


def test_quantile_profile(spark):
    df = spark.createDataFrame([(2**53 + 1, None), (2**53 + 2, None)], "k bigint, n double")
    rows = quantiles.quantile_profile(df, ["k", "n"], [0.5]).collect()
    assert [(r.column_name, r["count"], r.lower_value, r.upper_value, r.value) for r in rows] == [
        ("k", 2, "9007199254740993", "9007199254740994", 9007199254740994.0),
        ("n", 0, None, None, None),
    ]
    assert quantiles.quantile_profile(df, []).count() == 0


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    """With a margin far below the sketch's error, the first brackets miss; the answer is the same."""
    monkeypatch.setattr(quantiles, "ERROR", 1e-9)
    monkeypatch.setattr(quantiles, "_K", 8)
    df = spark.range(100_001).selectExpr("CAST(pmod(id * 7919, 100001) AS DOUBLE) AS v")
    assert quantiles.exact_quantiles(df, ["v"], [0.25, 0.5]) == {"v": [25_000.0, 50_000.0]}
