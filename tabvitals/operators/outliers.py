"""Outliers by the interquartile-range method."""

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.functions.grading import OUTLIER_LEVELS, is_serious, level
from tabvitals.functions.numeric import (
    column,
    normalise,
    number,
    percent,
    quoted,
    round_columns,
)
from tabvitals.functions.text import literal
from tabvitals.operators.grouped import measured_by
from tabvitals.operators.measure import Aggregates, measure, row_count, to_rows, unambiguous
from tabvitals.operators.overview import numeric_columns
from tabvitals.operators.quantiles import Family, Value, exact_quantiles, family_of

# Fixed value: the fences lie this many interquartile ranges outside the quartiles.
FENCE_FACTOR = 1.5

_LIMITS = ("q1", "q3", "iqr", "lower_fence", "upper_fence")
_SCHEMA = (
    "column_name string, q1 double, q3 double, iqr double, lower_fence double, "
    "upper_fence double, outliers_low bigint, outliers_high bigint, valid bigint, "
    "actual_min double, actual_max double"
)


@dataclass(frozen=True)
class Fences:
    """Quartiles, their range and the fences of a column, and which values lie outside (SQL)."""

    shown: dict[str, float | None]
    below: str
    above: str


def _fences(name: str, family: Family, q1: Value | None, q3: Value | None) -> Fences:
    if q1 is None:
        return Fences(dict.fromkeys(_LIMITS), "FALSE", "FALSE")
    iqr = q3 - q1
    if isinstance(iqr, float) and math.isnan(iqr):
        # Infinite quartiles have no range. Like any missing number, the fences are then NULL, and
        # no value lies outside them.
        limits = [q1, q3, None, None, None]
        return Fences(dict(zip(_LIMITS, limits, strict=True)), "FALSE", "FALSE")
    factor = FENCE_FACTOR if isinstance(iqr, float) else Fraction(FENCE_FACTOR)
    limits = [q1, q3, iqr, q1 - factor * iqr, q3 + factor * iqr]
    value = f"CAST({quoted(name)} AS {family.sql_type})"

    def outside(limit: Value, sign: int) -> str:
        # Whole numbers and decimals are compared with the nearest of their kind inside the fence.
        inner = family.within(limit, sign)
        if inner is None:
            return f"{quoted(name)} IS NOT NULL"
        return f"{value} {'>' if sign > 0 else '<'} {family.literal(inner)}"

    shown = {k: None if math.isnan(v) else float(v) for k, v in zip(_LIMITS, limits, strict=True)}
    ends = limits[3:]
    if any(math.isnan(v) for v in ends):
        return Fences(shown, "FALSE", "FALSE")
    return Fences(shown, outside(ends[0], -1), outside(ends[1], 1))


def fences(df: DataFrame, columns: list[str]) -> dict[str, Fences]:
    """The fences of each column, unrounded."""
    return {
        name: _fences(name, family_of(df, name), q1, q3)
        for name, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items()
    }


def outlier_aggregates(df: DataFrame, limits: dict[str, Fences]) -> Aggregates:
    result = {}
    for i, (name, limit) in enumerate(limits.items()):
        value, place = f"CAST({quoted(name)} AS DOUBLE)", df.columns.index(name)
        aggregates = {
            "low": f"count_if({limit.below})",
            "high": f"count_if({limit.above})",
            "valid": f"count({quoted(name)})",
            "min": f"min({value})",
            "max": f"max({value})",
        }
        result |= {f"{key}_{i}": (place, F.expr(a)) for key, a in aggregates.items()}
    return result


def outlier_rows(measured: DataFrame, limits: Mapping[str, Fences]) -> DataFrame:
    shown = {
        name: {key: number(value) for key, value in limit.shown.items()}
        for name, limit in limits.items()
    }
    return _rows(measured, shown)


def _rows(
    measured: DataFrame, limits: Mapping[str, dict[str, str]], by: Sequence[str] = ()
) -> DataFrame:
    """A row per column; `limits` gives the SQL of its quartiles and fences."""
    entries = [
        {"column_name": literal(name)}
        | limit
        | {
            "outliers_low": f"low_{i}",
            "outliers_high": f"high_{i}",
            "valid": f"valid_{i}",
            "actual_min": f"min_{i}",
            "actual_max": f"max_{i}",
        }
        for i, (name, limit) in enumerate(limits.items())
    ]
    shares = (
        to_rows(measured, entries, _SCHEMA, by)
        .withColumn("total_outliers", F.col("outliers_low") + F.col("outliers_high"))
        .withColumn("outlier_pct", percent("total_outliers", "valid"))
    )
    values = ["q1", "q3", "iqr", "lower_fence", "upper_fence", "actual_min", "actual_max"]
    return round_columns(shares, dict.fromkeys(values, 4) | {"outlier_pct": 2}).select(
        *map(column, by),
        "ordinal",
        "column_name",
        *values[:5],
        "outliers_low",
        "outliers_high",
        "total_outliers",
        "outlier_pct",
        *values[5:],
        level(F.col("outlier_pct"), OUTLIER_LEVELS).alias("severity"),
    )


def outlier_profile(
    df: DataFrame, columns: list[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """A row per column: quartiles, fences, values outside them, range, severity.

    Without `columns`, the int, bigint, decimal and double columns are checked. Shares are of the
    non-missing values. Whole numbers and decimals are compared exactly, at any size; figures are
    shown as doubles.

    With `by`, a row per group and column, with the quartiles and fences of the group; values are
    then compared as doubles, and grouping columns are not checked by themselves.
    """
    if columns is None:
        columns = [c for c in numeric_columns(df) if c not in by]
    if by:
        limits = {c: {k: f"{k}_{i}" for k in _LIMITS} for i, c in enumerate(columns)}
        measured = measured_by(normalise(df), columns, by, FENCE_FACTOR)
        return unambiguous(_rows(measured, limits, by))
    limits = fences(df, columns)
    df = normalise(df)
    return outlier_rows(measure(df, row_count() | outlier_aggregates(df, limits)), limits)


def outlier_summary(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count(F.lit(1)).alias("columns_checked"),
        F.count_if(F.col("total_outliers") > 0).alias("columns_with_outliers"),
        F.count_if(is_serious(F.col("severity"))).alias("columns_severe"),
        F.coalesce(F.sum("total_outliers"), F.lit(0)).alias("total_outlier_cells"),
    )


def severe_outliers(profile: DataFrame) -> DataFrame:
    return profile.where(is_serious(F.col("severity")))
