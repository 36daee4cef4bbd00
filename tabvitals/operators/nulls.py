"""Null profile: missing values per column."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.functions.grading import NULL_LEVELS, is_serious, level
from tabvitals.functions.numeric import column, normalise, percent, quoted, round_columns
from tabvitals.functions.text import literal
from tabvitals.operators.measure import (
    ROWS,
    Aggregates,
    measure,
    row_count,
    to_rows,
    unambiguous,
)


def null_aggregates(df: DataFrame) -> Aggregates:
    # count(c) skips NULL, so the missing values are what it leaves out of all rows.
    return {f"present_{i}": (i, F.expr(f"count({quoted(c)})")) for i, c in enumerate(df.columns)}


def null_rows(measured: DataFrame, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    entries = [
        {
            "column_name": literal(c),
            "null_count": f"{ROWS} - present_{i}",
            "row_count": ROWS,
        }
        for i, c in enumerate(df.columns)
        if c not in by
    ]
    schema = "column_name string, null_count bigint, row_count bigint"
    rows = to_rows(measured, entries, schema, by)
    shares = rows.select(
        *map(column, by),
        "ordinal",
        "column_name",
        "null_count",
        percent("null_count", "row_count").alias("null_pct"),
    )
    severity = level(F.col("null_pct"), NULL_LEVELS).alias("severity")
    return round_columns(shares, {"null_pct": 2}).select("*", severity)


def null_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A row per column: missing values, their share of all rows, severity of that share.

    With `by`, a row per group and column other than the grouping ones; missing values of a
    grouping column are a group.
    """
    df = normalise(df)
    measured = measure(df, row_count() | null_aggregates(df), by=by)
    return unambiguous(null_rows(measured, df, by))


def null_summary(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row over a null profile, or one per group. A column with nulls counts even if its share
    rounds to 0."""
    return profile.groupBy(*map(column, by)).agg(
        F.count_if(F.col("null_count") > 0).alias("columns_with_nulls"),
        F.count_if(is_serious(F.col("severity"))).alias("columns_critical"),
        F.coalesce(F.sum("null_count"), F.lit(0)).alias("total_null_cells"),
    )


def columns_with_nulls(profile: DataFrame) -> DataFrame:
    """The columns of a null profile that miss any value."""
    return profile.where("null_count > 0")
