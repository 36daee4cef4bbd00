"""Declarative expectations and their validation."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabvitals.functions.numeric import column, normalise, number, percent, round_columns
from tabvitals.functions.text import literal
from tabvitals.operators.measure import (
    ROWS,
    Aggregates,
    measure,
    row_count,
    to_rows,
    unambiguous,
)
from tabvitals.operators.overview import run_time

# Names under which the results are reported.
COLUMNS_MATCH_SET = "expect_table_columns_to_match_set"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
ROW_COUNT_BETWEEN = "expect_table_row_count_to_be_between"
COLUMN_COUNT_EQUAL = "expect_table_column_count_to_equal"
TABLE_LEVEL = "table-level"
DEFAULT_GROUP = "general"

_MEASURED = (
    "expectation string, column string, group string, holds boolean, unexpected bigint, "
    "considered bigint, mostly double, description string, reason string"
)


@dataclass(frozen=True)
class Expectation:
    """What is expected of a table or of one of its columns.

    A column expectation has the predicate `unexpected`, true for a bad value; it passes if at
    least the share `mostly` of the values considered is good. Missing values are considered
    only with `considers_missing`. A table expectation has one of `rows_between`, `column_set`
    and `column_count` instead.
    """

    expectation: str
    column: str = TABLE_LEVEL
    group: str = DEFAULT_GROUP
    description: str = ""
    unexpected: Column | None = None
    considers_missing: bool = False
    mostly: float = 1.0
    rows_between: tuple[int | None, int | None] | None = None
    column_set: tuple[str, ...] | None = None
    exact_match: bool = True
    column_count: int | None = None

    def missing_from(self, df: DataFrame) -> bool:
        return self.unexpected is not None and self.column not in df.columns


def columns_match_set(columns: Sequence[str], exact_match: bool = True, **meta) -> Expectation:
    """The columns exist; with `exact_match` there are no others."""
    return Expectation(
        COLUMNS_MATCH_SET, column_set=tuple(columns), exact_match=exact_match, **meta
    )


def column_count_equals(value: int, **meta) -> Expectation:
    return Expectation(COLUMN_COUNT_EQUAL, column_count=value, **meta)


def row_count_between(
    min_value: int | None = None, max_value: int | None = None, **meta
) -> Expectation:
    """Bounds are inclusive; either may be absent."""
    return Expectation(ROW_COUNT_BETWEEN, rows_between=(min_value, max_value), **meta)


def not_null(name: str, mostly: float = 1.0, **meta) -> Expectation:
    """Shares are of all rows."""
    return Expectation(
        NOT_NULL,
        name,
        unexpected=column(name).isNull(),
        considers_missing=True,
        mostly=mostly,
        **meta,
    )


def between(name: str, min_value=None, max_value=None, mostly: float = 1.0, **meta) -> Expectation:
    """Bounds are inclusive and either may be absent; shares are of the non-missing values."""
    if min_value is None and max_value is None:
        raise ValueError("between needs at least one bound")
    outside = F.lit(False)
    if min_value is not None:
        outside = outside | (column(name) < min_value)
    if max_value is not None:
        outside = outside | (column(name) > max_value)
    return Expectation(BETWEEN, name, unexpected=outside, mostly=mostly, **meta)


def in_set(name: str, value_set: Sequence, mostly: float = 1.0, **meta) -> Expectation:
    """Shares are of the non-missing values, so a None in the set says nothing."""
    values = [v for v in value_set if v is not None]
    return Expectation(IN_SET, name, unexpected=~column(name).isin(*values), mostly=mostly, **meta)


def expectation_aggregates(df: DataFrame, suite: Sequence[Expectation]) -> Aggregates:
    result = {}
    for i, e in enumerate(suite):
        if e.unexpected is not None and not e.missing_from(df):
            place = df.columns.index(e.column)
            considered = F.lit(1) if e.considers_missing else column(e.column)
            result[f"unexpected_{i}"] = (place, F.count_if(e.unexpected))
            result[f"considered_{i}"] = (place, F.count(considered))
    return result


def _table_outcome(e: Expectation, df: DataFrame) -> str:
    if e.column_set is not None:
        expected, actual = set(e.column_set), set(df.columns)
        return str(expected == actual if e.exact_match else expected <= actual)
    if e.column_count is not None:
        return str(len(df.columns) == e.column_count)
    low, high = e.rows_between
    bounds = [f"{ROWS} >= {low}"] * (low is not None) + [f"{ROWS} <= {high}"] * (high is not None)
    return " AND ".join(bounds) or "True"


def validation_rows(
    measured: DataFrame, df: DataFrame, suite: Sequence[Expectation], by: Sequence[str] = ()
) -> DataFrame:
    entries = []
    for i, e in enumerate(suite):
        unexpected, considered, reason = "0L", "0L", None
        if e.missing_from(df):
            holds, reason = "False", "column not found"
        elif e.unexpected is None:
            holds = _table_outcome(e, df)
        else:
            holds = "CAST(NULL AS BOOLEAN)"
            unexpected, considered = f"unexpected_{i}", f"considered_{i}"
        entries.append(
            {
                "expectation": literal(e.expectation),
                "column": literal(e.column),
                "group": literal(e.group),
                "holds": holds,
                "unexpected": unexpected,
                "considered": considered,
                "mostly": number(float(e.mostly)),
                "description": literal(e.description),
                "reason": literal(reason),
            }
        )
    good_share = F.expr("(considered - unexpected) / nullif(considered, 0)")
    judged = (
        to_rows(measured, entries, _MEASURED, by)
        .withColumn("passed", F.coalesce("holds", good_share >= F.col("mostly"), F.lit(True)))
        .withColumn("violation_pct", percent("unexpected", "considered"))
    )
    # What `mostly` tolerates is not reported.
    reported = F.expr("NOT passed AND holds IS NULL")
    return round_columns(judged, {"violation_pct": 2}).select(
        *map(column, by),
        "ordinal",
        "expectation",
        "column",
        "group",
        "passed",
        F.when(reported, F.col("unexpected")).otherwise(0).alias("violation_count"),
        F.when(reported, F.col("violation_pct")).otherwise(0.0).alias("violation_pct"),
        "description",
        "reason",
    )


def validate(
    df: DataFrame, suite: Sequence[Expectation], by: Sequence[str] = ()
) -> DataFrame:
    """A row per expectation, in suite order. Failed expectations carry their violations.

    With `by`, every group is validated as a table of its own that has all columns.
    """
    df = normalise(df)
    measured = measure(df, row_count() | expectation_aggregates(df, suite), by=by)
    return unambiguous(validation_rows(measured, df, suite, by))


def validation_summary(
    results: DataFrame, validated_at: Column | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """One row, or one per group: time, expectations evaluated, passed, failed, success in percent
    (1 decimal)."""
    counts = results.groupBy(*map(column, by)).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    ).select(
        *map(column, by),
        run_time(validated_at).alias("validated_at"),
        "total",
        "passed",
        "failed",
        percent("passed", "total").alias("success_pct"),
    )
    return round_columns(counts, {"success_pct": 1})


def failed_details(results: DataFrame) -> DataFrame:
    return results.where(~F.col("passed"))
