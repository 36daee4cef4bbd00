"""Business rules: predicates that no row should satisfy."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabvitals.functions.numeric import (
    column,
    normalise,
    number,
    percent,
    quoted,
    round_columns,
    rounded_scaled,
)
from tabvitals.functions.text import literal
from tabvitals.operators.measure import (
    ROWS,
    Aggregates,
    measure,
    row_count,
    to_rows,
    unambiguous,
)


@dataclass(frozen=True)
class Rule:
    """`violation` is true for a bad row; false and NULL are fine.

    A rule is skipped on tables that lack one of the `requires` columns (exact spelling).
    `on_fail` is its severity once a row violates it.
    """

    name: str
    column: str
    rule: str
    violation: Column
    on_fail: str = "critical"
    requires: tuple[str, ...] = ()


def positive(name: str, /, **rule) -> Rule:
    """Zero or less violates."""
    return _on(name, column(name) <= 0, f"{name} > 0", **rule)


def non_negative(name: str, /, **rule) -> Rule:
    """Less than zero violates."""
    return _on(name, column(name) < 0, f"{name} >= 0", **rule)


def in_range(name: str, low, high, /, **rule) -> Rule:
    """Below `low` or above `high` violates."""
    outside = (column(name) < low) | (column(name) > high)
    return _on(name, outside, f"{low} <= {name} <= {high}", **rule)


def ordered(first: str, second: str, /, **rule) -> Rule:
    """`first` at or after `second` violates."""
    return _on((first, second), column(first) >= column(second), f"{first} < {second}", **rule)


def expected_year(name: str, year: int, /, **rule) -> Rule:
    """Any other year violates, and so does a missing timestamp."""
    other = ~F.year(column(name)).eqNullSafe(F.lit(year))
    return _on(name, other, f"year({name}) == {year}", **rule)


def zero_with_positive(zero: str, positive_column: str, /, **rule) -> Rule:
    """`zero` being 0 while `positive_column` is above 0 violates."""
    both = (column(zero) == 0) & (column(positive_column) > 0)
    text = f"NOT ({zero}==0 AND {positive_column}>0)"
    return _on((zero, positive_column), both, text, **rule)


def sum_matches(total: str, parts: Sequence[str], tolerance: float, /, **rule) -> Rule:
    """A total further than `tolerance` from the sum of its parts violates.

    Missing parts count as 0, a missing total is fine, and both sides are rounded to 2
    decimals first. The amounts stay doubles: decimals would decide some ties differently.
    """
    summed = " + ".join(f"coalesce(CAST({quoted(p)} AS DOUBLE), 0D)" for p in parts)
    stated = f"CAST({quoted(total)} AS DOUBLE)"
    difference = f"{rounded_scaled(f'({summed})', 2)} - {rounded_scaled(stated, 2)}"
    violation = F.expr(f"abs({difference}) > {number(float(tolerance))}")
    rule = {"requires": (*parts, total)} | rule
    return _on(total, violation, f"{total} = sum of parts", **rule)


def _on(names: str | tuple[str, ...], violation: Column, text: str, **given) -> Rule:
    names = (names,) if isinstance(names, str) else names
    defaults = {"name": text, "column": " + ".join(names), "rule": text, "requires": names}
    return Rule(violation=violation, **(defaults | given))


def applicable(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """The rules whose columns the table has, also those that a violation names only itself."""
    present = set(df.columns)
    return [r for r in rules if present.issuperset(r.requires) and (r.requires or _fits(df, r))]


def _fits(df: DataFrame, rule: Rule) -> bool:
    try:
        df.select(rule.violation)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        return False
    return True


def rule_aggregates(df: DataFrame, rules: Sequence[Rule]) -> Aggregates:
    first = [df.columns.index(r.requires[0]) if r.requires else 0 for r in rules]
    return {f"rule_{i}": (first[i], F.count_if(r.violation)) for i, r in enumerate(rules)}


def rule_rows(
    measured: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()
) -> DataFrame:
    entries = [
        {
            "rule_name": literal(r.name),
            "column": literal(r.column),
            "rule": literal(r.rule),
            "violations": f"rule_{i}",
            "row_count": ROWS,
            "on_fail": literal(r.on_fail),
        }
        for i, r in enumerate(rules)
    ]
    schema = (
        "rule_name string, column string, rule string, violations bigint, "
        "row_count bigint, on_fail string"
    )
    shares = to_rows(measured, entries, schema, by).withColumn(
        "violation_pct", percent("violations", "row_count")
    )
    return round_columns(shares, {"violation_pct": 2}).select(
        *map(column, by),
        "ordinal",
        "rule_name",
        "column",
        "rule",
        "violations",
        "violation_pct",
        F.when(F.col("row_count") == 0, None)
        .when(F.col("violations") == 0, "ok")
        .otherwise(F.col("on_fail"))
        .alias("severity"),
    )


def rule_profile(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """A row per applicable rule, or per group and rule: violations, their share of all rows of
    the group, severity."""
    df = normalise(df)
    rules = applicable(df, rules)
    measured = measure(df, row_count() | rule_aggregates(df, rules), by=by)
    return unambiguous(rule_rows(measured, rules, by))


def rule_summary(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return profile.groupBy(*map(column, by)).agg(
        F.count(F.lit(1)).alias("rules_checked"),
        F.count_if(F.col("violations") == 0).alias("rules_passed"),
        F.count_if(F.col("violations") > 0).alias("rules_failed"),
        F.coalesce(F.sum("violations"), F.lit(0)).alias("total_violations"),
    )


def failed_rules(profile: DataFrame) -> DataFrame:
    return profile.where("violations > 0")


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """A row per applicable rule with its number of violations only, as in exploration."""
    profile = rule_profile(df, rules)
    return profile.select("ordinal", F.col("rule_name").alias("check"), "violations")
