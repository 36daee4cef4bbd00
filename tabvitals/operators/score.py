"""Health score of a table, from its null profile and rule profile."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.functions.grading import grade
from tabvitals.functions.numeric import column, percent, round_columns

# Weights of the two parts of the score.
RULE_WEIGHT = 0.6
NULL_WEIGHT = 0.4


def health_score(nulls: DataFrame, rules: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row, or one per group of both profiles: score, its two parts and a grade.

    The rule part is the share of rules passed (100 without rules), the null part the share of
    columns whose null severity is "ok". All NULL for a table without rows or columns.
    """
    counts = (
        nulls.select(
            *map(column, by), F.lit(True).alias("is_column"), "severity", F.lit(0).alias("violations")
        )
        .unionByName(
            rules.select(*map(column, by), F.lit(False).alias("is_column"), "severity", "violations")
        )
        .groupBy(*map(column, by))
        .agg(
            F.expr("count_if(is_column AND severity IS NOT NULL)").alias("columns"),
            F.expr("count_if(is_column AND severity = 'ok')").alias("columns_ok"),
            F.expr("count_if(NOT is_column)").alias("checked"),
            F.expr("count_if(NOT is_column AND violations = 0)").alias("passed"),
        )
    )
    without_rules = (F.col("checked") == 0) & (F.col("columns") > 0)
    parts = counts.select(
        *map(column, by),
        percent("columns_ok", "columns").alias("null_score"),
        F.when(without_rules, 100.0)
        .when(F.col("columns") > 0, percent("passed", "checked"))
        .alias("rule_score"),
    )
    scored = parts.select(
        *map(column, by),
        (RULE_WEIGHT * F.col("rule_score") + NULL_WEIGHT * F.col("null_score")).alias("score"),
        "rule_score",
        "null_score",
    )
    figures = ("score", "rule_score", "null_score")
    return round_columns(scored, dict.fromkeys(figures, 1)).withColumn(
        "grade", grade(F.col("score"))
    )
