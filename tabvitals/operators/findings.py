"""Findings: what failed in the profiles and validations of any number of datasets, as rows
and as one text per dataset.

The inputs are the section frames of profiles and validations, each with a `dataset` column.
Their size follows the number of checks, not of rows checked.
"""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.functions.text import literal, number_text
from tabvitals.operators.expectations import failed_details
from tabvitals.operators.outliers import severe_outliers
from tabvitals.operators.rules import failed_rules

# The lines of the text, with the fields that fill them. "n" stands for a whole
# number with thousands separators, "d" for one without, "f" for a decimal, "s" for text and
# "S" for text in capitals.
OVERVIEW_LINES = (
    ("DATASET OVERVIEW",),
    ("----------------",),
    ("Name         : %s", "s:dataset_name"),
    ("Rows         : %s", "n:row_count"),
    ("Columns      : %s", "d:column_count"),
    ("Profiled at  : %s", "s:profiled_at"),
)
HEALTH_LINES = (
    ("Health score : %s / 100  (Grade %s)", "f:score", "s:grade"),
    ("",),
)
NULL_LINES = (
    ("NULL PROFILE",),
    ("------------",),
    ("Columns with nulls : %s", "d:columns_with_nulls"),
    ("Total null cells   : %s", "n:total_null_cells"),
    ("",),
)
DUPLICATE_LINES = (
    ("DUPLICATE PROFILE",),
    ("-----------------",),
    ("Full duplicates    : %s", "n:full_duplicates"),
    ("Key-column dupes   : %s  (%s%%)", "n:key_column_dupes", "f:key_dupe_pct"),
    ("",),
)
OUTLIER_LINES = (
    ("OUTLIER PROFILE (IQR method)",),
    ("-----------------------------",),
    ("Columns with severe outliers : %s", "d:columns_severe"),
)
SEVERE_OUTLIER_LINES = (
    (
        "  %s: %s outliers (%s%%)  actual range [%s → %s]  expected [%s → %s]",
        "s:column_name",
        "n:total_outliers",
        "f:outlier_pct",
        "f:actual_min",
        "f:actual_max",
        "f:lower_fence",
        "f:upper_fence",
    ),
)
RULE_LINES = (
    ("",),
    ("BUSINESS RULE VIOLATIONS",),
    ("-------------------------",),
    ("Rules checked : %s", "d:rules_checked"),
    ("Rules passed  : %s", "d:rules_passed"),
    ("Rules failed  : %s", "d:rules_failed"),
)
FAILED_RULE_LINES = (
    ("  FAILED: %s", "s:rule_name"),
    ("    Rule       : %s", "s:rule"),
    ("    Violations : %s  (%s%%)", "n:violations", "f:violation_pct"),
    ("    Severity   : %s", "S:severity"),
)
VALIDATION_LINES = (
    ("",),
    ("GREAT EXPECTATIONS VALIDATION",),
    ("------------------------------",),
    ("Expectations run  : %s", "d:total"),
    ("Passed            : %s", "d:passed"),
    ("Failed            : %s", "d:failed"),
    ("Success rate      : %s%%", "f:success_pct"),
)
FAILED_EXPECTATION_LINES = (
    ("  FAILED: %s on [%s]", "s:expectation", "s:column"),
    ("    Violations : %s  (%s%%)", "n:violation_count", "f:violation_pct"),
    ("    Rule desc  : %s", "s:description"),
)


_OUTLIER_DETAIL = "actual [%s, %s], expected [%s, %s]"


def _field(spec: str) -> str:
    kind, name = spec.split(":")
    shown = {
        "n": f"format_number({name}, 0)",
        "d": f"CAST({name} AS STRING)",
        "f": number_text(name),
        "s": f"CAST({name} AS STRING)",
        "S": f"upper({name})",
    }[kind]
    return f"coalesce({shown}, 'None')"


def _lines(frame: DataFrame, section: int, templates: tuple, item: str = "0") -> DataFrame:
    """A row per line, with its place in the text of its dataset."""
    texts = [
        f"format_string({', '.join([literal(template), *map(_field, specs)])})"
        for template, *specs in templates
    ]
    return frame.selectExpr(
        "dataset",
        f"{section} AS section",
        f"{item} AS item",
        f"posexplode(array({', '.join(texts)})) AS (line, text)",
    )


def findings(rules: DataFrame, outliers: DataFrame, results: DataFrame) -> DataFrame:
    """A row per failed rule, seriously outlying column and failed expectation."""
    shown = ("actual_min", "actual_max", "lower_fence", "upper_fence")
    limits = ", ".join(number_text(c) for c in shown)
    parts = [
        failed_rules(rules).select(
            "dataset",
            F.lit("rule").alias("kind"),
            "ordinal",
            F.col("rule_name").alias("name"),
            "column",
            F.col("violations").alias("count"),
            F.col("violation_pct").alias("pct"),
            "severity",
            F.col("rule").alias("detail"),
        ),
        severe_outliers(outliers).select(
            "dataset",
            F.lit("outlier").alias("kind"),
            "ordinal",
            F.lit("iqr_outliers").alias("name"),
            F.col("column_name").alias("column"),
            F.col("total_outliers").alias("count"),
            F.col("outlier_pct").alias("pct"),
            "severity",
            F.expr(f"format_string({literal(_OUTLIER_DETAIL)}, {limits})").alias("detail"),
        ),
        failed_details(results).select(
            "dataset",
            F.lit("expectation").alias("kind"),
            "ordinal",
            F.col("expectation").alias("name"),
            "column",
            F.col("violation_count").alias("count"),
            F.col("violation_pct").alias("pct"),
            F.lit(None).cast("string").alias("severity"),
            F.col("description").alias("detail"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def findings_text(sections: Mapping[str, DataFrame]) -> DataFrame:
    """A row per dataset: its name and the text that sums up its profile and validation.

    `sections` holds the frames overview, health, null_summary, duplicates, outlier_summary,
    outliers, rule_summary, rules, validation_summary and results.
    """
    moment = F.date_format("profiled_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    head = sections["overview"].withColumn(
        "profiled_at", F.regexp_replace(moment, r"\.000000$", "")
    )
    lines = [
        _lines(head, 0, OVERVIEW_LINES),
        _lines(sections["health"], 1, HEALTH_LINES),
        _lines(sections["null_summary"], 2, NULL_LINES),
        _lines(sections["duplicates"], 3, DUPLICATE_LINES),
        _lines(sections["outlier_summary"], 4, OUTLIER_LINES),
        _lines(severe_outliers(sections["outliers"]), 5, SEVERE_OUTLIER_LINES, "ordinal"),
        _lines(sections["rule_summary"], 6, RULE_LINES),
        _lines(failed_rules(sections["rules"]), 7, FAILED_RULE_LINES, "ordinal"),
        _lines(sections["validation_summary"], 8, VALIDATION_LINES),
        _lines(failed_details(sections["results"]), 9, FAILED_EXPECTATION_LINES, "ordinal"),
    ]
    return (
        reduce(DataFrame.unionByName, lines)
        .groupBy("dataset")
        .agg(F.array_sort(F.collect_list(F.struct("section", "item", "line", "text"))).alias("all"))
        .select("dataset", F.array_join(F.col("all.text"), "\n").alias("findings_text"))
    )
