"""The report table: JSON lines under one folder, partitioned by kind of report and day of run.

Reports are appended. Days are those of the run's time in UTC, whatever the zone of a session, so a
newer day has newer runs, and the newest report about a dataset is looked for from the newest day
backwards. Many small files of a day can be put together by `compact_reports`.
"""

import re
from collections.abc import Iterator
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabvitals.sources.scratch import written

PROFILE = "profile"
VALIDATION = "validation"
EXPLANATIONS = "explanations"

_RESULT = (
    "struct<ordinal: int, expectation: string, column: string, group: string, passed: boolean, "
    "violation_count: bigint, violation_pct: double, description: string, reason: string>"
)
_ISSUE = (
    "struct<issue: string, column: string, severity: string, violation_count: string, "
    "what_happened: string, likely_cause: string, business_impact: string, "
    "recommended_action: string>"
)

# The content of a report by kind.
SCHEMAS = {
    PROFILE: (
        "dataset string, run_ts timestamp, "
        "overview struct<dataset_name: string, profiled_at: timestamp, row_count: bigint, "
        "column_count: int, columns: array<string>, size_mb: double>, "
        "column_types array<struct<ordinal: int, column_name: string, data_type: string, "
        "logical_bytes: bigint>>, "
        "nulls struct<summary: struct<columns_with_nulls: bigint, columns_critical: bigint, "
        "total_null_cells: bigint>, by_column: array<struct<ordinal: int, column_name: string, "
        "null_count: bigint, null_pct: double, severity: string>>>, "
        "duplicates struct<full_duplicates: bigint, full_duplicate_pct: double, "
        "key_column_dupes: bigint, key_dupe_pct: double, key_columns_checked: array<string>, "
        "severity: string>, "
        "outliers struct<summary: struct<columns_checked: bigint, columns_with_outliers: bigint, "
        "columns_severe: bigint, total_outlier_cells: bigint>, by_column: array<struct<"
        "ordinal: int, column_name: string, q1: double, q3: double, iqr: double, "
        "lower_fence: double, upper_fence: double, outliers_low: bigint, outliers_high: bigint, "
        "total_outliers: bigint, outlier_pct: double, actual_min: double, actual_max: double, "
        "severity: string>>>, "
        "business_rules struct<summary: struct<rules_checked: bigint, rules_passed: bigint, "
        "rules_failed: bigint, total_violations: bigint>, by_rule: array<struct<ordinal: int, "
        "rule_name: string, column: string, rule: string, violations: bigint, "
        "violation_pct: double, severity: string>>>, "
        "health_score struct<score: double, rule_score: double, null_score: double, "
        "grade: string>"
    ),
    VALIDATION: (
        "dataset string, run_ts timestamp, validated_at timestamp, total bigint, passed bigint, "
        f"failed bigint, success_pct double, results array<{_RESULT}>, "
        f"failed_details array<{_RESULT}>"
    ),
    EXPLANATIONS: (
        "dataset string, run_ts timestamp, raw_response string, "
        f"explanations array<{_ISSUE}>, overall_assessment string, parse_error string, "
        "answer string"
    ),
}


_DAY = "date_from_unix_date(CAST(floor(unix_seconds(CAST(run_ts AS TIMESTAMP)) / 86400) AS INT))"
_IN_PATH = re.compile(r"/kind=([^/]+)/day=(\d{4}-\d{2}-\d{2})/")


def save_report(report: DataFrame, path: str, kind: str) -> None:
    """Append report rows of a kind. A report without a time has no day and counts as the oldest."""
    dated = report.withColumn("kind", F.lit(kind)).withColumn("day", F.expr(_DAY))
    _written(dated, path, "append")


def _written(reports: DataFrame, path: str, mode: str) -> None:
    (
        reports.write.mode(mode)
        .partitionBy("kind", "day")
        .option("ignoreNullFields", "false")
        .option("partitionOverwriteMode", "dynamic")
        .json(path)
    )


def _dated_reports(spark: SparkSession, path: str, kind: str) -> DataFrame:
    try:
        # The kind is a partition, so only its files are read; so is the day.
        schema = f"{SCHEMAS[kind]}, kind string, day date"
        return spark.read.schema(schema).json(path).where(F.col("kind") == kind)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no {kind} report in {path}") from error


def _reports(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return _dated_reports(spark, path, kind).drop("day")


def report_days(spark: SparkSession, path: str, kind: str) -> list[date]:
    """The days that have reports of a kind, newest first, from the names of folders alone."""
    found = map(_IN_PATH.search, _dated_reports(spark, path, kind).inputFiles())
    days = {m[2] for m in found if m and m[1] == kind}
    return sorted(map(date.fromisoformat, days), reverse=True)


def _newest_first(spark: SparkSession, path: str, kind: str) -> Iterator[DataFrame]:
    """Reports of the newest day, then of the two before, the four before, and so on; at last those
    without a day."""
    reports, days = _dated_reports(spark, path, kind), report_days(spark, path, kind)
    some = 1
    while days:
        newest, days = days[:some], days[some:]
        yield reports.where(F.col("day").between(newest[-1], newest[0])).drop("day")
        some *= 2
    yield reports.where("day IS NULL").drop("day")


def compact_reports(spark: SparkSession, path: str, kind: str, until: date) -> None:
    """Put the reports of each day up to `until` into one file a day. No report is lost or changed.

    The reports are copied to a shared folder first, as a table cannot be read and replaced at once;
    each day's files are replaced when all new ones are written. Nothing may be saved on these days
    at the same time.
    """
    old = written(_dated_reports(spark, path, kind).where(F.col("day") <= until), "reports")
    if not old.isEmpty():
        _written(old.repartition("day"), path, "overwrite")


def read_reports(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """All reports of a kind; fails if there are none."""
    reports = _reports(spark, path, kind)
    if reports.isEmpty():
        raise FileNotFoundError(f"no {kind} report in {path}")
    return reports


def latest(
    reports: DataFrame, by: tuple[str, ...] = ("dataset", "kind"), at: str = "run_ts"
) -> DataFrame:
    """The newest row of every group; the greatest row wins among equally new ones.

    The newest time of each group is found first, from the grouping columns and times alone, with
    one row per group and task in the shuffle. Only rows of these times are then compared whole.
    """
    others = [c for c in reports.columns if c not in by]
    times = reports.groupBy(*by).agg(F.max(at).alias(at))
    times = times.toDF(*[f"newest {c}" for c in times.columns])
    matching = [F.col(f"`{c}`").eqNullSafe(F.col(f"`newest {c}`")) for c in (*by, at)]
    recent = reports.join(times, matching, "left_semi")
    greatest = F.max(F.struct(at, *[c for c in others if c != at]))
    newest = recent.groupBy(*by).agg(greatest.alias("newest"))
    return newest.select(*by, *[f"newest.{c}" for c in others])


def load_latest_reports(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The newest report of a kind about every dataset; fails if there are none."""
    return latest(read_reports(spark, path, kind))


def load_latest_report(spark: SparkSession, path: str, kind: str, dataset: str) -> DataFrame:
    """The newest report of a kind about one dataset; fails if there is none.

    Days are read from the newest backwards until one has a report about the dataset.
    """
    for some in _newest_first(spark, path, kind):
        reports = some.where(F.col("dataset") == dataset)
        if not reports.isEmpty():
            return latest(reports)
    raise FileNotFoundError(f"no {kind} report about {dataset} in {path}")
