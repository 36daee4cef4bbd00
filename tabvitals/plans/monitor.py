"""The monitor: profile a table, validate it, sum up the findings, keep the reports."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabvitals.operators.expectations import Expectation
from tabvitals.operators.explanations import parse_explanations
from tabvitals.operators.findings import findings, findings_text
from tabvitals.plans.profile import (
    Profile,
    Validation,
    check_table,
    profile_report,
    profile_table,
    validate_table,
    validation_report,
)
from tabvitals.sources.reports import (
    EXPLANATIONS,
    PROFILE,
    VALIDATION,
    load_latest_reports,
    save_report,
)


@dataclass(frozen=True)
class MonitorRun:
    profile: Profile
    validation: Validation

    def findings(self) -> DataFrame:
        return findings(self.profile.rules, self.profile.outliers, self.validation.results)

    def findings_text(self) -> DataFrame:
        return findings_text(vars(self.profile) | vars(self.validation))

    def save(self, path: str) -> None:
        """Append both reports to the report table in `path`."""
        save_report(profile_report(self.profile), path, PROFILE)
        save_report(validation_report(self.validation), path, VALIDATION)


def monitor_table(
    df: DataFrame,
    dataset: str,
    suite: Sequence[Expectation],
    reports: str | None = None,
    run_at: Column | None = None,
    **options,
) -> MonitorRun:
    """Check a table as `check_table` does and, given a folder, save the reports."""
    run_at = F.current_timestamp() if run_at is None else run_at
    run = MonitorRun(*check_table(df, dataset, suite=suite, run_at=run_at, **options))
    if reports:
        run.save(reports)
    return run


def profile_and_save(df: DataFrame, dataset: str, reports: str, **options) -> Profile:
    """Profile a table and save the report; options as for `check_table`."""
    profile = profile_table(df, dataset, **options)
    save_report(profile_report(profile), reports, PROFILE)
    return profile


def validate_and_save(
    df: DataFrame,
    dataset: str,
    suite: Sequence[Expectation],
    reports: str,
    run_at: Column | None = None,
) -> Validation:
    """Validate a table and save the report."""
    validation = validate_table(df, dataset, suite, run_at)
    save_report(validation_report(validation), reports, VALIDATION)
    return validation


def report_sections(profiles: DataFrame, validations: DataFrame) -> dict[str, DataFrame]:
    """The section frames out of saved reports of any number of datasets."""

    def fields(reports, name):
        return reports.select("dataset", f"{name}.*")

    def items(reports, name):
        return reports.select("dataset", F.inline(name))

    return {
        "overview": fields(profiles, "overview"),
        "health": fields(profiles, "health_score"),
        "null_summary": fields(profiles, "nulls.summary"),
        "duplicates": fields(profiles, "duplicates"),
        "outlier_summary": fields(profiles, "outliers.summary"),
        "outliers": items(profiles, "outliers.by_column"),
        "rule_summary": fields(profiles, "business_rules.summary"),
        "rules": items(profiles, "business_rules.by_rule"),
        "validation_summary": validations.select(
            "dataset", "validated_at", "total", "passed", "failed", "success_pct"
        ),
        "results": items(validations, "results"),
    }


def latest_findings_text(spark: SparkSession, path: str) -> DataFrame:
    """The findings text of every dataset, from its newest saved reports."""
    profiles = load_latest_reports(spark, path, PROFILE)
    validations = load_latest_reports(spark, path, VALIDATION)
    return findings_text(report_sections(profiles, validations))


def save_explanations(answers: DataFrame, path: str, response: str = "response") -> None:
    """Parse stored answers, rows (dataset, run_ts, response), and append them to the reports."""
    save_report(parse_explanations(answers, response).drop(response), path, EXPLANATIONS)
