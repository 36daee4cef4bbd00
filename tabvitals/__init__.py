"""Data-quality checks for tables of any size, as Spark DataFrame operators."""

from tabvitals.operators.duplicates import duplicate_profile, key_duplicates
from tabvitals.operators.expectations import (
    Expectation,
    between,
    column_count_equals,
    columns_match_set,
    failed_details,
    in_set,
    not_null,
    row_count_between,
    validate,
    validation_summary,
)
from tabvitals.operators.explanations import issue_counts, issues, parse_explanations
from tabvitals.operators.explore import describe, describe_timestamps, value_counts
from tabvitals.operators.findings import findings, findings_text
from tabvitals.operators.nulls import columns_with_nulls, null_profile, null_summary
from tabvitals.operators.outliers import outlier_profile, outlier_summary, severe_outliers
from tabvitals.operators.overview import column_types, first_rows, numeric_columns, overview
from tabvitals.operators.quantiles import approximate_quantiles, exact_quantiles, quantile_profile
from tabvitals.operators.rules import Rule, failed_rules, rule_profile, rule_summary, violation_counts
from tabvitals.operators.score import health_score
from tabvitals.plans.monitor import (
    latest_findings_text,
    report_sections,
    monitor_table,
    profile_and_save,
    validate_and_save,
    save_explanations,
)
from tabvitals.plans.profile import (
    check_table,
    profile_report,
    profile_table,
    validate_table,
    validation_report,
)
from tabvitals.plans.states import MergedState, merged_state, save_state
from tabvitals.sources.reports import (
    compact_reports,
    latest,
    load_latest_report,
    load_latest_reports,
    read_reports,
    report_days,
    save_report,
)
from tabvitals.sources.tables import read_table

__all__ = [name for name in dir() if not name.startswith("_")]
