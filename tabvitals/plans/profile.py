"""The whole profile of a table: all sections from as few scans as they need."""

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tabvitals.functions.numeric import normalise
from tabvitals.operators.duplicates import duplicate_measures, duplicate_rows
from tabvitals.operators.expectations import (
    Expectation,
    expectation_aggregates,
    failed_details,
    validation_rows,
    validation_summary,
)
from tabvitals.operators.measure import materialise, measure, merge_rows, row_count
from tabvitals.operators.nulls import null_aggregates, null_rows, null_summary
from tabvitals.operators.outliers import fences, outlier_aggregates, outlier_rows, outlier_summary
from tabvitals.operators.overview import (
    column_type_rows,
    numeric_columns,
    overview_rows,
    size_aggregates,
)
from tabvitals.operators.rules import Rule, applicable, rule_aggregates, rule_rows, rule_summary
from tabvitals.operators.score import health_score


@dataclass(frozen=True)
class Profile:
    """The sections of a profile. Each frame has a `dataset` column."""

    overview: DataFrame
    column_types: DataFrame
    nulls: DataFrame
    null_summary: DataFrame
    duplicates: DataFrame
    outliers: DataFrame
    outlier_summary: DataFrame
    rules: DataFrame
    rule_summary: DataFrame
    health: DataFrame


@dataclass(frozen=True)
class Validation:
    """The results of a suite and their summary. Each frame has a `dataset` column."""

    results: DataFrame
    validation_summary: DataFrame

    @property
    def failed_details(self) -> DataFrame:
        return failed_details(self.results)


def check_table(
    df: DataFrame,
    dataset: str,
    numeric: Sequence[str] | None = None,
    key_columns: Sequence[str] = (),
    rules: Sequence[Rule] = (),
    suite: Sequence[Expectation] = (),
    run_at: Column | None = None,
) -> tuple[Profile, Validation]:
    """Profile and validate a table.

    The quartiles take a few scans of the numeric columns. Nulls, sizes, rules, outliers and
    expectations then share one scan. Duplicates shuffle row fingerprints and keys. The
    measured row is materialised, so using a section costs no further scan.
    """
    keys, numeric = list(key_columns), numeric_columns(df) if numeric is None else list(numeric)
    clean = normalise(df)
    with ThreadPoolExecutor(1) as pool:
        # Neither needs the other, and each leaves executors idle between its scans.
        count_repeats = inheritable_thread_target(df.sparkSession)(duplicate_measures)
        repeats = pool.submit(count_repeats, clean, keys)
        limits = fences(df, numeric)
    df, rules = clean, applicable(clean, rules)
    aggregates = (
        row_count()
        | null_aggregates(df)
        | size_aggregates(df)
        | outlier_aggregates(df, limits)
        | rule_aggregates(df, rules)
        | expectation_aggregates(df, suite)
    )
    measured = materialise(merge_rows([measure(df, aggregates), repeats.result()]))

    nulls = null_rows(measured, df)
    outliers = outlier_rows(measured, limits)
    rule_results = rule_rows(measured, rules)
    results = validation_rows(measured, df, suite)
    profile = Profile(
        overview=overview_rows(measured, df, dataset, run_at),
        column_types=column_type_rows(measured, df),
        nulls=nulls,
        null_summary=null_summary(nulls),
        duplicates=duplicate_rows(measured, df, keys),
        outliers=outliers,
        outlier_summary=outlier_summary(outliers),
        rules=rule_results,
        rule_summary=rule_summary(rule_results),
        health=health_score(nulls, rule_results),
    )
    validation = Validation(results, validation_summary(results, run_at))
    return _of_dataset(profile, dataset), _of_dataset(validation, dataset)


def profile_table(df: DataFrame, dataset: str, **options) -> Profile:
    """The profile alone; options as for `check_table`."""
    return check_table(df, dataset, **options)[0]


def validate_table(
    df: DataFrame, dataset: str, suite: Sequence[Expectation], run_at: Column | None = None
) -> Validation:
    """The validation alone, in one scan."""
    df = normalise(df)
    measured = materialise(measure(df, row_count() | expectation_aggregates(df, suite)))
    results = validation_rows(measured, df, suite)
    return _of_dataset(Validation(results, validation_summary(results, run_at)), dataset)


def _of_dataset(sections, dataset: str):
    return type(sections)(
        **{
            f.name: getattr(sections, f.name).select(F.lit(dataset).alias("dataset"), "*")
            for f in fields(sections)
        }
    )


def _gather(single: dict[str, DataFrame], many: dict[str, DataFrame]) -> DataFrame:
    """One row per dataset: a struct per `single` frame, an ordered array per `many` frame."""
    parts = [
        frame.select(
            "dataset", F.struct(*[c for c in frame.columns if c != "dataset"]).alias(name)
        )
        for name, frame in (single | many).items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy("dataset").agg(
        *[F.first(n, ignorenulls=True).alias(n) for n in single],
        # As many items as the dataset has columns or checks.
        *[F.array_sort(F.collect_list(n)).alias(n) for n in many],
    )


def profile_report(profile: Profile) -> DataFrame:
    """One nested row per dataset, to be saved."""
    gathered = _gather(
        single={
            "overview": profile.overview,
            "null_summary": profile.null_summary,
            "duplicates": profile.duplicates,
            "outlier_summary": profile.outlier_summary,
            "rule_summary": profile.rule_summary,
            "health_score": profile.health,
        },
        many={
            "column_types": profile.column_types,
            "nulls": profile.nulls,
            "outliers": profile.outliers,
            "rules": profile.rules,
        },
    )
    return gathered.select(
        "dataset",
        F.col("overview.profiled_at").alias("run_ts"),
        "overview",
        "column_types",
        F.expr("struct(null_summary AS summary, nulls AS by_column)").alias("nulls"),
        "duplicates",
        F.expr("struct(outlier_summary AS summary, outliers AS by_column)").alias("outliers"),
        F.expr("struct(rule_summary AS summary, rules AS by_rule)").alias("business_rules"),
        "health_score",
    )


def validation_report(validation: Validation) -> DataFrame:
    """One nested row per dataset, to be saved."""
    gathered = _gather(
        single={"summary": validation.validation_summary}, many={"results": validation.results}
    )
    return gathered.select(
        "dataset",
        F.col("summary.validated_at").alias("run_ts"),
        "summary.*",
        "results",
        F.filter("results", lambda r: ~r["passed"]).alias("failed_details"),
    )
