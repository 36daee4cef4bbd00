"""One query per operator, on the given tables."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tabvitals as tv
from catalog import inputs
from tabvitals.operators.expectations import Expectation
from tabvitals.operators.rules import (
    Rule,
    expected_year,
    in_range,
    non_negative,
    ordered,
    positive,
    sum_matches,
    zero_with_positive,
)
from tabvitals.presets import taxi
from tabvitals.sources import reports

KEYS = ["user_id", "event_type"]
OUTLIER_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def run_time():
    """A fixed time of running, so that results can be compared."""
    return F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")


def shipment_rules() -> list[Rule]:
    return [
        positive("l_discount", name="discount_positive"),
        non_negative("l_tax", name="tax_non_negative"),
        in_range("l_quantity", 5, 45, name="quantity_in_range", on_fail="warning"),
        ordered("l_shipdate", "l_receiptdate", name="shipped_before_received"),
        expected_year("l_shipdate", 1998, name="shipped_in_1998"),
        zero_with_positive("l_discount", "l_tax", name="taxed_without_discount", on_fail="warning"),
        sum_matches(
            "total",
            ["part_price", "part_tax", "part_discount"],
            0.10,
            name="total_matches_parts",
            on_fail="warning",
        ),
        positive("l_weight", name="skipped_without_its_column"),
    ]


def lineitem_suite() -> list[Expectation]:
    return [
        tv.columns_match_set(
            ["l_orderkey", "l_quantity"], exact_match=False, group="schema", description="keys"
        ),
        tv.columns_match_set(["l_orderkey", "l_quantity"], group="schema", description="all"),
        tv.not_null("l_orderkey", group="nulls", description="order"),
        tv.not_null("l_quantity", group="nulls", description="quantity"),
        tv.not_null("l_tax", mostly=0.85, group="nulls", description="tax, mostly"),
        tv.between("l_extendedprice", 1000, 100000, group="ranges", description="price"),
        tv.between("l_tax", max_value=0.05, group="ranges", description="upper bound only"),
        tv.between("l_quantity", 2, 50, mostly=0.95, group="ranges", description="tolerated"),
        tv.in_set("l_returnflag", ["A", "N"], group="categorical", description="flag"),
        tv.in_set("l_linestatus", ["F", "O"], group="categorical", description="status"),
        tv.in_set("l_color", ["red"], description="no such column"),
        tv.row_count_between(1_000_000, 5_000_000, group="dataset", description="rows"),
        tv.row_count_between(min_value=1, group="dataset", description="some rows"),
        tv.column_count_equals(11, group="dataset", description="columns"),
    ]


def _lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.LINEITEM.frame(spark, folder)


def _listed(df: DataFrame, name: str) -> DataFrame:
    """An array of names shown as one text."""
    return df.withColumn(name, F.array_join(name, ","))


# Scans and overview


def table_shapes(spark, folder):
    """Every table: rows and columns."""
    shapes = []
    for name in inputs.TABLES:
        table = tv.read_table(spark, f"{folder}/{name}.parquet")
        shape = tv.overview(table, name).select("dataset_name", "row_count", "column_count")
        shapes.append(shape)
    return reduce(DataFrame.unionByName, shapes)


def overview(spark, folder):
    frame = tv.overview(_lineitem(spark, folder), "lineitem", run_time())
    return _listed(frame, "columns").drop("profiled_at")


def column_types(spark, folder):
    return tv.column_types(_lineitem(spark, folder))


def nested_column_types(spark, folder):
    return tv.column_types(inputs.EMBEDDINGS.frame(spark, folder))


def text_column_sizes(spark, folder):
    return tv.column_types(inputs.DOCUMENTS.frame(spark, folder))


def first_rows(spark, folder):
    return tv.first_rows(inputs.ORDERS.frame(spark, folder), 5, ["o_orderkey"])


# Nulls


def null_profile(spark, folder):
    return tv.null_profile(_lineitem(spark, folder))


def null_profile_events(spark, folder):
    return tv.null_profile(inputs.EVENTS.frame(spark, folder))


def null_summary(spark, folder):
    return tv.null_summary(null_profile(spark, folder))


def columns_with_nulls(spark, folder):
    return tv.columns_with_nulls(null_profile(spark, folder))


def null_profile_by_day(spark, folder):
    return tv.null_profile(inputs.DAILY.frame(spark, folder), by=["day"])


def null_summary_by_flag(spark, folder):
    """Rows without a flag are a group."""
    by = ["l_returnflag", "l_linestatus"]
    return tv.null_summary(tv.null_profile(_lineitem(spark, folder), by=by), by=by)


# Duplicates


def duplicate_profile(spark, folder):
    documents = inputs.DOCUMENTS.frame(spark, folder)
    profile = tv.duplicate_profile(documents, ["lang", "n_chars", "missing"])
    return _listed(profile, "key_columns_checked")


def duplicate_profile_clean(spark, folder):
    events = inputs.EVENTS.frame(spark, folder)
    return _listed(tv.duplicate_profile(events, ["event_id"]), "key_columns_checked")


def key_duplicates(spark, folder):
    return tv.key_duplicates(inputs.EVENTS.frame(spark, folder), KEYS)


def key_duplicates_absent(spark, folder):
    """Keys that partly exist, and no keys at all."""
    events = inputs.EVENTS.frame(spark, folder)
    return tv.key_duplicates(events, ["event_type", "no_such_column"]).unionAll(
        tv.key_duplicates(events, [])
    )


def shifted_duplicates(spark, folder):
    """Rows that differ only in where a missing value stands."""
    profile = tv.duplicate_profile(inputs.SHIFTED.frame(spark, folder), ["a"])
    return _listed(profile, "key_columns_checked")


# Outliers


def outlier_profile(spark, folder):
    return tv.outlier_profile(_lineitem(spark, folder), OUTLIER_COLUMNS)


def outlier_profile_all_numeric(spark, folder):
    return tv.outlier_profile(_lineitem(spark, folder))


def outlier_profile_events(spark, folder):
    return tv.outlier_profile(inputs.EVENTS.frame(spark, folder), ["value"])


def outlier_profile_infinite(spark, folder):
    return tv.outlier_profile(inputs.SIGNED.frame(spark, folder), ["endless"])


def outlier_profile_by_flag(spark, folder):
    return tv.outlier_profile(_lineitem(spark, folder), OUTLIER_COLUMNS, by=["l_returnflag"])


def outlier_profile_by_day(spark, folder):
    return tv.outlier_profile(inputs.DAILY.frame(spark, folder), ["l_extendedprice"], by=["day"])


def outlier_profile_exact(spark, folder):
    """Whole numbers and decimals that doubles cannot tell apart."""
    return tv.outlier_profile(inputs.LARGE.frame(spark, folder), ["price", "far_key"])


def quantile_profile(spark, folder):
    large = inputs.LARGE.frame(spark, folder)
    return tv.quantile_profile(large, large.columns, [0.0, 0.25, 0.5, 0.75, 1.0]).drop("value")


def outlier_summary(spark, folder):
    return tv.outlier_summary(outlier_profile(spark, folder))


def severe_outliers(spark, folder):
    return tv.severe_outliers(outlier_profile_events(spark, folder))


# Rules


def rule_profile(spark, folder):
    return tv.rule_profile(inputs.SHIPMENTS.frame(spark, folder), shipment_rules())


def rule_profile_orders(spark, folder):
    """A missing date violates the expected year."""
    orders = inputs.ORDERS.frame(spark, folder)
    return tv.rule_profile(
        orders, [expected_year("o_orderdate", 1998), positive("o_totalprice")]
    )


def rule_profile_customer(spark, folder):
    return tv.rule_profile(inputs.CUSTOMER.frame(spark, folder), [non_negative("c_acctbal")])


def rule_profile_part(spark, folder):
    return tv.rule_profile(inputs.PART.frame(spark, folder), [in_range("p_size", 1, 40)])


def rule_profile_by_day(spark, folder):
    shipments = inputs.SHIPMENTS.frame(spark, folder).withColumn("day", F.to_date("l_shipdate"))
    return tv.rule_profile(shipments, shipment_rules(), by=["day"])


def rule_summary(spark, folder):
    return tv.rule_summary(rule_profile(spark, folder))


def failed_rules(spark, folder):
    return tv.failed_rules(rule_profile(spark, folder))


def exploration_checks(spark, folder):
    return tv.violation_counts(inputs.TRIPS.frame(spark, folder), taxi.exploration_checks())


# Health


def health_score(spark, folder):
    shipments = inputs.SHIPMENTS.frame(spark, folder)
    return tv.health_score(tv.null_profile(shipments), tv.rule_profile(shipments, shipment_rules()))


def health_score_by_status(spark, folder):
    shipments = inputs.SHIPMENTS.frame(spark, folder)
    by = ["l_linestatus"]
    nulls = tv.null_profile(shipments, by=by)
    return tv.health_score(nulls, tv.rule_profile(shipments, shipment_rules(), by=by), by=by)


def health_score_without_rules(spark, folder):
    lineitem = _lineitem(spark, folder)
    return tv.health_score(tv.null_profile(lineitem), tv.rule_profile(lineitem, []))


# Expectations


def _validated(*expectations):
    def query(spark, folder):
        suite = [e() for e in expectations]
        return tv.validate(_lineitem(spark, folder), suite)

    return query


def expect_mostly(spark, folder):
    suite = [tv.between("p_size", 1, 48, mostly=0.95), tv.between("p_size", 1, 48)]
    return tv.validate(inputs.PART.frame(spark, folder), suite)


def validation_results(spark, folder):
    return tv.validate(_lineitem(spark, folder), lineitem_suite())


def validation_by_day(spark, folder):
    return tv.validate(inputs.DAILY.frame(spark, folder), lineitem_suite(), by=["day"])


def validation_summary_by_flag(spark, folder):
    results = tv.validate(_lineitem(spark, folder), lineitem_suite(), by=["l_returnflag"])
    return tv.validation_summary(results, run_time(), by=["l_returnflag"]).drop("validated_at")


def validation_summary(spark, folder):
    summary = tv.validation_summary(validation_results(spark, folder), run_time())
    return summary.drop("validated_at")


def failed_details(spark, folder):
    return tv.failed_details(validation_results(spark, folder))


# Exploration


def describe(spark, folder):
    return tv.describe(_lineitem(spark, folder))


def describe_orders(spark, folder):
    return tv.describe(inputs.ORDERS.frame(spark, folder))


def describe_decimals(spark, folder):
    return tv.describe(inputs.LARGE.frame(spark, folder).select("price", "key"))


def describe_timestamps(spark, folder):
    return tv.describe_timestamps(inputs.ORDERS.frame(spark, folder))


def describe_event_times(spark, folder):
    return tv.describe_timestamps(inputs.EVENTS.frame(spark, folder))


def value_counts(spark, folder):
    columns = ["l_returnflag", "l_linenumber", "l_missing"]
    return tv.value_counts(_lineitem(spark, folder), columns)


def value_counts_signed_zero(spark, folder):
    return tv.value_counts(inputs.SIGNED.frame(spark, folder), ["zero"])


# Taxi preset


def taxi_rules(spark, folder):
    return tv.rule_profile(inputs.TRIPS.frame(spark, folder), taxi.rules())


def taxi_validation(spark, folder):
    return tv.validate(inputs.TRIPS.frame(spark, folder), taxi.suite())


def taxi_outliers(spark, folder):
    return tv.outlier_profile(inputs.TRIPS.frame(spark, folder), taxi.OUTLIER_COLUMNS)


def taxi_duplicates(spark, folder):
    trips = inputs.TRIPS.frame(spark, folder)
    return _listed(tv.duplicate_profile(trips, taxi.KEY_COLUMNS), "key_columns_checked")


def taxi_value_counts(spark, folder):
    return tv.value_counts(inputs.TRIPS.frame(spark, folder), taxi.CATEGORIES)


def taxi_monitor(spark: SparkSession, folder: str, path: str | None = None):
    return tv.monitor_table(
        inputs.TRIPS.frame(spark, folder),
        "trips",
        suite=taxi.suite(),
        reports=path,
        run_at=run_time(),
        numeric=taxi.OUTLIER_COLUMNS,
        key_columns=taxi.KEY_COLUMNS,
        rules=taxi.rules(),
    )


def taxi_health(spark, folder):
    return taxi_monitor(spark, folder).profile.health


# Findings, reports, explanations


def run_times(spark, folder):
    """The times that a run with a given time puts on its sections."""
    run = taxi_monitor(spark, folder)
    profiled = run.profile.overview.select(F.col("profiled_at").cast("timestamp_ntz"))
    validated = run.validation.validation_summary.select(
        F.col("validated_at").cast("timestamp_ntz").alias("profiled_at")
    )
    return profiled.unionAll(validated).withColumnRenamed("profiled_at", "run_at")


def findings(spark, folder):
    return taxi_monitor(spark, folder).findings()


def findings_text(spark, folder):
    return taxi_monitor(spark, folder).findings_text()


def _report_folder(spark: SparkSession) -> str:
    """A new folder that all executors reach: below spark.checkpoint.dir, else the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
    return f"{root.rstrip('/')}/reports-{uuid.uuid4()}"


def saved_profile(spark, folder):
    """The rule section of a profile report, saved and loaded again."""
    path = _report_folder(spark)
    trips = inputs.TRIPS.frame(spark, folder)
    tv.profile_and_save(
        trips, "trips", path, numeric=[], rules=taxi.rules(), key_columns=["VendorID"]
    )
    report = tv.load_latest_report(spark, path, reports.PROFILE, "trips")
    return report.select("dataset", F.inline("business_rules.by_rule"))


def saved_validation(spark, folder):
    """The failures in a validation report, saved and loaded again."""
    path = _report_folder(spark)
    tv.validate_and_save(_lineitem(spark, folder), "lineitem", lineitem_suite(), path)
    report = tv.load_latest_report(spark, path, reports.VALIDATION, "lineitem")
    return report.select("dataset", "success_pct", F.inline("failed_details"))


def saved_explanations(spark, folder):
    """Parsed answers, saved and loaded again."""
    path = _report_folder(spark)
    answers = inputs.ANSWERS.frame(spark, folder).select(
        F.col("event_id").cast("string").alias("dataset"), run_time().alias("run_ts"), "response"
    )
    tv.save_explanations(answers, path)
    loaded = tv.read_reports(spark, path, reports.EXPLANATIONS)
    return tv.issue_counts(loaded, ["dataset", "answer", "overall_assessment", "parse_error"])


def _merged_shipments(spark, folder):
    """The state of the shipments, merged from one state for each line status and flag."""
    path = _report_folder(spark)
    shipments = inputs.SHIPMENTS.frame(spark, folder)
    checks = {"rules": shipment_rules(), "suite": lineitem_suite()}
    for flag in "ANR":
        part = shipments.where(F.col("l_returnflag") == flag)
        tv.save_state(part, "shipments", flag, path, **checks)
    return tv.merged_state(spark, "shipments", path, **checks)


def merged_null_profile(spark, folder):
    return _merged_shipments(spark, folder).null_profile()


def merged_rule_profile(spark, folder):
    return _merged_shipments(spark, folder).rule_profile()


def merged_moments(spark, folder):
    """Count, mean, deviation and range out of merged states."""
    return _merged_shipments(spark, folder).describe().drop("p25", "p50", "p75")


def latest_findings_text(spark, folder):
    """The same text as of the run itself, from its saved reports."""
    path = _report_folder(spark)
    taxi_monitor(spark, folder, path)
    return tv.latest_findings_text(spark, path)


def latest_report(spark, folder):
    return tv.latest(inputs.HISTORY.frame(spark, folder))


def parse_explanations(spark, folder):
    parsed = tv.parse_explanations(inputs.ANSWERS.frame(spark, folder))
    return parsed.select("event_id", "overall_assessment", "raw_response", "parse_error")


def parse_chats(spark, folder):
    parsed = tv.parse_explanations(inputs.CHATS.frame(spark, folder))
    return parsed.select("conv_id", "turn", "raw_response", "parse_error")


def parse_mixed(spark, folder):
    """Answers whose explanations are no list, or a list with other things than objects."""
    parsed = tv.parse_explanations(inputs.MIXED_ANSWERS.frame(spark, folder))
    return tv.issue_counts(parsed, ["event_id", "answer", "overall_assessment", "parse_error"])


def mixed_issues(spark, folder):
    parsed = tv.parse_explanations(inputs.MIXED_ANSWERS.frame(spark, folder))
    return tv.issues(parsed, ["event_id"])


def issues(spark, folder):
    return tv.issues(tv.parse_explanations(inputs.ANSWERS.frame(spark, folder)), ["event_id"])


def issue_counts(spark, folder):
    return tv.issue_counts(tv.parse_explanations(inputs.ANSWERS.frame(spark, folder)), ["event_id"])


QUERIES = {
    q.__name__: q
    for q in (
        table_shapes,
        overview,
        column_types,
        nested_column_types,
        text_column_sizes,
        first_rows,
        null_profile,
        null_profile_events,
        null_summary,
        columns_with_nulls,
        null_profile_by_day,
        null_summary_by_flag,
        duplicate_profile,
        duplicate_profile_clean,
        key_duplicates,
        key_duplicates_absent,
        shifted_duplicates,
        outlier_profile,
        outlier_profile_infinite,
        outlier_profile_all_numeric,
        outlier_profile_events,
        outlier_profile_by_flag,
        outlier_profile_by_day,
        outlier_profile_exact,
        quantile_profile,
        outlier_summary,
        severe_outliers,
        rule_profile,
        rule_profile_orders,
        rule_profile_customer,
        rule_profile_part,
        rule_profile_by_day,
        rule_summary,
        failed_rules,
        exploration_checks,
        health_score,
        health_score_by_status,
        health_score_without_rules,
        expect_mostly,
        validation_results,
        validation_by_day,
        validation_summary_by_flag,
        validation_summary,
        failed_details,
        describe,
        describe_orders,
        describe_decimals,
        describe_timestamps,
        describe_event_times,
        value_counts,
        value_counts_signed_zero,
        taxi_rules,
        taxi_validation,
        taxi_outliers,
        taxi_duplicates,
        taxi_value_counts,
        taxi_health,
        run_times,
        findings,
        findings_text,
        saved_profile,
        saved_validation,
        saved_explanations,
        merged_null_profile,
        merged_rule_profile,
        merged_moments,
        latest_findings_text,
        latest_report,
        parse_explanations,
        parse_chats,
        parse_mixed,
        mixed_issues,
        issues,
        issue_counts,
    )
} | {
    "expect_columns": _validated(
        lambda: tv.columns_match_set(["l_orderkey", "l_tax"], exact_match=False),
        lambda: tv.columns_match_set(["l_orderkey", "l_color"], exact_match=False),
        lambda: tv.column_count_equals(11),
    ),
    "expect_not_null": _validated(
        lambda: tv.not_null("l_quantity"), lambda: tv.not_null("l_orderkey")
    ),
    "expect_between": _validated(
        lambda: tv.between("l_extendedprice", 1000, 100000), lambda: tv.between("l_tax", 0, 0.05)
    ),
    "expect_in_set": _validated(
        lambda: tv.in_set("l_returnflag", ["A", "N"]), lambda: tv.in_set("l_linestatus", ["F", "O"])
    ),
    "expect_in_set_with_none": _validated(lambda: tv.in_set("l_returnflag", ["A", None])),
    "expect_row_count": _validated(
        lambda: tv.row_count_between(1_000_000, 5_000_000), lambda: tv.row_count_between(1)
    ),
}
