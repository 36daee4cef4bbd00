import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tabvitals as tv
from tabvitals.operators.rules import positive
from tabvitals.sources import reports


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(40).selectExpr(
        "id", "IF(id = 7, NULL, id * 1.5D) AS x", "IF(id = 39, 1e6D, CAST(id AS DOUBLE)) AS y"
    )


def _at(day):
    return F.lit(dt.datetime(2024, 1, day))


def _run(table, name, day=1, path=None, upper=10):
    return tv.monitor_table(
        table,
        name,
        [tv.between("x", 0, upper, description="small"), tv.not_null("id")],
        reports=path,
        run_at=_at(day),
        rules=[positive("id", name="id_positive")],
        key_columns=["id"],
    )


def _types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def _bare(data_type):
    """The type without nullability."""
    if isinstance(data_type, T.StructType):
        return [(f.name, _bare(f.dataType)) for f in data_type.fields]
    if isinstance(data_type, T.ArrayType):
        return ["array", _bare(data_type.elementType)]
    return data_type.simpleString()


def test_schemas_are_those_of_the_reports(spark, table):
    run = _run(table, "t")
    answers = spark.createDataFrame([("t", "x")], "dataset string, response string")
    explained = tv.parse_explanations(
        answers.select("dataset", _at(1).cast("timestamp").alias("run_ts"), "response")
    ).drop("response")
    frames = {
        reports.PROFILE: tv.profile_report(run.profile),
        reports.VALIDATION: tv.validation_report(run.validation),
        reports.EXPLANATIONS: explained,
    }
    for kind, frame in frames.items():
        assert _bare(frame.schema) == _bare(T.StructType.fromDDL(reports.SCHEMAS[kind])), kind


def test_sections_match_the_single_operators(table):
    run = _run(table, "t")
    profile = run.profile
    alone = {
        "nulls": tv.null_profile(table),
        "duplicates": tv.duplicate_profile(table, ["id"]),
        "outliers": tv.outlier_profile(table),
        "rules": tv.rule_profile(table, [positive("id", name="id_positive")]),
        "column_types": tv.column_types(table),
    }
    for name, frame in alone.items():
        section = getattr(profile, name).drop("dataset")
        assert sorted(map(str, section.collect())) == sorted(map(str, frame.collect())), name


def test_latest_report_of_each_dataset(spark, table, tmp_path):
    path = str(tmp_path / "reports")
    _run(table, "zebra", 3, path)
    _run(table, "apple", 1, path)
    newest = _run(table, "apple", 2, path, upper=1000)
    report = tv.load_latest_report(spark, path, reports.VALIDATION, "apple").first()
    assert (report.run_ts, report.passed, report.failed) == (dt.datetime(2024, 1, 2), 2, 0)
    texts = {r.dataset: r.findings_text for r in tv.latest_findings_text(spark, path).collect()}
    assert set(texts) == {"apple", "zebra"}
    assert texts["apple"] == newest.findings_text().first().findings_text
    assert "  FAILED: expect_column_values_to_be_between on [x]" in texts["zebra"]
    with pytest.raises(FileNotFoundError):
        tv.load_latest_report(spark, path, reports.VALIDATION, "unknown")
    with pytest.raises(FileNotFoundError):
        tv.read_reports(spark, path, reports.EXPLANATIONS)
    with pytest.raises(FileNotFoundError):
        tv.read_reports(spark, str(tmp_path / "nothing"), reports.PROFILE)


def test_saved_reports_keep_null_fields(spark, table, tmp_path):
    path = str(tmp_path / "reports")
    answers = spark.createDataFrame(
        [("t", dt.datetime(2024, 1, 1), "no JSON")], "dataset string, run_ts timestamp, response string"
    )
    tv.save_explanations(answers, path)
    line = spark.read.text(path).first().value
    assert '"explanations":null' in line and '"raw_response":"no JSON"' in line


def test_findings(table):
    rows = _run(table, "t").findings().collect()
    found = {(r.kind, r.name, r.column, r["count"]) for r in rows}
    assert found == {
        ("rule", "id_positive", "id", 1),
        ("outlier", "iqr_outliers", "y", 1),
        ("expectation", "expect_column_values_to_be_between", "x", 32),
    }


def test_findings_text_in_full(table):
    text = _run(table, "t").findings_text().first().findings_text
    assert text == TEXT


TEXT = """DATASET OVERVIEW
----------------
Name         : t
Rows         : 40
Columns      : 3
Profiled at  : 2024-01-01T00:00:00
Health score : 26.7 / 100  (Grade D)

NULL PROFILE
------------
Columns with nulls : 1
Total null cells   : 1

DUPLICATE PROFILE
-----------------
Full duplicates    : 0
Key-column dupes   : 0  (0.0%)

OUTLIER PROFILE (IQR method)
-----------------------------
Columns with severe outliers : 1
  y: 1 outliers (2.5%)  actual range [0.0 → 1000000.0]  expected [-19.5 → 58.5]

BUSINESS RULE VIOLATIONS
-------------------------
Rules checked : 1
Rules passed  : 0
Rules failed  : 1
  FAILED: id_positive
    Rule       : id > 0
    Violations : 1  (2.5%)
    Severity   : CRITICAL

GREAT EXPECTATIONS VALIDATION
------------------------------
Expectations run  : 2
Passed            : 1
Failed            : 1
Success rate      : 50.0%
  FAILED: expect_column_values_to_be_between on [x]
    Violations : 32  (82.05%)
    Rule desc  : small"""


def _history(spark, path, rows):
    """Saves one report per (dataset, time); the text of the answer tells them apart."""
    for i, (dataset, at) in enumerate(rows):
        answers = spark.createDataFrame([(dataset, at, f"answer {i}")], "dataset string, run_ts timestamp, response string")
        tv.save_explanations(answers, path)


def _files(path, day):
    return len(list(path.glob(f"kind=explanations/day={day}/*.json")))


def test_newest_report_is_looked_for_from_the_newest_day_on(spark, tmp_path, capsys):
    path = str(tmp_path / "reports")
    days = [dt.datetime(2024, 1, d, 23 * (d % 2)) for d in range(1, 8)]
    _history(spark, path, [("a", d) for d in days] + [("b", days[1]), ("b", days[0]), ("c", None)])
    assert tv.report_days(spark, path, reports.EXPLANATIONS) == [d.date() for d in reversed(days)]
    assert tv.report_days(spark, path, reports.PROFILE) == []
    for dataset, answer in (("a", "answer 6"), ("b", "answer 7"), ("c", "answer 9")):
        assert tv.load_latest_report(spark, path, reports.EXPLANATIONS, dataset).first().answer == answer
    newest = {r.dataset: r.answer for r in tv.load_latest_reports(spark, path, reports.EXPLANATIONS).collect()}
    assert newest == {"a": "answer 6", "b": "answer 7", "c": "answer 9"}
    with pytest.raises(FileNotFoundError):
        tv.load_latest_report(spark, path, reports.EXPLANATIONS, "d")
    windows = list(reports._newest_first(spark, path, reports.EXPLANATIONS))
    assert [w.count() for w in windows] == [1, 2, 6, 1]  # days 7; 6 and 5; 4 to 1; none
    windows[0].explain("formatted")
    filters = re.search(r"PartitionFilters: (.*)", capsys.readouterr().out)[1]
    assert "day" in filters and "2024-01-07" in filters


def test_days_do_not_depend_on_the_zone_of_the_session(spark, tmp_path):
    path = str(tmp_path / "reports")
    rows = [("a", dt.datetime(2024, 1, 1, 22)), ("a", dt.datetime(2024, 1, 2, 3))]
    for zone, row in zip(("America/Los_Angeles", "Asia/Tokyo"), rows, strict=True):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            _history(spark, path, [row])
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    found = tv.load_latest_report(spark, path, reports.EXPLANATIONS, "a").first()
    stored = tv.read_reports(spark, path, reports.EXPLANATIONS)
    assert found.run_ts == max(r.run_ts for r in stored.collect())


def test_compaction_keeps_all_reports(spark, tmp_path):
    path = tmp_path / "reports"
    _history(spark, str(path), [("a", dt.datetime(2024, 1, d, h)) for d in (1, 2, 3) for h in range(3)])
    before = sorted(map(str, tv.read_reports(spark, str(path), reports.EXPLANATIONS).collect()))
    assert [_files(path, f"2024-01-0{d}") for d in (1, 2, 3)] == [3, 3, 3]
    tv.compact_reports(spark, str(path), reports.EXPLANATIONS, dt.date(2024, 1, 2))
    assert [_files(path, f"2024-01-0{d}") for d in (1, 2, 3)] == [1, 1, 3]
    assert sorted(map(str, tv.read_reports(spark, str(path), reports.EXPLANATIONS).collect())) == before
    tv.compact_reports(spark, str(path), reports.EXPLANATIONS, dt.date(2023, 1, 1))  # nothing to do
    assert sorted(map(str, tv.read_reports(spark, str(path), reports.EXPLANATIONS).collect())) == before
