import pytest

import tabvitals as tv
from tabvitals.operators.explanations import LIST_ERROR, PARSE_ERROR

GOOD = '{"explanations": [{"issue": "a", "violation_count": 3}], "overall_assessment": "fine"}'


@pytest.fixture(scope="module")
def parsed(spark):
    def parse(*responses):
        rows = [(i, r) for i, r in enumerate(responses)]
        return tv.parse_explanations(spark.createDataFrame(rows, "id int, response string"))

    return parse


def test_accepted(parsed):
    responses = [
        GOOD,
        f"```json\n{GOOD}\n```",
        f"```\n{GOOD}```",
        f"　\n{GOOD}\x1c",
        f"```json{GOOD}``` and some more words",
        '{"a": 1, "a": 2}',
    ]
    rows = parsed(*responses).orderBy("id").collect()
    assert {r.parse_error for r in rows} == {None}
    assert {r.raw_response for r in rows} == {None}
    assert [r.overall_assessment for r in rows] == ["fine"] * 5 + [None]


def test_rejected(parsed):
    responses = [
        f"{GOOD} trailing",
        f"{GOOD}}}",
        '{"a":',
        "",
        "[1,2]",
        "null",
        "3",
        '"text"',
        "{'a': 1}",
        f"{GOOD},",
        f"{GOOD}], [{GOOD}",
        f"{GOOD}] x",
        f'{GOOD}}}, {{"x": 1',
        "```",
        None,
    ]
    rows = parsed(*responses).orderBy("id").collect()
    assert {r.parse_error for r in rows} == {PARSE_ERROR}
    assert [r.raw_response for r in rows[:-2]] == responses[:-2]
    counts = tv.issue_counts(parsed(*responses), ["id"]).collect()
    assert {r.issue_count for r in counts} == {0}
    assert tv.issues(parsed(*responses), ["id"]).count() == 0


def test_good_issues_of_bad_lists(parsed):
    responses = [
        '{"explanations":[{"issue":"a"},"oops",null,3,{"issue":"b"}],"overall_assessment":"x"}',
        '{"explanations":"none","overall_assessment":"x"}',
        '{"explanations":{"issue":"a"},"overall_assessment":"x"}',
        '{"explanations":null,"overall_assessment":"x"}',
        '{"overall_assessment":"x"}',
        '{"explanations":[],"overall_assessment":"x"}',
    ]
    rows = parsed(*responses).orderBy("id").collect()
    assert [r.parse_error for r in rows] == [LIST_ERROR] * 3 + [None] * 3
    assert {r.overall_assessment for r in rows} == {"x"}
    found = tv.issues(parsed(*responses), ["id"]).orderBy("id", "position").collect()
    assert [(r.id, r.issue) for r in found] == [(0, "a"), (0, "b")]


def test_answers_are_kept_whole(parsed):
    response = '{"notes": [1, {"x": 2}], "explanations": [{"issue": "a", "extra": true}]}'
    rows = parsed(response, f"```json\n{response}\n```").collect()
    assert [(r.answer, r.raw_response, r.parse_error) for r in rows] == [(response, None, None)] * 2


def test_defaults_of_missing_fields(parsed):
    response = (
        '{"explanations": [{"what_happened": "w"}, {"issue": "i", "column": "c", '
        '"severity": "info", "violation_count": "7"}, {"violation_count": 3.5}, '
        '{"violation_count": "many"}]}'
    )
    rows = tv.issues(parsed(response), ["id"]).orderBy("position").collect()
    assert [r.issue for r in rows] == ["Unknown", "i", "Unknown", "Unknown"]
    assert [r.column for r in rows] == ["N/A", "c", "N/A", "N/A"]
    assert [r.severity for r in rows] == ["N/A", "info", "N/A", "N/A"]
    assert [r.violation_count for r in rows] == [0, 7, 3, 0]
    assert [r.what_happened for r in rows] == ["w", "", "", ""]
    assert tv.issue_counts(parsed(response), ["id"]).first().issue_count == 4
