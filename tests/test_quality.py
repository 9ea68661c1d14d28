import json

import pytest

from tidemark.operators import quality
from tidemark.sources.tables import write_quality_report


@pytest.fixture
def checks(spark):
    def build(*rows):
        return quality.evaluate(spark.createDataFrame(list(rows), quality.CHECK_SCHEMA))

    return build


@pytest.mark.parametrize(
    "measured, threshold, higher, passed",
    [
        (0.95, 0.90, True, True),
        (0.90, 0.90, True, True),
        (0.89, 0.90, True, False),
        (110.0, 120.0, False, True),
        (120.0, 120.0, False, True),
        (121.0, 120.0, False, False),
        (None, 1.0, True, False),
    ],
)
def test_threshold_is_inclusive_in_both_directions(checks, measured, threshold, higher, passed):
    assert checks(("timeliness", "c", measured, threshold, higher, "")).first().passed is passed


def test_score_per_dimension_and_overall(checks):
    report = checks(
        ("completeness", "a", 1.0, 1.0, True, ""),
        ("completeness", "b", 0.0, 1.0, True, ""),
        ("validity", "c", 1.0, 1.0, True, ""),
    )
    assert {r.dimension: r.score for r in quality.score(report).collect()} == {
        "completeness": 0.5,
        "validity": 1.0,
        "overall": 0.6667,
    }


def test_empty_report_scores_zero(checks):
    assert [tuple(r) for r in quality.score(checks()).collect()] == [("overall", 0.0)]


def test_failures_are_named_and_passes_are_not(checks):
    report = checks(
        ("correctness", "ok_check", 1.0, 1.0, True, ""),
        ("correctness", "broken_check", 0.2, 0.9, True, "rows lost between stages"),
    )
    assert [r.name for r in quality.failed_checks(report).collect()] == ["broken_check"]
    with pytest.raises(quality.QualityFailure) as raised:
        quality.assert_all_passed(report, "my-run")
    assert str(raised.value) == "my-run: 1 of 2 quality checks failed (correctness 1)"
    assert [tuple(r) for r in quality.failure_counts(report).collect()] == [("correctness", 1, 2)]


def test_failures_point_to_where_they_are_stored(checks):
    report = checks(*[("validity", f"c{i}", 0.0, 1.0, True, "") for i in range(300)])
    with pytest.raises(quality.QualityFailure, match="300 of 300 .*validity 300.*are in s3a://b/report/checks"):
        quality.assert_all_passed(report, "run", stored="s3a://b/report/checks")


def test_all_passed_is_silent(checks):
    quality.assert_all_passed(checks(("consistency", "same", 1.0, 1.0, True, "")), "run")


def test_report_records_what_was_measured(checks, tmp_path):
    report = checks(("correctness", "dedup_rate", 0.081, 0.005, False, "delta"))
    write_quality_report(report, str(tmp_path), "run")

    def lines(name):
        return [json.loads(x) for f in (tmp_path / name).glob("*.json") for x in f.read_text().splitlines()]

    (check,) = lines("checks")
    assert (check["pipeline"], check["measured"], check["threshold"], check["passed"]) == ("run", 0.081, 0.005, False)
    assert check["generated_at"] and check["detail"] == "delta"
    assert {r["dimension"]: r["score"] for r in lines("score")} == {"correctness": 0.0, "overall": 0.0}
