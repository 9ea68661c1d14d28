"""Each defect class is caught by its gate, and only by that one."""

from datetime import datetime

import pytest
from conftest import event
from pyspark.sql import functions as F

from tidemark.operators import gates

ALL = ("cust_000001", "cust_000002")


@pytest.fixture
def card(events, known):
    def run(rows, customers=ALL, **options):
        frame = gates.gate_scorecard(events(rows), known(*customers), **options)
        return {(r.batch, r.gate): (r.passed, r.detail) for r in frame.collect()}

    return run


def failed(card):
    return sorted(k for k, (passed, _) in card.items() if not passed)


def test_clean_batch_passes_every_gate_in_order(events, known):
    rows = [event(event_id=f"e{i}") for i in range(10)]
    got = gates.gate_scorecard(events(rows), known("cust_000001")).orderBy("seq").collect()
    assert [r.gate for r in got] == list(gates.GATES)
    assert all(r.passed for r in got)
    assert got[4].detail == "no prior month to compare"


def test_missing_required_fields_are_listed_in_field_order(card):
    rows = [
        event(event_id="e1"),
        event(event_id=None, event_type=None, segment_at_event=None, customer_id="cust_000002"),
    ]
    got = card(rows)
    assert failed(got) == [("2024-01", "required_fields")]
    assert got["2024-01", "required_fields"][1] == (
        "null/missing: {'event_id': 1, 'event_type': 1, 'segment_at_event': 1}"
    )


def test_absent_column_fails_required_fields(events, known):
    frame = events([event()]).drop("event_type")
    got = gates.gate_scorecard(frame, known(*ALL)).where("gate = 'required_fields'").first()
    assert not got.passed
    assert got.detail == "null/missing: {'event_type': 'column absent'}"


def test_text_that_is_no_timestamp_fails_required_fields_instead_of_the_job(card):
    got = card([event(), event(event_id="e2", ts="yesterday")])
    assert failed(got) == [("2024-01", "required_fields")]
    assert "not a timestamp in 1" in got["2024-01", "required_fields"][1]


def test_duplicate_event_id(card):
    got = card([event(event_id="d"), event(event_id="d", customer_id="cust_000002"), event(event_id="x")])
    assert failed(got) == [("2024-01", "duplicates")]
    assert got["2024-01", "duplicates"][1] == "1 duplicate event_id(s)"


def test_two_null_ids_count_as_one_distinct_value(card):
    got = card([event(event_id=None), event(event_id=None), event(event_id="x")])
    assert got["2024-01", "duplicates"] == (False, "1 duplicate event_id(s)")


def test_the_same_id_in_two_batches_is_no_duplicate(card):
    got = card([event(), event(batch="2024-02", ts="2024-02-01T00:00:00Z")])
    assert failed(got) == []


def test_unknown_customer(card):
    got = card([event(customer_id="cust_unknown"), event(event_id="e2")])
    assert failed(got) == [("2024-01", "referential_integrity")]
    assert got["2024-01", "referential_integrity"][1] == "1 events reference unknown customers"


def test_null_customer_is_no_orphan_and_an_empty_list_knows_nobody(card, spark, known, events):
    got = card([event(customer_id=None), event(event_id="e2")])
    assert failed(got) == [("2024-01", "required_fields")]
    got = card([event(), event(event_id="e2", customer_id=None)], customers=())
    assert got["2024-01", "referential_integrity"][1] == "1 events reference unknown customers"


def test_repeated_known_customers_do_not_multiply_events(card):
    got = card([event(customer_id="cust_unknown"), event(event_id="e2")], customers=ALL + ALL)
    assert got["2024-01", "referential_integrity"][1] == "1 events reference unknown customers"
    assert got["2024-01", "duplicates"][0]


def test_negative_amount_is_reported_before_unknown_segment(card):
    got = card([event(amount_cents=-500), event(event_id="e2", segment_at_event="vip")])
    assert failed(got) == [("2024-01", "range_outliers")]
    assert got["2024-01", "range_outliers"][1] == "1 events with negative amount_cents"


def test_unknown_segment_fails_and_null_amount_passes(card):
    got = card([event(segment_at_event="vip")])
    assert got["2024-01", "range_outliers"][1] == "1 events with an unknown segment value"
    got = card([event(amount_cents=None), event(event_id="e2", segment_at_event="dormant")])
    assert failed(got) == []


def test_future_timestamps_only_when_asked_for(card):
    rows = [event(ts="2024-01-31T00:00:00Z")]
    assert failed(card(rows)) == []
    got = card(rows, as_of=F.lit("2024-01-30T00:00:00Z").cast("timestamp"))
    assert failed(got) == [("2024-01", "range_outliers")]


def test_drift_against_given_prior_counts(card, spark):
    prior = spark.createDataFrame([("mass", 10), ("affluent", 90)], "segment_at_event string, n bigint")
    got = card([event(event_id=f"e{i}") for i in range(100)], prior_counts=prior)
    assert failed(got) == [("2024-01", "cardinality_drift")]
    assert got["2024-01", "cardinality_drift"][1] == "mass share drifted 90.0%"


def month(batch, mass, affluent, other=0):
    day = f"{batch}-02T00:00:00Z"
    names = ["mass"] * mass + ["affluent"] * affluent + ["vip"] * other
    return [event(batch=batch, event_id=f"{batch}-{i}", segment_at_event=s, ts=day) for i, s in enumerate(names)]


@pytest.mark.parametrize("mass, passes", [(8, True), (9, False)])
def test_drift_limit_is_strict_and_compares_neighbouring_batches(card, mass, passes):
    # 0.5 -> 0.8 is a change of 0.30000000000000004 as doubles; the gate sees what Python sees.
    rows = month("2024-01", 5, 5) + month("2024-02", mass, 10 - mass)
    got = card(rows, max_change=0.31)
    assert got["2024-02", "cardinality_drift"][0] is passes


def test_a_blocked_month_is_still_the_next_ones_baseline(card):
    rows = month("2024-01", 10, 0) + month("2024-02", 0, 10) + month("2024-03", 0, 10)
    assert failed(card(rows)) == [("2024-02", "cardinality_drift")]


def test_unknown_segments_count_in_the_total_but_never_drift_themselves(card):
    rows = month("2024-01", 10, 0) + month("2024-02", 8, 0, other=2)
    assert failed(card(rows)) == [("2024-02", "range_outliers")]


def test_freshness(card):
    got = card([event(ts="2023-06-01T00:00:00+00:00")])
    assert failed(got) == [("2024-01", "freshness")]
    assert got["2024-01", "freshness"][1] == "no events found for expected month 2024-01"


def test_month_boundaries_are_utc_and_half_open(card):
    first, last = "2024-01-01T00:00:00+00:00", "2024-01-31T23:59:59.999999+00:00"
    for ts in (first, last):
        assert failed(card([event(ts=ts)])) == []
    for ts in ("2023-12-31T23:59:59+00:00", "2024-02-01T00:00:00+00:00", "2024-01-01T00:30:00+01:00"):
        assert failed(card([event(ts=ts)])) == [("2024-01", "freshness")]


def test_manifest_counts_months_across_the_year_end(events):
    batches = events([event(batch=f"month={n:02d}") for n in (0, 11, 12, 23)])
    got = {r.batch: str(r.period_start) for r in gates.month_manifest(batches, start="2024-01").collect()}
    assert got == {
        "month=00": "2024-01-01",
        "month=11": "2024-12-01",
        "month=12": "2025-01-01",
        "month=23": "2025-12-01",
    }


def test_expected_batch_without_rows_fails_freshness(card, spark):
    manifest = spark.createDataFrame([("2024-01", datetime(2024, 1, 1).date()), ("2024-02", datetime(2024, 2, 1).date())], "batch string, period_start date")
    got = card([event()], manifest=manifest)
    assert got["2024-02", "freshness"] == (False, "no events found for expected month 2024-02")
    assert got["2024-01", "freshness"][0]


def test_empty_bronze_has_no_scorecard(card):
    assert card([]) == {}


def test_alert_lists_the_failed_gates_in_order(events, known):
    rows = [event(event_id="d", amount_cents=-1), event(event_id="d"), event(batch="2024-02", ts="2024-02-01T00:00:00Z")]
    scorecard = gates.gate_scorecard(events(rows), known(*ALL))
    (alert,) = gates.gate_alerts(scorecard).collect()
    assert alert.failed_gates == ["duplicates", "range_outliers"]
    assert alert.message == (
        "Quality gate blocked promotion of 2024-01: duplicates: 1 duplicate event_id(s); "
        "range_outliers: 1 events with negative amount_cents"
    )
    assert [r.batch for r in gates.promoted_batches(scorecard).collect()] == ["2024-02"]
    assert gates.promoted_rows(events(rows), scorecard).count() == 1


def test_orphans_and_duplicate_keys(events, known):
    rows = [event(customer_id="x"), event(event_id="e2", customer_id="x"), event(event_id="e2"), event(customer_id=None)]
    assert [tuple(r) for r in gates.orphans(events(rows), known(*ALL)).collect()] == [("x", 2)]
    got = {r.event_id: r.n_surplus for r in gates.duplicate_keys(events(rows), ["event_id"]).collect()}
    assert got == {"ev-7": 1, "e2": 1}
