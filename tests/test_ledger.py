from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger

T0 = datetime(2024, 1, 1, 8)
RUNS = "run_id string, pipeline_id string, run_date string, bytes_processed bigint, duration_seconds double, recorded_at timestamp"
CHECKED = "run_id string, pipeline_id string, run_date string, duration_seconds double, checked_at timestamp"


@pytest.fixture
def no_alerts(spark):
    return spark.createDataFrame([], "alert_id string")


def test_one_gib_costs_exactly_the_rate(spark):
    runs = spark.createDataFrame([("r", "p", "2024-01-01", 1 << 30, 10.0, T0)], RUNS)
    row = ledger.record_runs(runs).first()
    assert (row.cost_key, row.cost_usd) == ("p#2024-01-01", 0.023)


def test_second_run_of_a_day_replaces_or_adds(spark):
    runs = spark.createDataFrame(
        [
            ("r1", "p", "2024-01-01", 3 << 30, 10.0, T0),
            ("r2", "p", "2024-01-01", 1 << 30, 10.0, T0 + timedelta(hours=1)),
            ("r3", "p", "2024-01-02", 1 << 30, 10.0, T0),
        ],
        RUNS,
    )
    rows = ledger.record_runs(runs)
    assert sorted(map(tuple, ledger.cost_by_pipeline(rows).collect())) == [
        ("p#2024-01-01", "2024-01-01", 0.023),
        ("p#2024-01-02", "2024-01-02", 0.023),
    ]
    total = {r.pipeline_id: r.cost_usd for r in ledger.total_cost_by_pipeline(rows).collect()}
    assert total["p#2024-01-01"] == 0.092


def test_shared_cost_is_split_by_bytes(spark):
    runs = spark.createDataFrame(
        [
            ("r1", "a", "d1", 100, 1.0, T0),
            ("r2", "a", "d1", 200, 1.0, T0),
            ("r3", "b", "d1", 100, 1.0, T0),
            ("r4", "a", "d2", 0, 1.0, T0),
            ("r5", "b", "d2", 0, 1.0, T0),
        ],
        RUNS,
    )
    got = {(r.run_date, r.pipeline_id): (r.share, r.cost_usd) for r in ledger.split_shared_cost(runs, F.lit(10.0)).collect()}
    assert got == {("d1", "a"): (0.75, 7.5), ("d1", "b"): (0.25, 2.5), ("d2", "a"): (0.5, 5.0), ("d2", "b"): (0.5, 5.0)}


def check(spark, rows, alerts, limit=60):
    result = ledger.check_sla(spark.createDataFrame(rows, CHECKED), alerts, limit)
    checks = {r.run_id: (r.breached, r.alert_sent, r.reason) for r in result.checks.collect()}
    return checks, sorted(map(tuple, result.new_alerts.collect()))


def test_at_the_limit_is_no_breach(spark, no_alerts):
    checks, alerts = check(spark, [("r", "p", "d", 60.0, T0), ("s", "p", "d", 30.0, T0)], no_alerts)
    assert checks == {"r": (False, None, None), "s": (False, None, None)}
    assert alerts == []


def test_first_breach_alerts_and_the_next_is_deduped(spark, no_alerts):
    rows = [("late", "p", "d", 125.0, T0 + timedelta(minutes=5)), ("first", "p", "d", 120.0, T0), ("x", "p", "d2", 61.5, T0)]
    checks, alerts = check(spark, rows, no_alerts)
    deduped = (True, False, "already alerted today (deduped)")
    assert checks == {"first": (True, True, None), "late": deduped, "x": (True, True, None)}
    assert alerts == [
        ("p#d", "SLA breach: p took 120s (limit 60s) on d"),
        ("p#d2", "SLA breach: p took 62s (limit 60s) on d2"),
    ]


def test_an_alert_in_the_ledger_keeps_later_checks_silent(spark):
    ledger_rows = spark.createDataFrame([("p#d",)], "alert_id string")
    checks, alerts = check(spark, [("r", "p", "d", 120.0, T0)], ledger_rows)
    assert checks["r"] == (True, False, "already alerted today (deduped)")
    assert alerts == []
    assert ledger.breach_count(ledger_rows).first().sla_breaches_recorded == 1


def run_check(spark, starts, ends, alerts, limit=180):
    result = ledger.check_run_sla(
        spark.createDataFrame(starts, "run_id string, started_at timestamp"),
        spark.createDataFrame(ends, "run_id string, ended_at timestamp"),
        alerts,
        limit,
    )
    return {r.run_id: tuple(r)[1:] for r in result.checks.collect()}, sorted(map(tuple, result.new_alerts.collect()))


def test_run_sla_counts_whole_epoch_seconds(spark, no_alerts):
    # 180.2 s apart, but 181 whole seconds by the clock; and the other way round.
    starts = [("a", T0 + timedelta(seconds=0.9)), ("b", T0 + timedelta(seconds=0.1)), ("c", T0)]
    ends = [("a", T0 + timedelta(seconds=181.1)), ("b", T0 + timedelta(seconds=180.9)), ("c", T0), ("d", T0)]
    checks, alerts = run_check(spark, starts, ends, no_alerts)
    assert checks == {
        "a": (181, True, True, None),
        "b": (180, False, None, None),
        "c": (0, False, None, None),
        "d": (None, False, None, "no start time recorded"),
    }
    assert alerts == [("a#sla", "SLA breach: run a took 181s (limit 180s)")]


def test_run_sla_alerts_once_per_run(spark):
    alerts = spark.createDataFrame([("a#sla",)], "alert_id string")
    checks, new = run_check(spark, [("a", T0)], [("a", T0 + timedelta(hours=1))], alerts)
    assert checks["a"] == (3600, True, False, None)
    assert new == []
