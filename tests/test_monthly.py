"""The monthly run end to end on written tables: promote, block, revoke, rebuild."""

import json
import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import __main__ as jobs
from tidemark.operators import gates, history, ledger, quality
from tidemark.plans.monthly import Warehouse, clean_batch, run_monthly
from tidemark.schemas import EVENT, GOLD, VALID_SEGMENTS, SchemaDrift
from tidemark.sources import tables
from tidemark.sources.bronze import batch_files, land_bronze, list_batches, read_bronze, read_json_events

CUSTOMERS = 30
TYPES = ("login", "card_txn", "offer_shown", "offer_redeemed")


def month_rows(n, month_start):
    """Each customer four times in the month; every ninth one moves on to the next segment each month."""
    rows = []
    for c in range(CUSTOMERS):
        moves = n if c % 9 == 4 else 0
        for week in range(4):
            kind = TYPES[(c + week) % 4]
            at = month_start + timedelta(weeks=week, hours=c)
            rows.append(
                {
                    "event_id": f"m{n}c{c}w{week}",
                    "customer_id": f"cust_{c:06d}",
                    "event_type": kind,
                    "segment_at_event": VALID_SEGMENTS[(2 * c + moves) % 5],
                    "amount_cents": 31 * c + week if kind == "card_txn" else None,
                    "ts": at.strftime("%Y-%m-%dT%H:%M:%SZ"),
                }
            )
    return rows


def write_months(folder, months):
    folder.mkdir(parents=True, exist_ok=True)
    for n, rows in months.items():
        (folder / f"month={n:02d}.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n")


@pytest.fixture
def months():
    starts = [datetime(2024, m, 1, tzinfo=timezone.utc) for m in (1, 2, 3)]
    return {n: month_rows(n, start) for n, start in enumerate(starts)}


@pytest.fixture
def run(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path / "wh"))
    known = jobs.customers_from(spark, str(CUSTOMERS))

    def go(months, **options):
        folder = tmp_path / f"in{random.random()}"
        write_months(folder, months)
        land_bronze(spark, str(folder), warehouse.bronze)
        return run_monthly(spark, warehouse, known, **options)

    go.warehouse = warehouse
    return go


def test_clean_run_then_a_seeded_defect_blocks_exactly_its_month(spark, run, months):
    first = run(months)
    assert first["promoted"] == ["month=00", "month=01", "month=02"]
    assert first["blocked"] == []
    assert all(m["silver_stats"]["reconciled"] for m in first["months"])
    assert first["sla"]["breached"] is False and first["sla"]["elapsed_seconds"] >= 0
    gold = {n: tables.read_gold(spark, run.warehouse.gold, n) for n in GOLD}
    assert gold["dim_customer"].count() == first["gold_rows_written"] > CUSTOMERS
    assert gold["fact_engagement_daily"].count() == first["fact_engagement_daily_rows_written"]
    assert gold["dim_offer"].count() == first["dim_offer_rows_written"] == 2
    total = sum(r["amount_cents"] or 0 for rows in months.values() for r in rows)
    assert gold["fact_engagement_daily"].agg(F.sum("total_amount_cents")).first()[0] == total
    assert history.overlap_audit(gold["dim_customer"]).isEmpty()
    assert history.current_row_audit(gold["dim_customer"], include_none=True).isEmpty()

    months[2][0]["amount_cents"] = -9999
    second = run(months)
    assert second["blocked"] == [{"month": "month=02", "failed_gates": ["range_outliers"]}]
    assert second["promoted"] == ["month=00", "month=01"]
    silver = tables.read_silver(spark, run.warehouse.silver)
    assert sorted(r.batch for r in silver.select("batch").distinct().collect()) == ["month=00", "month=01"]
    dim = tables.read_gold(spark, run.warehouse.gold, "dim_customer")
    assert dim.count() == second["gold_rows_written"] < first["gold_rows_written"]
    assert dim.where("valid_from >= '2024-03-01'").isEmpty()
    alert = tables.read_ledger(spark, run.warehouse.ops, "gate_alerts").collect()
    assert [(a.run_id, a.batch, a.failed_gates) for a in alert] == [(second["run_id"], "month=02", ["range_outliers"])]
    assert alert[0].message == (
        "Quality gate blocked promotion of month=02: range_outliers: 1 events with negative amount_cents"
    )

    report = quality.evaluate(
        spark.createDataFrame(
            [
                ("completeness", "months_reconcile", 3.0, 3.0, True, ""),
                ("validity", "blocked_month_has_no_silver", 0.0, 0.0, False, ""),
            ],
            quality.CHECK_SCHEMA,
        )
    )
    quality.assert_all_passed(report, "monthly")


def test_rerun_gives_the_same_history(spark, run, months):
    run(months)
    first = history.fingerprint(tables.read_gold(spark, run.warehouse.gold, "dim_customer")).first()
    run(months)
    assert history.fingerprint(tables.read_gold(spark, run.warehouse.gold, "dim_customer")).first() == first


def test_all_kinds_of_defects_block_their_months(spark, run, months):
    months[0][0]["event_id"] = None
    months[1][0]["event_id"] = months[1][1]["event_id"]
    months[2][0]["customer_id"] = "cust_unknown"
    got = {b["month"]: b["failed_gates"] for b in run(months)["blocked"]}
    assert got == {
        "month=00": ["required_fields"],
        "month=01": ["duplicates"],
        "month=02": ["referential_integrity"],
    }


def test_nothing_promoted_keeps_gold_or_empties_it(spark, run, months):
    rows = run(months)["gold_rows_written"]
    for batch in months.values():
        batch[0]["segment_at_event"] = "vip"
    again = run(months)
    assert again["promoted"] == [] and again["gold_rows_written"] == 0
    assert tables.read_gold(spark, run.warehouse.gold, "dim_customer").count() == rows
    run(months, on_none_promoted="empty")
    assert tables.read_gold(spark, run.warehouse.gold, "dim_customer").count() == 0
    with pytest.raises(ValueError):
        run_monthly(spark, run.warehouse, None, on_none_promoted="drop")


def test_months_after_the_first_year_can_be_fresh(spark, run):
    later = {12: month_rows(12, datetime(2025, 1, 1, tzinfo=timezone.utc))}
    assert run(later)["promoted"] == ["month=12"]


def test_sla_breach_is_alerted(spark, run, months):
    result = run(months, sla_seconds=-1, run_id="r1")
    assert result["sla"]["breached"] and result["sla"]["alert_sent"]
    assert [a.alert_id for a in tables.read_ledger(spark, run.warehouse.ops, "sla_alerts").collect()] == ["r1#sla"]


def test_clean_batch_replaces_both_zones_of_its_batch(spark, run, months, tmp_path):
    run(months)
    months[1][0]["event_type"] = None
    write_months(tmp_path / "fix", months)
    land_bronze(spark, str(tmp_path / "fix"), run.warehouse.bronze)
    stats = clean_batch(spark, run.warehouse, "month=01")
    assert (stats["bronze_rows"], stats["rejects"], stats["reconciled"]) == (120, 1, True)
    months[1][0]["event_type"] = "login"
    write_months(tmp_path / "fix2", months)
    land_bronze(spark, str(tmp_path / "fix2"), run.warehouse.bronze)
    assert clean_batch(spark, run.warehouse, "month=01")["rejects"] == 0
    silver = tables.read_silver(spark, run.warehouse.silver)
    assert {r.batch: r.n_rows for r in list_batches(silver).collect()} == dict.fromkeys(
        ("month=00", "month=01", "month=02"), 120
    )
    assert tables.read_silver(spark, run.warehouse.silver, "rejects").isEmpty()


def test_landing_needs_files_and_keeps_lines_that_do_not_parse(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        land_bronze(spark, str(tmp_path / "none"), str(tmp_path / "bronze"))
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "month=00.jsonl").write_text('{"event_id": "a", "ts": "2024-01-01T00:00:00Z"}\n{"event_id": \n')
    bronze = land_bronze(spark, str(folder), str(tmp_path / "bronze"))
    rows = {r.event_id: r for r in bronze.collect()}
    assert rows["a"].amount_cents is None and rows["a"].batch == "month=00"
    assert rows[None].corrupt_record == '{"event_id": '
    assert not gates.gate_scorecard(bronze, bronze.select("customer_id"), gates.month_manifest(bronze, start="2024-01")).where(
        "gate = 'required_fields'"
    ).first().passed


def test_a_month_landed_empty_loses_its_rows_and_is_blocked(spark, run, months):
    run(months)
    again = run({**months, 1: []})
    assert again["promoted"] == ["month=00", "month=02"]
    assert again["blocked"] == [{"month": "month=01", "failed_gates": ["freshness"]}]
    assert read_bronze(spark, run.warehouse.bronze).where("batch = 'month=01'").isEmpty()
    assert tables.read_silver(spark, run.warehouse.silver).where("batch = 'month=01'").isEmpty()


def test_a_run_without_bronze_promotes_nothing(spark, tmp_path):
    result = run_monthly(spark, Warehouse(str(tmp_path / "none")), jobs.customers_from(spark, "3"))
    assert (result["months"], result["promoted"], result["gold_rows_written"]) == ([], [], 0)


@pytest.mark.parametrize("amount", ["-500.5", '"-700"', "-99999999999999999999"])
def test_a_number_that_does_not_fit_blocks_its_month(spark, run, months, tmp_path, amount):
    line = json.dumps(months[0][0]).replace('"amount_cents": null', f'"amount_cents": {amount}')
    assert amount in line
    folder = tmp_path / "bad"
    write_months(folder, months)
    with (folder / "month=00.jsonl").open("a") as f:
        f.write(line.replace("m0c0w0", "other") + "\n")
    land_bronze(spark, str(folder), run.warehouse.bronze)
    result = run_monthly(spark, run.warehouse, jobs.customers_from(spark, str(CUSTOMERS)))
    assert {"month": "month=00", "failed_gates": ["required_fields"]} in result["blocked"]


def test_a_bare_time_is_no_timestamp(spark, run, months):
    months[2][5]["ts"] = "12:30"
    assert run(months)["blocked"] == [{"month": "month=02", "failed_gates": ["required_fields"]}]


def test_a_month_of_null_amounts_stays_a_number(spark, tmp_path):
    write_months(tmp_path, {0: [{"event_id": "a", "amount_cents": None, "ts": "2024-01-01T00:00:00Z"}]})
    frame = read_json_events(spark, str(tmp_path / "month=00.jsonl"))
    assert frame.schema["amount_cents"].dataType == EVENT["amount_cents"].dataType


def test_several_paths_are_read_in_one_pass(spark, tmp_path, months):
    write_months(tmp_path, months)
    paths = [str(tmp_path / f"month=0{n}.jsonl") for n in (0, 2)]
    got = {r.batch: r.n_rows for r in list_batches(read_json_events(spark, paths)).collect()}
    assert got == {"month=00": 120, "month=02": 120}


def test_gold_refuses_a_frame_off_its_contract(spark, tmp_path):
    with pytest.raises(SchemaDrift):
        tables.write_gold(spark.range(1), str(tmp_path), "dim_offer")


def test_views_and_catalog(spark, run, months, tmp_path):
    missing = tables.open_view(spark, str(tmp_path / "nowhere"), "dim_missing", GOLD["dim_customer"])
    assert missing.isEmpty()
    assert spark.sql("SELECT count_if(is_current) AS n FROM dim_missing").first().n == 0
    result = run(months)
    for _ in range(2):  # registering again must work
        names = tables.register_gold(spark, run.warehouse.gold, "gold_test")
    assert spark.table("gold_test.dim_customer").count() == result["gold_rows_written"]
    assert spark.table("gold_test.fact_engagement_daily").columns == GOLD["fact_engagement_daily"].names
    assert len(names) == 3
    tables.open_view(spark, tables.gold_path(spark, run.warehouse.gold, "dim_customer"), "dim_customer")
    assert spark.sql("SELECT segment, count(*) FILTER (WHERE is_current) FROM dim_customer GROUP BY segment").count() == 5
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    spark.sql("DROP DATABASE gold_test")


def test_gold_files_are_sorted_across_files(spark, run, months):
    run(months)
    path = tables.gold_path(spark, run.warehouse.gold, "fact_engagement_daily")
    stats = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_name"))
        .agg(F.min("customer_id").alias("lo"), F.max("customer_id").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert all(a.hi <= b.lo for a, b in zip(stats, stats[1:]))


def files_of(path):
    return {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_a_second_run_without_new_files_writes_no_silver(spark, run, months):
    known = jobs.customers_from(spark, str(CUSTOMERS))
    run(months)
    before = files_of(run.warehouse.silver)
    again = run_monthly(spark, run.warehouse, known)
    assert files_of(run.warehouse.silver) == before and len(before) > 0
    assert again["promoted"] == ["month=00", "month=01", "month=02"] and again["gold_rows_written"] > 0

    # One month changes: only its rows are written, the others stay where they are.
    state = {r.batch: r.run for r in tables.silver_state(spark, run.warehouse.silver).collect()}
    folder = Path(run.warehouse.root) / "again"
    write_months(folder, {1: months[1][:-1]})
    land_bronze(spark, str(folder), run.warehouse.bronze)
    run_monthly(spark, run.warehouse, known)
    now = {r.batch: r.run for r in tables.silver_state(spark, run.warehouse.silver).collect()}
    assert [b for b in now if now[b] != state[b]] == ["month=01"]
    new = set(files_of(run.warehouse.silver)) - set(before)
    assert new and all("batch=month%3D01" in str(f) for f in new)
    silver = tables.read_silver(spark, run.warehouse.silver)
    assert {r.batch: r.n_rows for r in list_batches(silver).collect()} == {"month=00": 120, "month=01": 119, "month=02": 120}


def test_a_batch_that_fails_now_vanishes_and_comes_back(spark, run, months):
    run(months)
    run_monthly(spark, run.warehouse, jobs.customers_from(spark, "20"))  # fewer known customers: no month passes
    assert tables.read_silver(spark, run.warehouse.silver).isEmpty()
    run_monthly(spark, run.warehouse, jobs.customers_from(spark, str(CUSTOMERS)))
    assert tables.read_silver(spark, run.warehouse.silver).count() == 360


def test_a_write_that_fails_leaves_the_old_table(spark, run, months):
    run(months)
    silver, gold, name = run.warehouse.silver, run.warehouse.gold, "dim_offer"
    broken = F.when(F.rand() >= 0, F.raise_error(F.lit("lost"))).otherwise("x")
    rows = tables.read_silver(spark, silver)
    with pytest.raises(Exception, match="lost"):
        tables.replace_silver(rows.withColumn("event_id", broken), silver, [("month=00", 1, 1, None)], ["month=01"])
    assert tables.read_silver(spark, silver).count() == 360

    offer = tables.read_gold(spark, gold, name)
    old = sorted(offer.collect())
    with pytest.raises(Exception, match="lost"):
        tables.write_gold(offer.withColumn("offer_id", broken), gold, name)
    assert sorted(tables.read_gold(spark, gold, name).collect()) == old != []
    # A table may be replaced from itself.
    assert tables.write_gold(tables.read_gold(spark, gold, name).limit(1), gold, name) == 1
    assert tables.write_gold(offer.limit(0), gold, name) == 0
    assert tables.read_gold(spark, gold, name).count() == 0
    # Only what was replaced is removed.
    before = {n: sorted(tables.read_gold(spark, gold, n).collect()) for n in GOLD}
    assert len(tables.remove_old_runs(spark, silver, gold, keep=1)) == 2
    assert {n: sorted(tables.read_gold(spark, gold, n).collect()) for n in GOLD} == before
    assert tables.read_silver(spark, silver).count() == 360
    assert tables.remove_old_runs(spark, silver, gold, keep=1) == []


def test_files_of_batches_with_odd_names(spark, tmp_path):
    rows = spark.range(3).select(F.element_at(F.array(*map(F.lit, ["a b+c", "x=1/2", "2024-01"])), (F.col("id") + 1).cast("int")).alias("batch"), "id")
    rows.write.partitionBy("batch").parquet(str(tmp_path / "t"))
    assert sorted(r.batch for r in batch_files(spark, str(tmp_path / "t")).collect()) == ["2024-01", "a b+c", "x=1/2"]
    assert batch_files(spark, str(tmp_path / "none")).isEmpty()


def test_jobs(spark, months, tmp_path, capsys):
    write_months(tmp_path / "in", months)
    root = ["--warehouse", str(tmp_path / "wh")]
    jobs.main([*root, "land", "--in", str(tmp_path / "in")], spark)
    jobs.main([*root, "run", "--customers", str(CUSTOMERS)], spark)
    out = capsys.readouterr().out
    assert '"promoted": [\n    "month=00",' in out
    jobs.main([*root, "clean-batch", "--batch", "month=01"], spark)
    jobs.main([*root, "gold"], spark)
    jobs.main([*root, "cohorts"], spark)
    jobs.main([*root, "costs"], spark)
    jobs.main([*root, "sla"], spark)
    out = capsys.readouterr().out
    assert "dim_offer: 2 rows" in out and "retention_pct" in out and "monthly#" in out and "breach" in out


def test_each_run_is_in_the_cost_ledger(spark, run, months):
    cost = run(months)["cost"]
    stored = sum(f.stat().st_size for f in Path(run.warehouse.bronze).rglob("*.parquet"))
    assert cost["bytes_processed"] == stored > 0
    run(months)
    rows = tables.read_ledger(spark, run.warehouse.ops, "pipeline_cost").collect()
    assert len(rows) == 2 and {r.pipeline_id for r in rows} == {"monthly"}
    assert len(ledger.cost_by_pipeline(tables.read_ledger(spark, run.warehouse.ops, "pipeline_cost")).collect()) == 1


def test_bronze_reader_declares_its_columns(spark, run, months):
    run(months)
    bronze = read_bronze(spark, run.warehouse.bronze)
    assert dict(bronze.dtypes)["batch"] == "string" and dict(bronze.dtypes)["event_ts"] == "timestamp"
