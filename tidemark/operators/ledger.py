"""Run cost ledger and SLA breaches with one alert per key.

Ledgers are append-only tables; a later row for the same key replaces the earlier
one when the ledger is read. "First" and "one alert" are exact while one writer at
a time appends, which is what the monthly run does.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import COST_PER_GIB, cost_usd, pair_key, whole_seconds
from tidemark.operators.lanes import first_per_key, latest_per_key

DEFAULT_SLA_SECONDS = 180


class SlaCheck(NamedTuple):
    checks: DataFrame
    new_alerts: DataFrame


def record_runs(runs: DataFrame, *, rate: float = COST_PER_GIB) -> DataFrame:
    """Cost rows of runs (pipeline_id, run_date, bytes_processed, duration_seconds, recorded_at)."""
    return runs.select(
        pair_key(F.col("pipeline_id"), F.col("run_date")).alias("cost_key"),
        "pipeline_id",
        "run_date",
        "bytes_processed",
        "duration_seconds",
        cost_usd(F.col("bytes_processed"), rate).alias("cost_usd"),
        "recorded_at",
    )


def latest_costs(ledger: DataFrame) -> DataFrame:
    """The ledger after upserts: the newest row of each pipeline-day."""
    return latest_per_key(ledger, ["cost_key"], [F.col("recorded_at")])


def cost_by_pipeline(ledger: DataFrame) -> DataFrame:
    """(pipeline_id, run_date, cost_usd), the newest run of a pipeline-day standing for it."""
    return latest_costs(ledger).select(F.col("cost_key").alias("pipeline_id"), "run_date", "cost_usd")


def total_cost_by_pipeline(ledger: DataFrame, *, rate: float = COST_PER_GIB) -> DataFrame:
    """As `cost_by_pipeline`, with all runs of the pipeline-day added up."""
    return (
        ledger.groupBy("cost_key", "run_date")
        .agg(F.sum("bytes_processed").alias("bytes"))
        .select(F.col("cost_key").alias("pipeline_id"), "run_date", cost_usd(F.col("bytes"), rate).alias("cost_usd"))
    )


def split_shared_cost(runs: DataFrame, shared_cost: Column) -> DataFrame:
    """Each pipeline's part of a day's shared cost, in proportion to its bytes.

    Runs are added up per pipeline-day first, so the day totals and the join see one
    row per pipeline and day. A day without any bytes is split evenly.
    """
    by_pipeline = runs.groupBy("run_date", "pipeline_id").agg(F.sum("bytes_processed").alias("bytes_processed"))
    by_day = by_pipeline.groupBy("run_date").agg(
        F.sum("bytes_processed").alias("_day_bytes"), F.count("*").alias("_pipelines")
    )
    share = F.when(
        F.col("_day_bytes") > 0, F.col("bytes_processed") / F.col("_day_bytes").cast("double")
    ).otherwise(1.0 / F.col("_pipelines"))
    return (
        by_pipeline.join(by_day, "run_date")
        .withColumn("share", F.round(share, 6))
        .withColumn("cost_usd", F.round(share * shared_cost, 6))
        .select("run_date", "pipeline_id", "bytes_processed", "share", "cost_usd")
    )


def _alert_once(breaches: DataFrame, alert_ledger: DataFrame, order_by: list[Column]) -> DataFrame:
    """First breach of each alert_id the ledger does not have yet."""
    return first_per_key(breaches, ["alert_id"], order_by).join(
        alert_ledger.select("alert_id"), "alert_id", "left_anti"
    )


def check_sla(runs: DataFrame, alert_ledger: DataFrame, sla_seconds: float) -> SlaCheck:
    """Judge runs (run_id, pipeline_id, run_date, duration_seconds, checked_at); run_id is unique.

    A run breaches when it takes longer than the limit. The first breach of a
    pipeline-day sends the alert unless the ledger has it already.
    """
    judged = runs.withColumn("alert_id", pair_key(F.col("pipeline_id"), F.col("run_date"))).withColumn(
        "breached", F.col("duration_seconds") > sla_seconds
    )
    sent = _alert_once(judged.where("breached"), alert_ledger, [F.col("checked_at"), F.col("run_id")])
    # run_id spreads evenly; joining on the alert key would gather a busy day in one task.
    marked = judged.join(sent.select("run_id", F.lit(True).alias("_sent")), "run_id", "left")
    checks = marked.select(
        "run_id",
        "pipeline_id",
        "run_date",
        "duration_seconds",
        "breached",
        F.when(F.col("breached"), F.col("_sent").isNotNull()).alias("alert_sent"),
        F.when(F.col("breached") & F.col("_sent").isNull(), "already alerted today (deduped)").alias("reason"),
    )
    message = F.format_string(
        f"SLA breach: %s took %ss (limit {sla_seconds:.0f}s) on %s",
        F.col("pipeline_id").cast("string"),
        F.rint(F.col("duration_seconds").cast("double")).cast("bigint"),
        F.col("run_date").cast("string"),
    )
    return SlaCheck(checks, sent.select("alert_id", message.alias("message")))


def check_run_sla(
    run_starts: DataFrame,
    run_ends: DataFrame,
    alert_ledger: DataFrame,
    sla_seconds: int = DEFAULT_SLA_SECONDS,
) -> SlaCheck:
    """Judge each ended run (run_id, ended_at) against its newest start (run_id, started_at).

    Time is counted in whole epoch seconds. A run without a start is no breach.
    """
    starts = run_starts.groupBy("run_id").agg(F.max("started_at").alias("started_at"))
    ends = run_ends.groupBy("run_id").agg(F.max("ended_at").alias("ended_at"))
    judged = (
        ends.join(starts, "run_id", "left")
        .withColumn("elapsed_seconds", whole_seconds(F.col("started_at"), F.col("ended_at")))
        .withColumn("breached", F.coalesce(F.col("elapsed_seconds") > sla_seconds, F.lit(False)))
        .withColumn("alert_id", F.concat(F.col("run_id").cast("string"), F.lit("#sla")))
    )
    sent = _alert_once(judged.where("breached"), alert_ledger, [F.col("ended_at")])
    marked = judged.join(sent.select("run_id", F.lit(True).alias("_sent")), "run_id", "left")
    checks = marked.select(
        "run_id",
        "elapsed_seconds",
        "breached",
        F.when(F.col("breached"), F.col("_sent").isNotNull()).alias("alert_sent"),
        F.when(F.col("started_at").isNull(), "no start time recorded").alias("reason"),
    )
    message = F.format_string(
        f"SLA breach: run %s took %ss (limit {sla_seconds}s)",
        F.col("run_id").cast("string"),
        F.col("elapsed_seconds"),
    )
    return SlaCheck(checks, sent.select("alert_id", message.alias("message")))


def breach_count(alert_ledger: DataFrame) -> DataFrame:
    """One row: sla_breaches_recorded."""
    return alert_ledger.agg(F.countDistinct("alert_id").alias("sla_breaches_recorded"))
