"""Bronze to silver: one survivor per event id, incomplete rows kept as rejects."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import any_null, with_event_ts
from tidemark.operators.lanes import first_per_key
from tidemark.schemas import REQUIRED_FIELDS

CLEAN, REJECTS = "clean", "rejects"
# Equal rows without an id that are brought back at a time.
CHUNK = 65_536


class Silver(NamedTuple):
    valid: DataFrame
    rejects: DataFrame
    stats: DataFrame


def chunks(n: Column) -> Column:
    """`n` as an array of numbers up to CHUNK that add up to it."""
    numbers = F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / CHUNK))
    return F.transform(numbers, lambda i: F.least(F.lit(CHUNK), n - i * CHUNK).cast("int"))


def zone_rows(
    events: DataFrame, *, keys: tuple[str, ...] = ("event_id",), required: tuple[str, ...] = REQUIRED_FIELDS
) -> DataFrame:
    """All surviving rows with `zone` (clean or rejects) and `n_copies`.

    Rows are deduplicated per batch where there is a `batch` column. Among copies a
    complete row wins, then the earliest, then the one whose columns sort first. Rows
    without an id are no copies of each other: each one is a reject of its own.
    """
    events = with_event_ts(events)
    incomplete = any_null([*required, "event_ts"])
    group = [*(["batch"] if "batch" in events.columns else []), *keys]
    no_id = any_null(keys)

    # A row without id is grouped by all it holds, and comes back as often as it was there: one scan for all.
    # Each partition has a group of its own, so that very many equal rows do not meet in one task.
    alone = F.when(no_id, F.struct(F.spark_partition_id().alias("_part"), *events.columns))
    survivors = first_per_key(
        events.withColumn("_alone", alone), [*group, "_alone"], [incomplete, F.col("event_ts")], copies="n_copies"
    ).drop("_alone")
    one = F.lit(1).cast("bigint")
    cut = F.when(no_id, chunks(F.col("n_copies"))).otherwise(F.array(F.lit(1)))
    survivors = survivors.select(*events.columns, "n_copies", F.explode(cut).alias("_chunk"))
    times = F.when(no_id, F.array_repeat(one, F.col("_chunk"))).otherwise(F.array("n_copies"))
    rows = survivors.select(*events.columns, F.explode(times).alias("n_copies"))
    return rows.withColumn("zone", F.when(incomplete, REJECTS).otherwise(CLEAN))


def silver_stats(rows: DataFrame) -> DataFrame:
    """Reconciled counts from `zone_rows` output, per batch if there is one.

    `reconciled` holds when no bronze row was collapsed as a copy; bronze_rows always
    equals silver_rows + rejects + duplicates.
    """
    by = ["batch"] if "batch" in rows.columns else []
    counts = rows.groupBy(*by).agg(
        F.coalesce(F.sum("n_copies"), F.lit(0)).cast("bigint").alias("bronze_rows"),
        F.count_if(F.col("zone") == CLEAN).alias("silver_rows"),
        F.count_if(F.col("zone") == REJECTS).alias("rejects"),
    )
    kept = F.col("silver_rows") + F.col("rejects")
    return counts.withColumn("duplicates", F.col("bronze_rows") - kept).withColumn(
        "reconciled", F.col("bronze_rows") == kept
    )


def silverize(events: DataFrame, **options) -> Silver:
    """(valid, rejects, stats) of a frame. Sinks write `zone_rows` once instead."""
    rows = zone_rows(events, **options)
    return Silver(zone(rows, CLEAN), zone(rows, REJECTS), silver_stats(rows))


def zone(rows: DataFrame, name: str) -> DataFrame:
    """The events of one zone, without the bookkeeping columns."""
    return rows.where(F.col("zone") == name).drop("zone", "n_copies")
