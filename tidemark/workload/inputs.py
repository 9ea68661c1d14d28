"""The supplied tables in the shapes the operators take.

`orders` plays the monthly event batches, `events` the daily engagement and the run
log, `customer` the known customers. Defects the tables do not have are written over
whole months, so that every gate has batches that fail it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import CORRUPT
from tidemark.sources.bronze import LANDED

# The values of o_orderpriority, standing for the customer segments.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


# Declared, so that opening a table runs no job over file footers.
SCHEMAS = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for the tables a query writes and reads back, shared by all executors.

    It lies in `spark.checkpoint.dir`; only on a local master, as in tests, the warehouse folder will do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tidemark/{uuid.uuid4()}"


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The defective order batches in the columns of the bronze table."""
    events = loaded_events(spark, sf_dir).withColumn(CORRUPT, F.lit(None))
    return events.select(*[F.col(f.name).cast(f.dataType) for f in LANDED.fields])


def cents(amount: str):
    return F.round(F.col(amount) * 100).cast("bigint")


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as customer events in monthly batches named yyyy-MM."""
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("batch"),
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("event_type"),
        F.col("o_orderpriority").alias("segment_at_event"),
        cents("o_totalprice").alias("amount_cents"),
        F.col("o_orderdate").alias("ts"),
    )


def loaded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`order_events` as a load with defects by calendar month.

    February: urgent orders of unknown customers. March: pending orders without type.
    May: urgent orders twice. July: negative low-priority amounts. August and
    December: an unknown segment. October: every order urgent. December: times one
    year early.
    """
    month = F.month("ts")
    segment = F.col("segment_at_event")
    urgent, low = segment == "1-URGENT", segment == "5-LOW"
    copies = F.when((month == 5) & urgent, 2).otherwise(1)
    clean = order_events(spark, sf_dir)
    return clean.select(
        "batch",
        "event_id",
        F.when((month == 2) & urgent, -F.col("customer_id")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when((month == 3) & (F.col("event_type") == "P"), None).otherwise(F.col("event_type")).alias("event_type"),
        F.when(month.isin(8, 12) & low, "9-VIP")
        .when(month == 10, "1-URGENT")
        .otherwise(segment)
        .alias("segment_at_event"),
        F.when((month == 7) & low, -F.col("amount_cents")).otherwise(F.col("amount_cents")).alias("amount_cents"),
        F.when(month == 12, F.col("ts") - F.expr("INTERVAL '1' YEAR")).otherwise(F.col("ts")).alias("ts"),
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")


def known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))


def solvent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer list that lacks everyone with a negative balance."""
    solvent = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    return solvent.select(F.col("c_custkey").alias("customer_id"))


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        "event_type",
        cents("value").alias("amount_cents"),
        F.col("ts").alias("event_ts"),
    )


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items keyed by order and line, many of them twice; ts is null on free lines.

    Returned flag R carries no supplier, so both zones of silver fill up.
    """
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "R", None).otherwise(F.col("l_suppkey")).alias("supplier"),
        "l_partkey",
        "l_quantity",
        F.col("l_shipdate").alias("ts"),
    )


def order_history_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(spark, sf_dir).withColumnRenamed("ts", "event_ts")


def broken_history(history: DataFrame) -> DataFrame:
    """A history in which urgent versions were never closed."""
    urgent = F.col("segment") == "1-URGENT"
    return history.select(
        "customer_id",
        "segment",
        "valid_from",
        F.when(~urgent, F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") | urgent).alias("is_current"),
    )


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log: one run per order, the pipeline being its priority."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("pipeline_id"),
        F.to_date("o_orderdate").cast("string").alias("run_date"),
        F.round(F.col("o_totalprice") * 1000000).cast("bigint").alias("bytes_processed"),
        F.col("o_totalprice").alias("duration_seconds"),
        F.col("o_orderdate").alias("recorded_at"),
    )


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log: one run per event, the pipeline being its type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("pipeline_id"),
        F.to_date("ts").cast("string").alias("run_date"),
        F.round(F.col("value") * 1000000).cast("bigint").alias("bytes_processed"),
        F.col("value").alias("duration_seconds"),
        F.col("ts").alias("checked_at"),
    )


def click_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alert ledger that already holds every day of the click pipeline."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "click")
        .select(F.concat(F.lit("click#"), F.to_date("ts").cast("string")).alias("alert_id"))
        .distinct()
    )


def day_runs(spark: SparkSession, sf_dir: str, event_type: str, time: str) -> DataFrame:
    """One run per user and day, marked by that user's events of one type."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == event_type)
        .select(
            F.concat(F.col("user_id").cast("string"), F.lit("@"), F.to_date("ts").cast("string")).alias("run_id"),
            F.col("ts").alias(time),
        )
    )


def run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alert ledger that already holds every run (user and day) with an error."""
    runs = day_runs(spark, sf_dir, "error", "seen_at").select("run_id").distinct()
    return runs.select(F.concat("run_id", F.lit("#sla")).alias("alert_id"))


def value_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quality check per event: its value against 20, lower being better for two types."""
    kind = F.col("event_type")
    dimension = (
        F.when(kind == "click", "completeness")
        .when(kind == "view", "correctness")
        .when(kind == "purchase", "consistency")
        .when(kind == "signup", "validity")
        .otherwise("timeliness")
    )
    return table(spark, sf_dir, "events").select(
        dimension.alias("dimension"),
        F.concat(F.lit("event_"), F.col("event_id").cast("string")).alias("name"),
        F.col("value").alias("measured"),
        F.lit(20.0).alias("threshold"),
        (~kind.isin("view", "error")).alias("higher_is_better"),
        F.col("props").alias("detail"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
