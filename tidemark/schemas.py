"""Declared schemas. Nothing in the library infers a schema from data."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The event contract every batch is judged against.
REQUIRED_FIELDS = ("event_id", "customer_id", "event_type", "segment_at_event", "ts")
VALID_SEGMENTS = ("mass", "affluent", "private", "student", "dormant")
VALID_EVENT_TYPES = ("login", "card_txn", "offer_shown", "offer_redeemed")
OFFER_EVENT_TYPES = ("offer_shown", "offer_redeemed")

EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("segment_at_event", T.StringType()),
        T.StructField("amount_cents", T.LongType()),
        T.StructField("ts", T.StringType()),
    ]
)

# Text of a line that does not parse under EVENT; null on every good line.
CORRUPT = "corrupt_record"

GOLD = {
    "dim_customer": T.StructType(
        [
            T.StructField("customer_id", T.StringType()),
            T.StructField("segment", T.StringType()),
            T.StructField("valid_from", T.TimestampType()),
            T.StructField("valid_to", T.TimestampType()),
            T.StructField("is_current", T.BooleanType()),
        ]
    ),
    "fact_engagement_daily": T.StructType(
        [
            T.StructField("customer_id", T.StringType()),
            T.StructField("event_date", T.DateType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("n_events", T.LongType()),
            T.StructField("total_amount_cents", T.LongType()),
        ]
    ),
    "dim_offer": T.StructType(
        [
            T.StructField("event_type", T.StringType()),
            T.StructField("n_events", T.LongType()),
            T.StructField("n_distinct_customers", T.LongType()),
            T.StructField("offer_id", T.StringType()),
        ]
    ),
}

# Storage order of each gold table.
GOLD_ORDER = {
    "dim_customer": ("customer_id", "valid_from"),
    "fact_engagement_daily": ("customer_id", "event_date", "event_type"),
    "dim_offer": ("event_type",),
}

LEDGER = {
    "pipeline_cost": T.StructType(
        [
            T.StructField("cost_key", T.StringType()),
            T.StructField("pipeline_id", T.StringType()),
            T.StructField("run_date", T.StringType()),
            T.StructField("bytes_processed", T.LongType()),
            T.StructField("duration_seconds", T.DoubleType()),
            T.StructField("cost_usd", T.DoubleType()),
            T.StructField("recorded_at", T.TimestampType()),
        ]
    ),
    "sla_alerts": T.StructType(
        [
            T.StructField("alert_id", T.StringType()),
            T.StructField("message", T.StringType()),
        ]
    ),
    "run_starts": T.StructType(
        [
            T.StructField("run_id", T.StringType()),
            T.StructField("started_at", T.TimestampType()),
        ]
    ),
    "gate_alerts": T.StructType(
        [
            T.StructField("run_id", T.StringType()),
            T.StructField("batch", T.StringType()),
            T.StructField("failed_gates", T.ArrayType(T.StringType())),
            T.StructField("message", T.StringType()),
        ]
    ),
}


class SchemaDrift(ValueError):
    """A frame does not have the columns and types declared for its table."""


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def assert_contract(df: DataFrame, declared: T.StructType, name: str) -> DataFrame:
    """Return df unchanged if names, order and types match; nullability is ignored."""
    want, got = _shape(declared), _shape(df.schema)
    if want != got:
        raise SchemaDrift(f"{name}: declared {want}, got {got}")
    return df


def empty_table(spark: SparkSession, declared: T.StructType) -> DataFrame:
    return spark.createDataFrame([], declared)


def read_or_empty(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(declared).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, declared)
