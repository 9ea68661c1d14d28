"""Sinks and readers of the silver, gold and ledger tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality
from tidemark.operators.lanes import latest_per_key
from tidemark.schemas import GOLD, GOLD_ORDER, LEDGER, assert_contract, empty_table, read_or_empty

SILVER = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("segment_at_event", T.StringType()),
        T.StructField("amount_cents", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("corrupt_record", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("n_copies", T.LongType()),
        T.StructField("zone", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)


# One row per switch of a batch: the run folder that holds it now, and what it was built from.
SILVER_STATE = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("n_files", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("run", T.StringType()),
        T.StructField("live", T.BooleanType()),
        T.StructField("switched_at", T.TimestampType()),
    ]
)
GOLD_POINTER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("switched_at", T.TimestampType()),
    ]
)


def _switch(spark: SparkSession, rows: list[tuple], schema: T.StructType, path: str) -> None:
    """Append rows as one file. Readers see all of them or none."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def silver_state_path(path: str) -> str:
    return path.rstrip("/") + "_state"


def silver_state(spark: SparkSession, path: str) -> DataFrame:
    """The batches that silver holds: the run folder of each, and the bronze files it was built from."""
    switches = read_or_empty(spark, silver_state_path(path), SILVER_STATE)
    return latest_per_key(switches, ["batch"], [F.col("switched_at")]).where("live").select(*SILVER_STATE.names)


def silver_changes(listing: list, promoted: list[str], state: list) -> tuple[list[tuple], list[str]]:
    """(batches to write with their listing, batches to drop): promoted batches whose files are others than silver was built from, and
    batches of silver that are promoted no more.

    `listing` are the rows of `bronze.batch_files`, `state` those of `silver_state`: a row per batch, no data. A batch without a
    listing is always written.
    """
    listed = {r.batch: (r.batch, r.n_files, r.n_bytes, r.modified) for r in listing}
    built = {r.batch: (r.batch, r.n_files, r.n_bytes, r.modified) for r in state}
    due = [listed.get(b, (b, None, None, None)) for b in promoted if b not in listed or listed[b] != built.get(b)]
    return due, sorted(set(built) - set(promoted))


def replace_silver(rows: DataFrame | None, path: str, written: list, dropped: list[str] = ()) -> None:
    """Write `zone_rows` output to a run folder, then switch the batches of `written` to it and take those of `dropped` away.

    `written` has rows (batch, n_files, n_bytes, modified), also for batches without a row in either zone. Other batches stay as
    they are, and so does all that readers see while the write runs or if it fails: only the last step, one small file, changes it.
    """
    if not written and not dropped:
        return
    run, spark = uuid.uuid4().hex, SparkSession.active()
    if written and rows is not None:
        rows.hint("rebalance", "zone", "batch").write.partitionBy("zone", "batch").parquet(f"{path}/run={run}")
    now = datetime.now(timezone.utc)
    switches = [(*w, run, True, now) for w in written] + [(b, None, None, None, None, False, now) for b in dropped]
    _switch(spark, switches, SILVER_STATE, silver_state_path(path))


def read_silver(spark: SparkSession, path: str, zone: str | None = None) -> DataFrame:
    """The rows of all batches that silver holds now, each from its run folder; other folders are not read."""
    live: dict[str, list[str]] = {}
    for batch, run in silver_state(spark, path).select("batch", "run").collect():  # one row per batch
        live.setdefault(run, []).append(batch)
    if not live:
        return empty_table(spark, SILVER)
    stored = read_or_empty(spark, path, T.StructType([*SILVER.fields, T.StructField("run", T.StringType())]))
    current = F.lit(False)
    for run, batches in live.items():
        current = current | ((F.col("run") == run) & F.col("batch").isin(batches))
    rows = stored.where(current).select(*SILVER.names)
    return rows if zone is None else rows.where(F.col("zone") == zone)


def _pointers(root: str) -> str:
    return f"{root.rstrip('/')}_current"


def gold_path(spark: SparkSession, root: str, name: str) -> str:
    """The folder that holds a gold table now; the table's own folder while it was never written."""
    pointers = read_or_empty(spark, _pointers(root), GOLD_POINTER).where(F.col("name") == name)
    last = pointers.orderBy(F.desc("switched_at"), "run").first()
    return f"{root}/{name}/run={last.run}" if last else f"{root}/{name}"


def write_gold(df: DataFrame, root: str, name: str) -> int:
    """Replace a gold table, sorted by its key across files; return its number of rows.

    It is written to a folder of its own, its rows counted on the way. Then one pointer row switches readers to it; if the write fails, the table
    stays as it was.
    """
    spark, order, run = df.sparkSession, GOLD_ORDER[name], uuid.uuid4().hex
    counted = Observation()
    ordered = assert_contract(df, GOLD[name], name).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/{name}/run={run}")
    n_rows = counted.get.get("n", 0)
    _switch(spark, [(name, run, n_rows, datetime.now(timezone.utc))], GOLD_POINTER, _pointers(root))
    return n_rows


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A gold table, empty with the declared columns while it was never written."""
    return read_or_empty(spark, gold_path(spark, root, name), GOLD[name])


def open_view(spark: SparkSession, path: str, name: str, declared: T.StructType | None = None) -> DataFrame:
    """Name a Parquet path for SQL. With a declared schema a missing path is an empty view."""
    df = spark.read.parquet(path) if declared is None else read_or_empty(spark, path, declared)
    df.createOrReplaceTempView(name)
    return df


def register_gold(spark: SparkSession, root: str, database: str = "tidemark_gold") -> list[str]:
    """Create or update the gold tables in the catalog, over the files they have now, with declared columns.

    Register again after a run: the catalog goes on naming the folder that was current.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, declared in GOLD.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in declared.fields)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet LOCATION '{gold_path(spark, root, name)}'")
    return [f"{database}.{name}" for name in GOLD]


def remove_old_runs(spark: SparkSession, silver: str, gold: str, keep: int = 2) -> list[str]:
    """Delete run folders that no reader needs: of silver those without a current batch, of gold all but the last `keep` of a table.

    Only folders of runs that were switched to are touched, never those of a run that is still writing. Call it when no query
    of an older run is under way.
    """
    states = read_or_empty(spark, silver_state_path(silver), SILVER_STATE).where("live").select("run").distinct()
    old = [f"{silver}/run={r.run}" for r in states.join(silver_state(spark, silver), "run", "left_anti").collect()]
    newest = Window.partitionBy("name").orderBy(F.desc("switched_at"), "run")
    pointers = read_or_empty(spark, _pointers(gold), GOLD_POINTER).withColumn("n", F.row_number().over(newest))
    old += [f"{gold}/{p.name}/run={p.run}" for p in pointers.where(F.col("n") > max(keep, 1)).collect()]
    removed = []
    for folder in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            removed.append(folder)
    return removed


def append_ledger(df: DataFrame, root: str, name: str) -> None:
    assert_contract(df, LEDGER[name], name).write.mode("append").parquet(f"{root}/{name}")


def read_ledger(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/{name}", LEDGER[name])


def write_quality_report(evaluated: DataFrame, path: str, pipeline: str) -> None:
    """JSON lines under path/checks (what was measured) and path/score (per dimension)."""
    stamped = evaluated.withColumn("pipeline", F.lit(pipeline)).withColumn("generated_at", F.current_timestamp())
    stamped.write.mode("overwrite").json(f"{path}/checks")
    scored = quality.score(evaluated).withColumn("pipeline", F.lit(pipeline))
    scored.withColumn("generated_at", F.current_timestamp()).write.mode("overwrite").json(f"{path}/score")
