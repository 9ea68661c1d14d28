"""Landing and reading event batches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import with_event_ts
from tidemark.schemas import CORRUPT, EVENT, assert_contract, empty_table, read_or_empty

RAW = T.StructType([*EVENT.fields, T.StructField(CORRUPT, T.StringType())])
LISTING = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("batch", T.StringType())])
LANDED = T.StructType([*RAW.fields, T.StructField("batch", T.StringType())])


def read_json_events(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON-lines events of one or several paths, with `batch` (file name without suffix).

    A field that is absent becomes null; a line that does not parse is kept as text.
    """
    return (
        spark.read.schema(RAW)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths)
        .withColumn("batch", batch_of("_metadata.file_path"))
    )


def land_bronze(spark: SparkSession, source_dir: str, bronze_path: str) -> DataFrame:
    """Write all `month=*.jsonl` files of a directory to the bronze table and return it.

    Batches landed before stay, except those that are landed again; a file without any
    line empties its batch. Every landed batch is listed (`landed_batches`), with or without rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        landed = files.load(f"{source_dir}/month=*.jsonl").select(batch_of("path").alias("batch"), F.col("length").alias("n_bytes"))
        none = landed.isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        none = True
    if none:
        raise FileNotFoundError(f"no month=*.jsonl files found in {source_dir}")
    landed = landed.groupBy("batch").agg(F.sum("n_bytes").alias("n_bytes"))
    events = read_json_events(spark, f"{source_dir}/month=*.jsonl")
    write_bronze(events, bronze_path)
    # One row per file that holds no line; what an earlier landing left of its batch goes.
    for empty in landed.join(list_batches(events), "batch", "left_anti").toLocalIterator():
        target = f"{bronze_path}/batch={partition_name(empty.batch)}"
        empty_table(spark, RAW).write.mode("overwrite").parquet(target)
    listed = landed.write.mode("overwrite").partitionBy("batch").option("partitionOverwriteMode", "dynamic")
    listed.parquet(listing_path(bronze_path))
    return read_bronze(spark, bronze_path)


FILES = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("n_files", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)


def batch_files(spark: SparkSession, bronze_path: str) -> DataFrame:
    """(batch, n_files, n_bytes, modified) of every batch in the bronze table, from the listing of its files; no file is opened."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(bronze_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, FILES)
    name = F.regexp_extract("path", r"/batch=([^/]*)/[^/]*$", 1)
    batch = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return files.groupBy(batch.alias("batch")).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"), F.max("modificationTime").alias("modified")
    )


def batch_of(path: str) -> Column:
    """The batch of a landed file: its name, or that of the directory of part files, without suffix."""
    return F.regexp_extract(path, r"([^/]*?)\.jsonl?(?:/[^/]*)?$", 1)


def partition_name(value: str) -> str:
    """A partition value as Spark spells it in a directory name."""
    return "".join(f"%{ord(ch):02X}" if ch in "\"#%'*/:=?\\{[]^" else ch for ch in value)


def listing_path(bronze_path: str) -> str:
    return bronze_path.rstrip("/") + "_landed"


def landed_batches(spark: SparkSession, bronze_path: str) -> DataFrame:
    """(batch, n_bytes) of every batch ever landed, those without rows among them."""
    return read_or_empty(spark, listing_path(bronze_path), LISTING)


def write_bronze(events: DataFrame, bronze_path: str) -> None:
    """Replace the batches of `events` in the bronze table; columns as in LANDED."""
    assert_contract(events, LANDED, "bronze")
    # Rebalancing keeps files few and even, also when one batch is far larger than the rest.
    evened = events.hint("rebalance", "batch").write.mode("overwrite").partitionBy("batch")
    evened.option("partitionOverwriteMode", "dynamic").parquet(bronze_path)


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """The landed events; none while nothing was landed."""
    return with_event_ts(read_or_empty(spark, bronze_path, LANDED))


def list_batches(events: DataFrame) -> DataFrame:
    """(batch, n_rows) of every batch present."""
    return events.groupBy("batch").agg(F.count("*").alias("n_rows"))
