"""What the operators share: keeping a caller's columns apart from their own, shared folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are the runs of other characters than these: space, tab, LF, VT, FF, CR.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[ \t-\r]+"

ROW = "row"


def apart(docs: DataFrame, **own: Column) -> DataFrame:
    """The caller's columns in one struct, so that whatever they are called, `own` can't clash."""
    return docs.select(F.struct("*").alias(ROW), *[c.alias(name) for name, c in own.items()])


def together(rows: DataFrame, columns: list[str], **out: Column) -> DataFrame:
    """The caller's columns, those of `out` in place of any of the same name."""
    names = {n.lower() for n in out}
    kept = [F.col(ROW)[c].alias(c) for c in columns if c.lower() not in names]
    return rows.select(*kept, *[c.alias(name) for name, c in out.items()])


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


# Spark removes the shuffle files of a plan made while this is set, as soon as it has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame) -> DataFrame:
    """`df`, computed once and read back from the shared checkpoint folder.

    The folder is `spark.checkpoint.dir` of the session. Only where that is unset and the
    master is local, as in tests, the warehouse folder stands in for it. What was shuffled on the way
    is removed from the disks at once; else it stays until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    checkpoint_folder(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def checkpoint_folder(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    context.setCheckpointDir(folder)


# Bits of a sieve; with it, at most 256 rows of 4 kB each are broadcast, whatever the table.
SIEVE_BITS = 1 << 23


def sieve(ids: DataFrame, id_col: str, docs: DataFrame, by: str) -> DataFrame:
    """`docs` with a boolean `maybe`: false only where `by` is none of the ids.

    A bitmap of hashed ids, so that rows which can't meet need not be shuffled for a join. It lets more
    rows through the more ids there are; the join behind it decides.
    """
    bit = F.pmod(F.xxhash64(id_col), F.lit(SIEVE_BITS))
    maps = ids.select(bit.alias("h")).groupBy(F.floor(F.col("h") / 32768).alias("map_no"))
    maps = maps.agg(F.bitmap_construct_agg(F.col("h") % 32768).alias("map"))
    at = F.pmod(F.xxhash64(by), F.lit(SIEVE_BITS))
    met = apart(docs, at=at % 32768, of=F.floor(at / 32768)).join(F.broadcast(maps), F.col("of") == F.col("map_no"), "left")
    byte = F.conv(F.hex(F.substring("map", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return together(met, docs.columns, maybe=F.coalesce(F.getbit(byte, (F.col("at") % 8).cast("int")) == 1, F.lit(False)))
