"""Quality scorecard: measured values against thresholds, scored per dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The dimensions a check can belong to.
DIMENSIONS = ("completeness", "correctness", "consistency", "validity", "timeliness")

CHECK_SCHEMA = (
    "dimension string, name string, measured double, threshold double, higher_is_better boolean, detail string"
)


class QualityFailure(AssertionError):
    """At least one quality check failed."""


def evaluate(checks: DataFrame) -> DataFrame:
    """Add `passed`; a measurement equal to its threshold passes in either direction."""
    passed = F.when(F.col("higher_is_better"), F.col("measured") >= F.col("threshold")).otherwise(
        F.col("measured") <= F.col("threshold")
    )
    return checks.withColumn("passed", F.coalesce(passed, F.lit(False)))


def score(evaluated: DataFrame) -> DataFrame:
    """(dimension, score): pass rate of each dimension present, and `overall`.

    Without any check overall is 0.0.
    """
    by_dimension = evaluated.groupBy("dimension").agg(
        F.count_if("passed").alias("n_passed"), F.count("*").alias("n_checks")
    )
    # An aggregate without keys has a row even when there are no checks; grouping sets have none.
    overall = by_dimension.agg(F.sum("n_passed").alias("n_passed"), F.sum("n_checks").alias("n_checks"))
    counts = by_dimension.unionByName(overall.withColumn("dimension", F.lit("overall")))
    rate = F.col("n_passed") / F.nullif(F.col("n_checks"), F.lit(0)).cast("double")
    return counts.select("dimension", F.coalesce(F.round(rate, 4), F.lit(0.0)).alias("score"))


def failed_checks(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(~F.col("passed"))


def failure_counts(evaluated: DataFrame) -> DataFrame:
    """(dimension, n_failed, n_checks) of the dimensions in which a check failed."""
    counted = evaluated.groupBy("dimension").agg(
        F.count_if(~F.col("passed")).alias("n_failed"), F.count("*").alias("n_checks")
    )
    return counted.where("n_failed > 0")


def assert_all_passed(evaluated: DataFrame, pipeline: str, stored: str | None = None) -> None:
    """Raise QualityFailure with the failures per known dimension, and where the failed checks are stored.

    The failed checks themselves stay in `failed_checks`; however many there are, the driver sees one row.
    """
    known = [F.count_if(~F.col("passed") & (F.col("dimension") == d)).alias(d) for d in DIMENSIONS]
    counts = evaluated.agg(F.count("*").alias("n"), F.count_if(~F.col("passed")).alias("bad"), *known).first()
    if counts.bad:
        where = ", ".join(f"{d} {counts[d]}" for d in DIMENSIONS if counts[d])
        hint = f"; the failed checks are in {stored}" if stored else ""
        raise QualityFailure(f"{pipeline}: {counts.bad} of {counts.n} quality checks failed ({where}){hint}")
