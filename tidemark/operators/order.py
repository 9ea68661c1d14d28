"""A global order as a column, numbered without gathering the rows in one task.

Rows are dealt to ranges of the order, whose bounds come from a sample. The ranges are counted, the few
counts are summed up from the first range on, and a window numbers the rows inside each range.

The bounds reach the tasks as the one row of a subquery, so that neither the plan nor the time to build it
grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.lanes import instant

# Rows that one task numbers, as far as MAX_RANGES allows; more are sorted with spilling.
RANGE_ROWS = 1_000_000
# Every task holds the bounds and the driver collects them, so there are at most so many.
MAX_RANGES = 4096
# Sampled rows per range, so that at most SAMPLES * MAX_RANGES narrow rows are sorted in one task to find the bounds.
SAMPLES = 64

PLAIN = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType)


def _key(rows: DataFrame, name: str) -> Column:
    """A value that sorts as the column does and survives the way to the driver and back.

    Times become microseconds. Arrays, structs and maps only break ties, by what they look like as text.
    """
    kind = rows.schema[name].dataType
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return instant(rows, name)
    return F.col(name) if isinstance(kind, PLAIN) else F.col(name).cast("string")


def range_bounds(keys: DataFrame, range_rows: int = RANGE_ROWS) -> list:
    """Rows that cut the order of `keys` into ranges of about `range_rows` rows; none if one range will do.

    Found once, so that a second computation of the rows deals them to the same ranges. The sample may
    make ranges uneven, never wrong.
    """
    n_rows = keys.count()
    n_ranges = min(-(-n_rows // range_rows), MAX_RANGES)
    if n_ranges < 2:
        return []
    sample = keys.sample(min(1.0, SAMPLES * n_ranges / n_rows), seed=11)
    tiles = sample.withColumn("_tile", F.ntile(n_ranges).over(Window.orderBy(*keys.columns)))
    firsts = tiles.groupBy("_tile").agg(F.min(F.struct(*keys.columns)).alias("_first")).where("_tile > 1")
    return firsts.select("_first").distinct().orderBy("_first").select("_first.*").collect()


def _with_range(rows: DataFrame, names: list[str], bounds: list) -> DataFrame:
    """Add `_range`, the number of the bounds up to a row's values of `names`, by halving.

    One projection a step: unlike a function over an array they are compiled, and they are the same
    for any number of bounds of that many bits.
    """
    fields = [T.StructField(f"_k{i}", rows.schema[n].dataType) for i, n in enumerate(names)]
    kept = T.StructType([T.StructField("bounds", T.ArrayType(T.StructType(fields)))])
    known = rows.sparkSession.createDataFrame([([tuple(b) for b in bounds],)], kept).scalar()
    at = F.struct(*[F.col(n).alias(f.name) for n, f in zip(names, fields)])
    found = rows.select("*", at.alias("_at"), F.lit(0).alias("_range"))
    for bit in range(len(bounds).bit_length() - 1, -1, -1):
        beyond = F.get(known, F.col("_range") + ((1 << bit) - 1)) <= F.col("_at")
        found = found.withColumn("_range", F.col("_range") + F.when(beyond, 1 << bit).otherwise(0))
    return found.drop("_at")


def numbered(
    rows: DataFrame, order: list[str], *, descending: tuple[str, ...] = (), out: str = "row_no", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Add `out`: 1, 2, ... by the columns `order`, ascending with nulls first; numbers in `descending` fall, nulls first.

    All other columns break ties, so only rows that are equal in every column share a place in the
    order, and for those the number makes no difference. An existing column `out` is replaced. `rows` is
    computed four times (count, sample, counts of ranges, numbers): store what is costly first.
    """
    rows = rows.drop(out)
    names, extra = [], []
    for c in [*order, *[c for c in rows.columns if c not in order]]:
        # A column that sorts as it is travels once, as its own key.
        plain = c not in descending and isinstance(rows.schema[c].dataType, PLAIN)
        names.append(c if plain else f"_o{len(names)}")
        if not plain:
            extra.append((-_key(rows, c) if c in descending else _key(rows, c)).alias(names[-1]))
    keyed = rows.select("*", *extra)

    bounds = range_bounds(keyed.select(*names), range_rows)
    place = F.row_number().over(Window.orderBy(*names))
    if bounds:
        keyed = _with_range(keyed, names, bounds)
        # One row per range reaches this window.
        earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        sizes = keyed.groupBy("_range").agg(F.count("*").alias("_n"))
        starts = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        inside = F.row_number().over(Window.partitionBy("_range").orderBy(*names))
        keyed = keyed.withColumn("_inside", inside).join(F.broadcast(starts), "_range")
        place = F.col("_before") + F.col("_inside")
    return keyed.select(*rows.columns, place.cast("bigint").alias(out))
