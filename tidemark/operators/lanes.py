"""Ordered computations that do not put one key's whole history in one task.

A plain window over `partitionBy(key)` sorts every row of a key in a single
task, so a key with a third of all rows stalls the job. These helpers cut a hot
key's timeline into lanes: stretches of time with at most so many rows, found from
a histogram of the key's own rows. The row-level window is partitioned by (key, lane). What has to
pass from lane to lane is first reduced to a row or two per lane; only those rows meet in
a window over the key alone, and there are about 2 rows / LANE_ROWS lanes.
Other keys have no lanes; where no key is hot, nothing of this is left in a plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key with about this many rows is hot; one task sorts fewer narrow rows with ease.
HOT_ROWS = 5_000_000
# Hot keys are looked for among the rows of one in so many hash slots.
SLOTS = 1000
# Rows of a hot key that are sorted together at most.
LANE_ROWS = 1_000_000
# Cells of the first histogram have 2 ** 36 microseconds (19 hours), those of the next 2 ** 10 times less, and so on.
CELL_BITS, FINER_BITS = 36, 10


def instant(rows: DataFrame, ts: str) -> Column:
    """Microseconds since 1970 of a date or time, in no zone but its own; never decreases as `ts` grows."""
    kind, at = rows.schema[ts].dataType, F.col(ts)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(at)
    day = F.unix_date(F.to_date(at)).cast("bigint") * 86_400_000_000
    if isinstance(kind, T.DateType):
        return day
    seconds = (F.hour(at) * 3600 + F.minute(at) * 60).cast("bigint")
    return day + seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("bigint")


def hot_keys(
    rows: DataFrame, key: str, ts: str, row_hash: Column, hot_rows: int = HOT_ROWS, lane_rows: int = LANE_ROWS
) -> DataFrame:
    """(key, _hot, _bounds) of the keys that have about `hot_rows` rows or more, ready to broadcast.

    Keys are counted on one hash slot of the rows, once, here. That only decides which way a key is
    computed: every row goes on, and both ways are exact, so an estimate will do. `_bounds` are the instants at which
    the lanes of the key begin, exact from all its rows. The driver sees at most
    (rows / hot_rows) keys and 2 (rows / lane_rows) bounds, which also bounds the broadcast.
    """
    spark = rows.sparkSession
    slots = SLOTS if hot_rows >= 100 * SLOTS else 1  # fewer rows are counted one by one
    counted = rows.where(F.pmod(row_hash, F.lit(slots)) == 0).groupBy(key).agg(F.count("*").alias("_n"))
    found = counted.where((F.col("_n") >= hot_rows / slots) & F.col(key).isNotNull()).select(key).collect()
    bounds: dict = {}
    if found:
        names = spark.createDataFrame(found, T.StructType([rows.schema[key]]))
        for k, at in _lane_bounds(rows.join(F.broadcast(names), key, "left_semi"), key, ts, max(lane_rows, 2)).collect():
            bounds.setdefault(k, []).append(at)
    schema = T.StructType(
        [rows.schema[key], T.StructField("_hot", T.BooleanType()), T.StructField("_bounds", T.ArrayType(T.LongType()))]
    )
    hot = spark.createDataFrame([(k, True, sorted(bounds.get(k, []))) for (k,) in found], schema)
    # Known to be empty, the join with it leaves the plan.
    return F.broadcast(hot) if found else hot.where(F.lit(False))


def _lane_bounds(rows: DataFrame, key: str, ts: str, lane_rows: int) -> DataFrame:
    """(key, begin of a lane) such that no lane has more than `lane_rows` rows, those of one microsecond apart.

    A histogram of coarse cells first; only cells with more than half of `lane_rows` are counted again in finer
    ones. Neighbouring cells are then put together up to the limit.
    """
    spark, half = rows.sparkSession, lane_rows // 2
    scope = rows.where(F.col(ts).isNotNull()).select(F.col(key).alias("_k"), instant(rows, ts).alias("_us"))
    bits, leaves = CELL_BITS, []
    while True:
        cells = scope.groupBy("_k", F.shiftright("_us", bits).alias("_cell")).agg(F.count("*").alias("_n"))
        dense = cells.where(F.col("_n") > half).select("_k", "_cell").collect() if bits else []
        fit = cells.where(F.col("_n") <= half) if bits else cells
        leaves.append(fit.select("_k", F.shiftleft("_cell", bits).alias("_from"), "_n"))
        if not dense:
            break
        names = spark.createDataFrame(dense, T.StructType([cells.schema["_k"], cells.schema["_cell"]]))
        scope = scope.withColumn("_cell", F.shiftright("_us", bits)).join(F.broadcast(names), ["_k", "_cell"], "left_semi")
        bits = max(bits - FINER_BITS, 0)
    counts = leaves[0]
    for finer in leaves[1:]:
        counts = counts.unionByName(finer)
    before = Window.partitionBy("_k").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    lane = F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / half)
    return counts.withColumn("_lane", lane).groupBy("_k", "_lane").agg(F.min("_from").alias("_from")).select("_k", "_from")


def cut_lanes(rows: DataFrame, key: str, ts: str, hot: DataFrame) -> DataFrame:
    """Add `_lane`, the number of the lane a row of a hot key falls into, and `_hot`.

    `_lane` is null for other keys and for rows without time. `hot` is of `hot_keys` over this
    or any other table: rows of times that it does not know fall into a lane beside.
    """
    at = instant(rows, ts)
    steps = F.array(*[F.lit(1 << b) for b in range(21, -1, -1)])
    # The number of bounds up to the row's time, by halving.
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda n, step: F.when(F.get(F.col("_bounds"), n + step - 1) <= F.col("_us"), n + step).otherwise(n),
    )
    joined = rows.withColumn("_us", at).join(hot, key, "left")
    return joined.withColumn("_lane", F.when(F.col("_hot") & F.col("_us").isNotNull(), found)).drop("_us", "_bounds")


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column], copies: str | None = None) -> DataFrame:
    """The row that sorts first for each key, ties broken by all remaining columns.

    An aggregate, not a `row_number` window: copies of a key collapse on the map
    side, so a key with very many rows shuffles at most one row per map task.
    Nulls sort first. `copies` names an extra column with the rows per key.
    """
    return _pick(F.min, df, keys, order_by, copies)


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[Column], copies: str | None = None) -> DataFrame:
    """The row that sorts last for each key; otherwise as `first_per_key`."""
    return _pick(F.max, df, keys, order_by, copies)


def _pick(pick, df, keys, order_by, copies):
    rest = [c for c in df.columns if c not in keys]
    order = [c.alias(f"_o{i}") for i, c in enumerate(order_by)]
    aggs = [pick(F.struct(*order, *rest)).alias("_row")]
    if copies:
        aggs.append(F.count("*").alias(copies))
    extra = [copies] if copies else []
    return df.groupBy(*keys).agg(*aggs).select(*keys, *[F.col(f"_row.{c}") for c in rest], *extra)


def running_total(
    rows: DataFrame,
    *,
    key: str,
    ts: str,
    value: Column,
    out: str,
    ties: tuple[str, ...] = (),
    hot_rows: int = HOT_ROWS,
    lane_rows: int = LANE_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add `out`, the sum of `value` over this and all earlier rows of the same key.

    The lanes of a hot key are summed first; each lane then starts from one carry row
    holding the total of the lanes before it. Rows without time come before all others.
    `hot` gives the hot keys, as from `hot_keys` over the table that `rows` come from; without
    it `rows` are computed once more to count them. Which keys it holds does not change the result.
    """
    if hot is None:
        hot = hot_keys(rows.select(key, ts), key, ts, F.xxhash64(key, ts), hot_rows, lane_rows)
    cut = cut_lanes(rows.withColumn("_value", value), key, ts, hot)

    earlier_lanes = Window.partitionBy(key).orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        cut.where("_hot")
        .groupBy(key, "_lane")
        .agg(F.sum("_value").alias("_lane_total"))
        .select(
            key,
            "_lane",
            F.lit(0).alias("_kind"),
            F.sum("_lane_total").over(earlier_lanes).alias("_value"),
            F.lit(None).cast(rows.schema[ts].dataType).alias(ts),
        )
    )
    marked = cut.withColumn("_kind", F.lit(1)).unionByName(carry, allowMissingColumns=True)

    in_lane = (
        Window.partitionBy(key, "_lane")
        .orderBy("_kind", ts, *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marked.withColumn(out, F.sum("_value").over(in_lane))
        .where(F.col("_kind") == 1)
        .drop("_lane", "_hot", "_kind", "_value")
    )


def carried(
    rows: DataFrame,
    *,
    key: str,
    ts: str,
    states: tuple[str, ...],
    next_ts: str = "next_ts",
    hot_rows: int = HOT_ROWS,
    lane_rows: int = LANE_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Carry the last known value of every column of `states` on to the later rows of the same key.

    `rows` has one row per key and time at most, none of them null. A null state means unknown, so the last one holds; give values
    that may be null themselves as structs. `next_ts` is the time of the key's next row.
    A lane of a hot key starts from one carry row with the states before it, and its last row gets the time
    at which the next lane begins.
    """
    if hot is None:
        hot = hot_keys(rows.select(key, ts), key, ts, F.xxhash64(key, ts), hot_rows, lane_rows)
    cut = cut_lanes(rows, key, ts, hot)

    lanes = Window.partitionBy(key).orderBy("_lane")
    earlier = lanes.rowsBetween(Window.unboundedPreceding, -1)
    per_lane = cut.where("_hot").groupBy(key, "_lane").agg(
        F.min(ts).alias("_begin"),
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(ts), F.col(c)))).alias(f"_last_{c}") for c in states],
    )
    carry = per_lane.select(
        key,
        "_lane",
        F.lit(0).alias("_kind"),
        F.lead("_begin").over(lanes).alias("_following"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier)[c].alias(c) for c in states],
    )
    marked = cut.withColumn("_kind", F.lit(1)).unionByName(carry, allowMissingColumns=True)

    in_lane = Window.partitionBy(key, "_lane").orderBy("_kind", ts)
    so_far = in_lane.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = marked.select(
        *[c for c in rows.columns if c not in states],
        "_kind",
        *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in states],
        F.coalesce(F.lead(ts).over(in_lane), F.max("_following").over(so_far)).alias(next_ts),
    )
    return done.where("_kind = 1").drop("_kind")
