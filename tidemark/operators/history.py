"""Type 2 customer history: building it, auditing it, looking values up in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.lanes import HOT_ROWS, LANE_ROWS, carried, cut_lanes, hot_keys, running_total

# Starts of a customer's versions that are joined together.
LANE_STARTS = 64

# Events without customer or time are spread over this many groups.
IDLE_PARTS = 1024

HISTORY_COLUMNS = ["customer_id", "segment", "valid_from", "valid_to", "is_current"]


def hot_customers(
    events: DataFrame,
    *,
    customer: str = "customer_id",
    ts: str = "event_ts",
    hot_rows: int = HOT_ROWS,
    lane_rows: int = LANE_ROWS,
) -> DataFrame:
    """The customers with about `hot_rows` events or more and their lanes, to pass as `hot` to the operators below.

    A customer has no more versions than events, so those of a history need not be counted anew.
    """
    instants = events.select(F.col(customer).alias("customer_id"), F.col(ts).alias("valid_from"))
    return hot_keys(instants, "customer_id", "valid_from", F.xxhash64("customer_id", "valid_from"), hot_rows, lane_rows)


def build_dim_customer(
    events: DataFrame,
    *,
    customer: str = "customer_id",
    segment: str = "segment_at_event",
    ts: str = "event_ts",
    hot_rows: int = HOT_ROWS,
    lane_rows: int = LANE_ROWS,
    hot: DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """One row per customer and run of equal segments, half-open [valid_from, valid_to).

    Where one customer has several segments at one instant, the smallest counts.
    Rows without customer, segment or time cannot open a version and are ignored.

    Where no customer is hot, one shuffle by customer and one sort serve all steps; copies meet there as rows of one
    instant. Else copies collapse in the distinct before anything is sorted. Runs are then found per
    customer, or per (customer, lane) where a customer has about `hot_rows` events or
    more. A lane's first and last run may continue in a neighbouring lane and meet in a
    window over the customer; runs strictly inside a lane are final already and keep the
    lane in their key, so they stay spread out. Only runs, not events, take part in
    that second shuffle.
    """
    points = events.select(
        F.col(customer).alias("customer_id"),
        F.col(segment).alias("segment"),
        F.col(ts).alias("valid_from"),
    ).na.drop()
    if hot is None:
        hot = hot_customers(events, customer=customer, ts=ts, hot_rows=hot_rows, lane_rows=lane_rows)
    laned = not hot.isEmpty()
    if laned:
        points = cut_lanes(points.distinct(), "customer_id", "valid_from", hot).drop("_hot")

    # Without lanes both windows have the same key, so that the second one finds its rows together and in order.
    in_lane = Window.partitionBy("customer_id", *["_lane"] * laned).orderBy("valid_from", "segment")
    one_per_instant = points.withColumn("_before", F.lag("valid_from").over(in_lane)).where(
        F.col("_before").isNull() | (F.col("_before") != F.col("valid_from"))
    )
    runs = (
        one_per_instant.withColumn("_prev", F.lag("segment").over(in_lane))
        .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("segment")))
        .withColumn("_next", F.lead("valid_from").over(in_lane))
    )

    opens_lane = F.col("_prev").isNull()
    closes_lane = F.col("_next").isNull()
    edges = runs.withColumn("_stay", F.when(~(opens_lane | closes_lane), F.col("_lane"))) if laned else runs

    across = Window.partitionBy("customer_id", *["_stay"] * laned).orderBy("valid_from")
    carried = F.lag("segment").over(across)
    kept = edges.withColumn("_new", ~opens_lane | carried.isNull() | (carried != F.col("segment"))).withColumn(
        # Where the next version starts as seen from earlier lanes: here if this run
        # is a change, else at the lane's second run, else not in this lane at all.
        "_start",
        F.when(F.col("_new"), F.col("valid_from")).otherwise(F.col("_next")),
    )
    history = (
        kept.where(F.col("_start").isNotNull())
        .withColumn("valid_to", F.coalesce("_next", F.lead("_start").over(across)))
        .where("_new")
        .withColumn("is_current", F.col("valid_to").isNull())
        .select(*HISTORY_COLUMNS)
    )
    return history.orderBy("customer_id", "valid_from") if ordered else history


def number_versions(history: DataFrame, **hot: object) -> DataFrame:
    """Add `version`: 1, 2, ... per customer in order of valid_from.

    `hot_rows`, `lane_rows` and `hot`, here and in the other operators over a history, are those of
    `running_total`.
    """
    return running_total(
        history,
        key="customer_id",
        ts="valid_from",
        ties=("segment",),
        value=F.lit(1).cast("bigint"),
        out="version",
        **hot,
    )


def overlap_audit(history: DataFrame, *, limit: int | None = None, **hot: object) -> DataFrame:
    """Points in time at which a version starts while earlier ones are still open.

    Returns customer_id, valid_from, n_starting, n_open. Two versions with different
    valid_from overlap exactly when the later one starts before the earlier one ends,
    so the sum of n_starting * n_open is the number of overlapping pairs; no pair is
    ever formed. A version that ends no later than it starts is never open; one that
    ends before it starts is what `inverted_ranges` reports.
    """
    lasts = F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))

    def turn(at: str, starting, opening, closing):
        counts = [("starting", starting), ("opening", opening), ("closing", closing)]
        return F.struct(F.col(at).alias("at"), *[c.cast("bigint").alias(name) for name, c in counts])

    zero, one = F.lit(0), F.lit(1)
    start = turn("valid_from", one, lasts.cast("int"), zero)
    end = turn("valid_to", zero, zero, one)
    turns = (
        history.select(
            "customer_id",
            F.inline(F.when(lasts & F.col("valid_to").isNotNull(), F.array(start, end)).otherwise(F.array(start))),
        )
        .groupBy("customer_id", "at")
        .agg(
            F.sum("starting").alias("n_starting"),
            F.sum("opening").alias("_opening"),
            F.sum("closing").alias("_closing"),
        )
    )
    swept = running_total(
        turns,
        key="customer_id",
        ts="at",
        value=F.col("_opening") - F.col("_closing"),
        out="_open",
        **hot,
    )
    found = (
        swept.withColumn("n_open", F.col("_open") - F.col("_opening"))
        .where((F.col("n_starting") > 0) & (F.col("n_open") > 0))
        .select("customer_id", F.col("at").alias("valid_from"), "n_starting", "n_open")
    )
    return found if limit is None else found.limit(limit)


def overlap_pairs(
    history: DataFrame, *, lane_starts: int = LANE_STARTS, part_rows: int = HOT_ROWS, **hot: object
) -> DataFrame:
    """The pairs of versions behind `overlap_audit`: an earlier version that is still open when a later one starts.

    Returns customer_id, from_a, segment_a, to_a, from_b, segment_b, one row per pair with from_a < from_b. Versions alike in
    all of that are pairs of their own; versions without customer or start are in none, and one that ends no later than it
    starts is never the earlier of a pair.

    The starts of a customer are numbered in order of time, so that the starts inside a version are a range of numbers. Each
    lane holds `lane_starts` of them. An earlier version goes to the lanes of its range, a later one to the lane of its
    start, and they are joined by customer and lane: a version that meets k starts comes
    k / lane_starts + 2 times at most, and nearly all it meets in a lane is in the result. A lane in which more than `part_rows` versions
    are open is split by their hash; its few starts are repeated in each part.
    """
    versions = (
        history.where(F.col("customer_id").isNotNull() & F.col("valid_from").isNotNull())
        .groupBy("customer_id", "segment", "valid_from", "valid_to")
        .agg(F.count("*").alias("_copies"))
    )
    lasts = F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))

    def turn(at: str, starting: int):
        return F.struct(F.col(at).alias("at"), F.lit(starting).cast("bigint").alias("starting"))

    both = F.array(turn("valid_from", 1), turn("valid_to", 0))
    turns = (
        versions.select("customer_id", F.inline(F.when(F.col("valid_to").isNotNull() & lasts, both).otherwise(F.slice(both, 1, 1))))
        .groupBy("customer_id", "at")
        .agg(F.max("starting").alias("starting"))
    )
    numbered = running_total(turns, key="customer_id", ts="at", value=F.col("starting"), out="_n", **hot)
    # One row per instant: the number of starts up to it, and before it.
    numbered = numbered.select(F.col("customer_id").alias("_c"), F.col("at").alias("_at"), "_n", (F.col("_n") - F.col("starting")).alias("_before"))
    last = turns.groupBy(F.col("customer_id").alias("_of")).agg(F.sum("starting").alias("_all"))

    def at(side: DataFrame, time: str, how: str = "inner") -> DataFrame:
        return side.join(numbered, (F.col("customer_id") == F.col("_c")) & (F.col(time) == F.col("_at")), how).drop("_c", "_at")

    placed = at(versions, "valid_from").withColumnRenamed("_n", "_rank").drop("_before")
    later = placed.select(
        "customer_id",
        F.floor(F.col("_rank") / lane_starts).alias("_lane"),
        F.col("_rank").alias("_b"),
        F.col("valid_from").alias("from_b"),
        F.col("segment").alias("segment_b"),
        F.col("_copies").alias("_copies_b"),
    )
    ended = at(placed.where(F.col("valid_to").isNotNull() & lasts), "valid_to").withColumn("_until", F.col("_before")).drop("_n", "_before")
    still = placed.where(F.col("valid_to").isNull()).join(last, F.col("customer_id") == F.col("_of")).withColumnRenamed("_all", "_until")
    ranges = (
        ended.unionByName(still.drop("_of"))
        .where(F.col("_until") > F.col("_rank"))
        .withColumn("_lane", F.explode(F.sequence(F.floor((F.col("_rank") + 1) / lane_starts), F.floor(F.col("_until") / lane_starts))))
    )

    # At most (ranges in lanes / part_rows) lanes are that full, which bounds the broadcast.
    full = ranges.groupBy("customer_id", "_lane").agg(F.count("*").alias("_open")).where(F.col("_open") > part_rows)
    full = F.broadcast(full.select("customer_id", "_lane", F.ceil(F.col("_open") / part_rows).cast("int").alias("_parts")))
    n_parts = F.coalesce("_parts", F.lit(1))
    spread = F.pmod(F.xxhash64("segment", "valid_from", "valid_to"), n_parts).cast("int")
    ranges = ranges.join(full, ["customer_id", "_lane"], "left").withColumn("_part", spread).drop("_parts")
    later = later.join(full, ["customer_id", "_lane"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), n_parts - 1))).drop("_parts")

    met = ranges.join(later, ["customer_id", "_lane", "_part"]).where((F.col("_b") > F.col("_rank")) & (F.col("_b") <= F.col("_until")))
    pair = ["customer_id", F.col("valid_from").alias("from_a"), F.col("segment").alias("segment_a"), F.col("valid_to").alias("to_a"), "from_b", "segment_b"]
    times = F.col("_copies") * F.col("_copies_b")
    return met.select(*pair, F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("_")).drop("_")


def inverted_ranges(history: DataFrame) -> DataFrame:
    """Versions that end before they start."""
    return history.where(F.col("valid_to") < F.col("valid_from"))


def current_row_audit(history: DataFrame, *, include_none: bool = False, limit: int | None = None) -> DataFrame:
    """Customers with more than one current row; with `include_none` also those with none."""
    n_current = history.groupBy("customer_id").agg(F.count_if("is_current").alias("n_current"))
    wrong = F.col("n_current") != 1
    if not include_none:
        wrong = wrong & (F.col("n_current") > 0)
    found = n_current.where(wrong)
    return found if limit is None else found.limit(limit)


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row (n_rows, hash_hi, hash_lo) that is equal for equal multisets of rows.

    Each row is hashed with SHA-256; two 60-bit pieces of the digest are summed, so
    the result does not depend on row order and needs neither sort nor collect.
    """
    # Length-prefixed, so that no two rows share a text; instants do not depend on the session's zone.
    parts = []
    for c in columns or df.columns:
        kind = df.schema[c].dataType.simpleString()
        value = (F.unix_micros(c) if kind == "timestamp" else F.col(c)).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit("n")))
    text = F.concat(*parts)
    digest = df.select(F.sha2(text, 256).alias("_d"))

    def piece(start: int):
        return F.sum(F.conv(F.substring("_d", start, 15), 16, 10).cast("decimal(20,0)")).cast("string")

    return digest.agg(
        F.count("*").alias("n_rows"),
        piece(1).alias("hash_hi"),
        piece(16).alias("hash_lo"),
    )


def point_in_time(
    events: DataFrame,
    history: DataFrame,
    *,
    customer: str = "customer_id",
    ts: str = "event_ts",
    spread_by: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
    lane_rows: int = LANE_ROWS,
    part_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Every event with the `segment` and `valid_from` of the version in force at its time.

    An event before the customer's first version gets that first version; an event of
    a customer without history, or without a time, gets nulls.

    Events are never paired with a customer's versions. Both go into one window in order
    of time, which passes versions on to the events behind them. Customers with about
    `hot_rows` rows or more have one window per lane, which starts from a carry row with
    the version open when the lane begins. A lane with more than `part_rows` events
    is split by a hash of `spread_by` (all event columns unless given), with its versions
    repeated in each part.
    """
    versions = history.where(F.col("customer_id").isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col("customer_id").alias("_key"),
        F.col("valid_from").alias("_at"),
        F.xxhash64("customer_id", "valid_from").alias("_spread"),
        F.struct("valid_from", "segment").alias("_version"),
    )
    asked = events.select(
        F.col(customer).alias("_key"),
        F.col(ts).alias("_at"),
        F.xxhash64(*(spread_by or events.columns)).alias("_spread"),
        F.struct(*events.columns).alias("_event"),
    )
    # Dates and times are compared as times, on both sides of a lane's bound.
    if isinstance(asked.schema["_at"].dataType, T.DateType):
        asked = asked.withColumn("_at", F.col("_at").cast(versions.schema["_at"].dataType))
    elif isinstance(versions.schema["_at"].dataType, T.DateType):
        versions = versions.withColumn("_at", F.col("_at").cast(asked.schema["_at"].dataType))
    if hot is None:
        both_sides = asked.select("_key", "_at", "_spread").unionByName(versions.select("_key", "_at", "_spread"))
        hot = hot_keys(both_sides, "_key", "_at", F.col("_spread"), hot_rows, lane_rows)
    else:
        hot = F.broadcast(hot.withColumnRenamed("customer_id", "_key"))
    asked = cut_lanes(asked, "_key", "_at", hot).drop("_hot")
    versions = cut_lanes(versions.drop("_spread"), "_key", "_at", hot).drop("_hot")

    # Of hot customers: one row per lane that holds events or version starts. Per
    # customer that is at most the number of lanes in the calendar.
    in_lane = F.col("_lane").isNotNull()
    lane_events = asked.where(in_lane).groupBy("_key", "_lane").agg(F.count("*").alias("_n"))
    lane_versions = (
        versions.where(in_lane)
        .groupBy("_key", "_lane")
        .agg(F.min("_version").alias("_head"), F.max("_version").alias("_tail"))
    )
    parts = F.ceil(F.col("_n") / F.lit(part_rows)).cast("int")
    timeline = Window.partitionBy("_key").orderBy("_lane")
    before = timeline.rowsBetween(Window.unboundedPreceding, -1)
    whole = timeline.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = (
        lane_events.join(lane_versions, ["_key", "_lane"], "full_outer")
        .withColumn("_open", F.last("_tail", ignorenulls=True).over(before))
        .withColumn("_first", F.first("_head", ignorenulls=True).over(whole))
        .where(F.col("_n").isNotNull())
        .select(
            "_key",
            "_lane",
            F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"),
            F.lit(0).alias("_kind"),
            F.coalesce("_open", "_first").alias("_version"),
        )
    )

    # At most (all events / part_rows) lanes are that large, which bounds the broadcast.
    large = lane_events.where(F.col("_n") > part_rows).select("_key", "_lane", parts.alias("_parts"))
    split = F.broadcast(large)
    n_parts = F.coalesce("_parts", F.lit(1))
    usable = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    starts = (
        versions.join(split, ["_key", "_lane"], "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
        .withColumn("_kind", F.lit(1))
        .drop("_parts")
    )
    asked = (
        asked.join(split, ["_key", "_lane"], "left")
        # Rows that can match no version need no neighbours, so they go anywhere.
        .withColumn("_part", F.pmod("_spread", F.when(usable, n_parts).otherwise(IDLE_PARTS)).cast("int"))
        .withColumn("_kind", F.lit(2))
        .drop("_parts", "_spread")
    )

    part = Window.partitionBy("_key", "_lane", "_part")
    # The carry row has no time and so sorts before the rest of its lane.
    so_far = part.orderBy("_at", "_kind", "_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        asked.unionByName(starts, allowMissingColumns=True)
        .unionByName(carry, allowMissingColumns=True)
        .withColumn("_last", F.last("_version", ignorenulls=True).over(so_far))
        .withColumn("_first", F.min("_version").over(part))
        .where(F.col("_kind") == 2)
        .withColumn("_found", F.when(usable, F.coalesce("_last", "_first")))
        .select("_event.*", "_found.segment", "_found.valid_from")
    )


def reconcile_history(history: DataFrame, truth: DataFrame, **hot: object) -> DataFrame:
    """Compare a rebuilt history with the true one, version by version.

    `truth` has customer_id, segment, valid_from. Versions are numbered per customer on
    both sides; status is match, wrong_segment, missing (only in truth) or extra.
    """
    got = number_versions(history, **hot).select("customer_id", "version", "segment")
    want = number_versions(truth, **hot).select("customer_id", "version", F.col("segment").alias("true_segment"))
    status = (
        F.when(F.col("segment").isNull(), "missing")
        .when(F.col("true_segment").isNull(), "extra")
        .when(F.col("segment") == F.col("true_segment"), "match")
        .otherwise("wrong_segment")
    )
    return got.join(want, ["customer_id", "version"], "full_outer").withColumn("status", status)


def reconcile_slices(history: DataFrame, truth: DataFrame, **hot: object) -> DataFrame:
    """Compare a rebuilt history with the true one along time: a lost version makes its own slice wrong and no other.

    Both sides have customer_id, segment, valid_from. A version holds until its `valid_to`, or, where that is null or there is no such
    column, until the customer's next version on that side. Returns customer_id, valid_from, valid_to (null: still open), segment,
    true_segment and status (match, wrong_segment, missing: only in truth, extra: only in the history), one row per stretch of time
    between two changes on either side; stretches in which neither has a version are left out. A null segment equals a null one.

    Of several versions that start together on a side the smallest segment counts. Versions without customer or start are
    ignored, and so are those that end no later than they start.

    The changes of both sides are merged per customer and instant, and one window carries both states along; the sides are never paired.
    """

    def changes(side: DataFrame, name: str) -> DataFrame:
        ends = F.col("valid_to") if "valid_to" in side.columns else F.lit(None).cast(side.schema["valid_from"].dataType)
        rows = side.select("customer_id", "segment", "valid_from", ends.alias("valid_to"))
        rows = rows.where(F.col("customer_id").isNotNull() & F.col("valid_from").isNotNull())
        rows = rows.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))

        def change(at: str, there: bool, segment):
            return F.struct(F.col(at).alias("at"), F.struct(F.lit(not there).alias("gone"), segment.alias("segment")).alias(name))

        start = change("valid_from", True, F.col("segment"))
        end = change("valid_to", False, F.lit(None).cast(side.schema["segment"].dataType))
        turns = F.when(F.col("valid_to").isNotNull(), F.array(start, end)).otherwise(F.array(start))
        # A version that starts at an instant wins over one that ends at it.
        return rows.select("customer_id", F.inline(turns)).groupBy("customer_id", "at").agg(F.min(name).alias(name))

    got, want = changes(history, "_got"), changes(truth, "_want")
    merged = (
        got.unionByName(want, allowMissingColumns=True)
        .groupBy("customer_id", "at")
        .agg(F.max("_got").alias("_got"), F.max("_want").alias("_want"))
    )
    states = carried(merged, key="customer_id", ts="at", states=("_got", "_want"), next_ts="valid_to", **hot)
    has, ought = (F.coalesce(~F.col(c)["gone"], F.lit(False)) for c in ("_got", "_want"))
    status = (
        F.when(~has, "missing").when(~ought, "extra").when(F.col("_got.segment").eqNullSafe(F.col("_want.segment")), "match").otherwise("wrong_segment")
    )
    return states.where(has | ought).select(
        "customer_id",
        F.col("at").alias("valid_from"),
        "valid_to",
        F.col("_got.segment").alias("segment"),
        F.col("_want.segment").alias("true_segment"),
        status.alias("status"),
    )
