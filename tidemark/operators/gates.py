"""The six blocking quality gates, for all batches at once.

`batch_facts` reduces the events to one row of counts per batch; the gates are
plain expressions over that row. The events are aggregated twice, each time over
other columns: once by event id for the duplicate count, once by (batch, customer,
segment, month) for everything else. The second grouping folds a hot customer
into a handful of rows before it meets the customer table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import month_of, with_event_ts
from tidemark.schemas import CORRUPT, EVENT, REQUIRED_FIELDS, VALID_SEGMENTS

# Evaluation order of the gates and the drift limit.
GATES = (
    "required_fields",
    "duplicates",
    "referential_integrity",
    "range_outliers",
    "cardinality_drift",
    "freshness",
)
MAX_SHARE_CHANGE = 0.30


def declare_fields(events: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add event columns the frame lacks as nulls; also return which required ones it lacked."""
    absent = [f for f in REQUIRED_FIELDS if f not in events.columns]
    for field in EVENT.fields:
        if field.name not in events.columns:
            events = events.withColumn(field.name, F.lit(None).cast(field.dataType))
    if CORRUPT not in events.columns:
        events = events.withColumn(CORRUPT, F.lit(None).cast("string"))
    return with_event_ts(events), absent


def month_manifest(batches: DataFrame, *, start: str | None = None) -> DataFrame:
    """(batch, period_start): the month each batch is expected to hold.

    Batches named `yyyy-MM` carry their month. With `start` ("yyyy-MM"), batches end in
    a running number that counts months from there, across year ends.
    """
    names = batches.select("batch").distinct()
    if start is None:
        return names.withColumn("period_start", F.expr(NAMED_MONTH))
    number = F.regexp_extract("batch", r"(\d+)$", 1).try_cast("int")
    return names.withColumn("period_start", F.add_months(F.lit(f"{start}-01").cast("date"), number))


NAMED_MONTH = "try_cast(concat(batch, '-01') AS date)"


def _exprs(**named: str) -> list[Column]:
    """Aliased SQL expressions. One call each keeps building the plan quick."""
    return [F.expr(text).alias(name) for name, text in named.items()]


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def batch_facts(
    events: DataFrame,
    known_customers: DataFrame,
    manifest: DataFrame | None = None,
    *,
    segments: tuple[str, ...] = VALID_SEGMENTS,
    as_of: Column | None = None,
    prior_counts: DataFrame | None = None,
) -> DataFrame:
    """One row of counts per batch of the events and of the manifest, if there is one.

    `known_customers` has customer_id. `manifest` has batch, period_start; without it
    batches are named for their month, yyyy-MM. Events later than `as_of`, if given, are
    counted as future. `prior_counts` (segment_at_event, n) stands for the batch before
    the first one.
    """
    events, absent = declare_fields(events)
    domain = ", ".join(_quoted(s) for s in segments)
    share_counts = {
        f"n_segment_{i}": f"sum(CASE WHEN segment_at_event = {_quoted(s)} THEN n ELSE 0 END)"
        for i, s in enumerate(segments)
    }

    by_customer = events.groupBy(
        "batch", "customer_id", "segment_at_event", month_of(F.col("event_ts")).alias("month")
    ).agg(
        *_exprs(
            n="count(*)",
            null_type="count_if(event_type IS NULL)",
            null_ts="count_if(ts IS NULL)",
            bad_ts="count_if(ts IS NOT NULL AND event_ts IS NULL)",
            negative="count_if(amount_cents < 0)",
            unreadable=f"count_if({CORRUPT} IS NOT NULL)",
        ),
        F.count_if(F.lit(False) if as_of is None else F.col("event_ts") > as_of).alias("future"),
    )
    known = known_customers.select("customer_id").na.drop().distinct().withColumn("known", F.lit(True))
    by_month = (
        by_customer.join(known, "customer_id", "left")
        .groupBy("batch", "month")
        .agg(
            *_exprs(
                n="sum(n)",
                null_customer="sum(CASE WHEN customer_id IS NULL THEN n ELSE 0 END)",
                null_segment="sum(CASE WHEN segment_at_event IS NULL THEN n ELSE 0 END)",
                n_orphans="sum(CASE WHEN customer_id IS NOT NULL AND known IS NULL THEN n ELSE 0 END)",
                n_unknown_segment=f"sum(CASE WHEN segment_at_event NOT IN ({domain}) THEN n ELSE 0 END)",
                **{c: f"sum({c})" for c in ("null_type", "null_ts", "bad_ts", "negative", "unreadable", "future")},
                **share_counts,
            )
        )
    )
    if manifest is None:
        by_month = by_month.withColumn("period_start", F.expr(NAMED_MONTH))
    else:
        by_month = by_month.join(manifest.select("batch", "period_start"), "batch", "full_outer")
    summed = [c for c in by_month.columns if c not in ("batch", "month", "n", "period_start")]
    by_batch = by_month.groupBy("batch").agg(
        *_exprs(
            period_start="max(period_start)",
            n_in_period="coalesce(sum(CASE WHEN month = period_start THEN n END), 0)",
            **{c: f"coalesce(sum({c}), 0)" for c in summed},
        )
    )

    by_id = events.groupBy("batch").agg(
        *_exprs(
            n_rows="count(*)",
            null_id="count_if(event_id IS NULL)",
            # a distinct list of ids has one more entry when some are null
            n_ids="count(DISTINCT event_id) + least(count_if(event_id IS NULL), 1)",
        )
    )
    facts = (
        by_batch.join(by_id, "batch", "left")
        .na.fill(0, ["n_rows", "null_id", "n_ids"])
        .withColumn("absent", F.lit(absent) if absent else F.expr("CAST(array() AS array<string>)"))
    )
    return _with_prior(facts, share_counts, prior_counts)


def _with_prior(facts: DataFrame, share_counts: dict[str, str], prior_counts: DataFrame | None) -> DataFrame:
    """Segment counts of each batch and of the batch before it, as arrays in domain order."""
    names = list(share_counts)
    facts = facts.withColumn("segment_counts", F.array(*names)).drop(*names).withColumn("is_prior", F.lit(False))
    if prior_counts is not None:
        given = prior_counts.agg(*_exprs(n_rows="coalesce(sum(n), 0)", **share_counts)).select(
            "n_rows", F.array(*names).alias("segment_counts"), F.lit(True).alias("is_prior")
        )
        facts = facts.unionByName(given, allowMissingColumns=True)
    # One row per batch reaches this window, so a single partition is enough.
    in_order = Window.orderBy(F.desc("is_prior"), "batch")
    return (
        facts.withColumn("prior_rows", F.lag("n_rows").over(in_order))
        .withColumn("prior_segment_counts", F.lag("segment_counts").over(in_order))
        .where("NOT is_prior")
        .drop("is_prior")
    )


def _drift(segments: tuple[str, ...]) -> Column:
    """Array of (segment, share, prior_share, drift) in domain order."""
    share = "CAST({}[i] AS DOUBLE) / greatest({}, 1)"
    now = share.format("segment_counts", "n_rows")
    prior = share.format("prior_segment_counts", "prior_rows")
    return F.expr(
        f"""transform(array({", ".join(_quoted(s) for s in segments)}), (s, i) -> named_struct(
            'segment', s, 'share', {now}, 'prior_share', {prior}, 'drift', abs({now} - {prior})))"""
    )


def drift_table(
    facts: DataFrame, *, segments: tuple[str, ...] = VALID_SEGMENTS, max_change: float = MAX_SHARE_CHANGE
) -> DataFrame:
    """(batch, segment, share, prior_share, drift, passed) for every batch with a prior one."""
    return (
        facts.where("prior_rows IS NOT NULL")
        .select("batch", F.inline(_drift(segments)))
        .withColumn("passed", F.col("drift") <= max_change)
    )


# Message texts of the gates.
# Required field -> count of its nulls in `batch_facts`, in the order they are reported.
NULL_COUNTS = {
    "event_id": "null_id",
    "customer_id": "null_customer",
    "event_type": "null_type",
    "segment_at_event": "null_segment",
    "ts": "null_ts",
}

# Gate -> (passes, what to say if not), over a row of `batch_facts` with `missing` and `drifted`.
VERDICTS = {
    "required_fields": ("missing = ''", "concat('null/missing: {', missing, '}')"),
    "duplicates": ("n_rows = n_ids", "concat(n_rows - n_ids, ' duplicate event_id(s)')"),
    "referential_integrity": ("n_orphans = 0", "concat(n_orphans, ' events reference unknown customers')"),
    "range_outliers": (
        "negative = 0 AND n_unknown_segment = 0 AND future = 0",
        """CASE WHEN negative > 0 THEN concat(negative, ' events with negative amount_cents')
                WHEN n_unknown_segment > 0 THEN concat(n_unknown_segment, ' events with an unknown segment value')
                ELSE concat(future, ' events with a future timestamp') END""",
    ),
    "cardinality_drift": (
        "prior_rows IS NULL OR size(drifted) = 0",
        "concat(get(drifted, 0).segment, ' share drifted ', round(get(drifted, 0).drift * 100, 1), '%')",
    ),
    "freshness": (
        "n_in_period > 0",
        "concat('no events found for expected month ', coalesce(date_format(period_start, 'yyyy-MM'), '?'))",
    ),
}


def scorecard_of(
    facts: DataFrame,
    *,
    segments: tuple[str, ...] = VALID_SEGMENTS,
    max_change: float = MAX_SHARE_CHANGE,
    gates: tuple[str, ...] = GATES,
) -> DataFrame:
    """(batch, seq, gate, passed, detail) from `batch_facts`; seq is the gate's place in GATES."""
    missing = ", ".join(
        f"""CASE WHEN array_contains(absent, '{field}') THEN "'{field}': 'column absent'"
                 WHEN {n} > 0 THEN concat("'{field}': ", {n}) END"""
        for field, n in NULL_COUNTS.items()
    )
    no_time = """CASE WHEN bad_ts > 0 THEN concat("'ts': not a timestamp in ", bad_ts) END"""
    # A number that does not fit its column turns null, but its line is kept and counted here.
    unreadable = """CASE WHEN unreadable > 0 THEN concat("'line': not readable in ", unreadable) END"""
    judged = facts.withColumns(
        {
            "missing": F.expr(f"concat_ws(', ', {missing}, {no_time}, {unreadable})"),
            "drifted": F.filter(_drift(segments), lambda d: d["drift"] > max_change),
        }
    )
    rows = []
    for gate in gates:
        passes, says = VERDICTS[gate]
        silent = "''"
        if gate == "cardinality_drift":
            silent = "CASE WHEN prior_rows IS NULL THEN 'no prior month to compare' ELSE '' END"
        rows.append(
            f"""named_struct('seq', {GATES.index(gate) + 1}, 'gate', '{gate}', 'passed', {passes},
                             'detail', CASE WHEN {passes} THEN {silent} ELSE {says} END)"""
        )
    return judged.select("batch", F.expr(f"inline(array({', '.join(rows)}))"))


def gate_scorecard(
    events: DataFrame,
    known_customers: DataFrame,
    manifest: DataFrame | None = None,
    *,
    segments: tuple[str, ...] = VALID_SEGMENTS,
    max_change: float = MAX_SHARE_CHANGE,
    gates: tuple[str, ...] = GATES,
    as_of: Column | None = None,
    prior_counts: DataFrame | None = None,
) -> DataFrame:
    """Run the gates over every batch: (batch, seq, gate, passed, detail)."""
    facts = batch_facts(
        events,
        known_customers,
        manifest,
        segments=segments,
        as_of=as_of,
        prior_counts=prior_counts,
    )
    return scorecard_of(facts, segments=segments, max_change=max_change, gates=gates)


def orphans(events: DataFrame, known_customers: DataFrame) -> DataFrame:
    """Customers that have events but are not known, with their number of events.

    Events are counted per customer before the join; a null customer is no orphan.
    """
    counted = events.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.count("*").alias("n_events"))
    return counted.join(known_customers.select("customer_id"), "customer_id", "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with the number of surplus rows."""
    return (
        df.groupBy(*keys)
        .agg((F.count("*") - 1).alias("n_surplus"))
        .where(F.col("n_surplus") > 0)
    )


def failed_gates(scorecard: DataFrame) -> DataFrame:
    return scorecard.where(~F.col("passed")).select("batch", "seq", "gate", "detail")


def gate_alerts(scorecard: DataFrame) -> DataFrame:
    """One alert per blocked batch: (batch, failed_gates, message)."""
    failures = F.sort_array(F.collect_list(F.struct("seq", "gate", "detail")))  # at most one per gate
    return (
        failed_gates(scorecard)
        .groupBy("batch")
        .agg(failures.alias("f"))
        .select(
            "batch",
            F.col("f.gate").alias("failed_gates"),
            F.concat(
                F.lit("Quality gate blocked promotion of "),
                F.col("batch"),
                F.lit(": "),
                F.array_join(F.transform("f", lambda x: F.concat(x["gate"], F.lit(": "), x["detail"])), "; "),
            ).alias("message"),
        )
    )


def promoted_batches(scorecard: DataFrame) -> DataFrame:
    """(batch) of the batches that passed every gate."""
    return scorecard.groupBy("batch").agg(F.bool_and("passed").alias("ok")).where("ok").select("batch")


def promoted_rows(events: DataFrame, scorecard: DataFrame) -> DataFrame:
    """Events of promoted batches only."""
    return events.join(promoted_batches(scorecard), "batch", "left_semi")
