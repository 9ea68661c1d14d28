"""Every operator as a query over the supplied tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import with_event_ts
from tidemark.operators import facts, gates, history, ledger, quality, silver, vectors
from tidemark.operators.lanes import latest_per_key
from tidemark.operators.order import numbered
from tidemark.schemas import CORRUPT, EVENT, GOLD, assert_contract
from tidemark.plans.monthly import Warehouse, clean_batch, run_monthly
from tidemark.sources import tables
from tidemark.sources.bronze import RAW, land_bronze, list_batches, write_bronze
from tidemark.workload import inputs as i

# The customers' segments in `orders`.
DOMAIN = {"segments": i.PRIORITIES}

# Ranges of the numbered outputs are this small so that the supplied tables fill several.
RANGE_ROWS = 2000


# ---- history ---------------------------------------------------------------


def _hot(spark, sf):
    """Customers with very many orders, counted once for all that is derived from the orders."""
    return history.hot_customers(i.order_history_events(spark, sf))


def _dim(spark, sf, hot):
    return history.build_dim_customer(i.order_history_events(spark, sf), hot=hot)


def scd2_dim_customer(spark, sf):
    return _dim(spark, sf, _hot(spark, sf))


def cohort_retention(spark, sf):
    return facts.cohort_retention(scd2_dim_customer(spark, sf))


def cohort_summary(spark, sf):
    return facts.cohort_summary(scd2_dim_customer(spark, sf))


def scd2_overlap_audit(spark, sf):
    hot = _hot(spark, sf)
    return history.overlap_audit(i.broken_history(_dim(spark, sf, hot)), hot=hot)


def scd2_overlap_pairs(spark, sf):
    """The rows behind `scd2_overlap_audit`: n_starting * n_open of them per start."""
    hot = _hot(spark, sf)
    return history.overlap_pairs(i.broken_history(_dim(spark, sf, hot)), hot=hot)


def scd2_overlap_clean(spark, sf):
    hot = _hot(spark, sf)
    found = history.overlap_audit(_dim(spark, sf, hot), hot=hot)
    return found.agg(F.count("*").alias("n_overlaps"))


def scd2_multi_current(spark, sf):
    return history.current_row_audit(i.broken_history(scd2_dim_customer(spark, sf)))


def scd2_fingerprint(spark, sf):
    return history.fingerprint(scd2_dim_customer(spark, sf))


def scd2_version_numbers(spark, sf):
    hot = _hot(spark, sf)
    return history.number_versions(_dim(spark, sf, hot), hot=hot).select("customer_id", "valid_from", "version")


def version_numbers_null_time(spark, sf):
    """Versions that began in a February lost their time: they count before all others."""
    hot = _hot(spark, sf)
    dim = _dim(spark, sf, hot).select(
        "customer_id", "segment", F.when(F.month("valid_from") != 2, F.col("valid_from")).alias("valid_from")
    )
    return history.number_versions(dim, hot=hot).select("customer_id", "valid_from", "segment", "version")


def _filled(spark, sf, hot):
    """History of filled orders only: late for some customers, absent for others."""
    filled = i.order_history_events(spark, sf).where(F.col("event_type") == "F")
    return history.build_dim_customer(filled, hot=hot)


def scd2_point_in_time(spark, sf):
    orders = i.order_history_events(spark, sf).select("event_id", "customer_id", "event_ts")
    hot = _hot(spark, sf)
    return history.point_in_time(orders, _filled(spark, sf, hot), spread_by=["event_id"], hot=hot)


def scd2_truth_reconcile(spark, sf):
    """Histories built without pending and without open orders, against each other."""
    events = i.order_history_events(spark, sf)
    hot = _hot(spark, sf)
    rebuilt = history.build_dim_customer(events.where(F.col("event_type") != "P"), hot=hot)
    truth = history.build_dim_customer(events.where(F.col("event_type") != "O"), hot=hot)
    return history.reconcile_history(rebuilt, truth, hot=hot)


def scd2_truth_along_time(spark, sf):
    """The history without each customer's second version and with a wrong segment from April on, against itself."""
    hot = _hot(spark, sf)
    truth = _dim(spark, sf, hot)
    lost = history.number_versions(truth, hot=hot).where(F.col("version") != 2)
    segment = F.when(F.month("valid_from") == 4, "9-VIP").otherwise(F.col("segment"))
    return history.reconcile_slices(lost.withColumn("segment", segment), truth, hot=hot)


# ---- facts -----------------------------------------------------------------


def fact_engagement_daily(spark, sf):
    return facts.build_fact_engagement_daily(i.daily_events(spark, sf))


def fact_null_amounts(spark, sf):
    """Errors and views carry no amount: they count as events and add nothing."""
    amount = F.when(~F.col("event_type").isin("error", "view"), F.col("amount_cents"))
    return facts.build_fact_engagement_daily(i.daily_events(spark, sf).withColumn("amount_cents", amount))


def dim_offer(spark, sf):
    return facts.build_dim_offer(fact_engagement_daily(spark, sf), offer_types=("view", "purchase"))


def fact_by_segment(spark, sf):
    """The daily fact joined to the customer version valid on the day, per segment and type."""
    fact = facts.build_fact_engagement_daily(i.order_history_events(spark, sf))
    hot = _hot(spark, sf)
    return (
        history.point_in_time(fact, _filled(spark, sf, hot), ts="event_date", hot=hot)
        .groupBy("segment", "event_type")
        .agg(F.sum("n_events").alias("n_events"), F.sum("total_amount_cents").alias("total_amount_cents"))
    )


# ---- gates and promotion ---------------------------------------------------


def _facts(spark, sf):
    events = i.loaded_events(spark, sf)
    return gates.batch_facts(events, i.known_customers(spark, sf), **DOMAIN)


def _scorecard(spark, sf):
    return gates.scorecard_of(_facts(spark, sf), **DOMAIN)


def batch_discovery(spark, sf):
    return list_batches(i.order_events(spark, sf))


def gate_scorecard(spark, sf):
    return _scorecard(spark, sf)


def gate_malformed_amount(spark, sf):
    """Orders as JSON lines; pending ones have an amount with decimals in May, and as text in June."""
    fields = [c for c in EVENT.names if c not in ("ts", "amount_cents")]
    number = F.lit('"amount_cents":')
    amount = F.col("amount_cents").cast("string")
    pending = F.col("event_type") == "P"
    written = (
        F.when(pending & (F.month("ts") == 5), F.concat(number, F.lit("-"), amount, F.lit(".5")))
        .when(pending & (F.month("ts") == 6), F.concat(number, F.lit('"-'), amount, F.lit('x"')))
        .otherwise(F.concat(number, amount))
    )
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts")
    line = F.concat(F.lit("{"), written, F.lit(","), F.substr(F.to_json(F.struct(*fields, stamp)), F.lit(2)))
    read = F.from_json(line, RAW, {"columnNameOfCorruptRecord": CORRUPT})
    events = i.order_events(spark, sf).select("batch", read.alias("e")).select("batch", "e.*")
    known = i.known_customers(spark, sf).select(F.col("customer_id").cast("string"))
    return gates.gate_scorecard(events, known, gates=("required_fields",), **DOMAIN)


def gate_cardinality_drift(spark, sf):
    drift = gates.drift_table(_facts(spark, sf), **DOMAIN)
    return drift.select(
        "batch",
        "segment",
        F.round("share", 6).alias("share"),
        F.round("prior_share", 6).alias("prior_share"),
        F.round("drift", 6).alias("drift"),
        "passed",
    )


def gate_freshness(spark, sf):
    """Every month orders fall into is expected; the pending orders of March never arrived."""
    events = i.order_events(spark, sf)
    manifest = gates.month_manifest(events)
    arrived = events.where((F.month("ts") != 3) | (F.col("event_type") == "P")).where(F.month("ts") != 4)
    return gates.gate_scorecard(arrived, i.known_customers(spark, sf), manifest, gates=("freshness",), **DOMAIN)


def gate_absent_column(spark, sf):
    """Orders that came without a segment column, the pending ones without type."""
    kind = F.when(F.col("event_type") != "P", F.col("event_type"))
    events = i.order_events(spark, sf).drop("segment_at_event").withColumn("event_type", kind)
    return gates.gate_scorecard(events, i.known_customers(spark, sf), gates=("required_fields",), **DOMAIN)


def gate_future_events(spark, sf):
    """The orders judged as on New Year 1996: what came later lies in the future."""
    as_of = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    return gates.gate_scorecard(
        i.order_events(spark, sf), i.known_customers(spark, sf), gates=("range_outliers",), as_of=as_of, **DOMAIN
    )


def gate_drift_given_prior(spark, sf):
    """As `gate_cardinality_drift`; the first batch is compared with the counts of all batches."""
    events = i.loaded_events(spark, sf)
    prior = events.groupBy("segment_at_event").agg(F.count("*").alias("n"))
    judged = gates.batch_facts(events, i.known_customers(spark, sf), prior_counts=prior, **DOMAIN)
    drift = gates.drift_table(judged, **DOMAIN)
    shares = [F.round(c, 6).alias(c) for c in ("share", "prior_share", "drift")]
    return drift.select("batch", "segment", *shares, "passed")


def failed_gates(spark, sf):
    return gates.failed_gates(_scorecard(spark, sf))


def gate_alerts(spark, sf):
    return gates.gate_alerts(_scorecard(spark, sf)).select("batch", "message")


def promoted_rows(spark, sf):
    return gates.promoted_rows(i.loaded_events(spark, sf), _scorecard(spark, sf))


def _promoted(spark, sf):
    return promoted_rows(spark, sf).withColumnRenamed("ts", "event_ts")


def gold_dim_customer(spark, sf):
    # No customer has more promoted events than orders, but for those of known defects.
    return history.build_dim_customer(_promoted(spark, sf), hot=_hot(spark, sf))


def gold_fact_engagement_daily(spark, sf):
    return facts.build_fact_engagement_daily(_promoted(spark, sf))


def gold_dim_offer(spark, sf):
    return facts.build_dim_offer(gold_fact_engagement_daily(spark, sf), offer_types=("O", "F"))


def referential_orphans(spark, sf):
    return gates.orphans(i.order_events(spark, sf), i.solvent_customers(spark, sf))


# ---- bronze and silver -----------------------------------------------------


def json_events(spark, sf):
    """Orders written as JSON lines and read back under the declared event schema."""
    time = F.when(F.col("event_type") == "P", "n/a").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    )
    fields = [c for c in EVENT.names if c not in ("ts", "amount_cents")]
    amount = F.when(F.col("event_type") != "O", F.col("amount_cents"))
    line = F.to_json(F.struct(*fields, amount.alias("amount_cents"), time.alias("ts")))
    events = i.order_events(spark, sf).select(F.from_json(line, EVENT).alias("e")).select("e.*")
    return with_event_ts(events).select(
        "event_id", "customer_id", "amount_cents", F.unix_seconds("event_ts").alias("epoch")
    )


def landed_batches(spark, sf):
    """Orders written as JSON lines, one file or more a month, landed and read back from bronze."""
    root = i.scratch(spark)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts")
    fields = [c for c in EVENT.names if c != "ts"]
    lines = i.order_events(spark, sf).select(
        F.to_json(F.struct(*fields, stamp)).alias("value"), F.concat("batch", F.lit(".jsonl")).alias("month")
    )
    lines.repartition("month").write.partitionBy("month").text(f"{root}/in")
    bronze = land_bronze(spark, f"{root}/in", f"{root}/bronze")
    return bronze.groupBy(F.substr("batch", F.lit(7)).alias("batch")).agg(
        F.count("event_ts").alias("n_rows"), F.sum("amount_cents").alias("amount_cents")
    )


# The warehouse of the monthly run over each input, written once in a Spark application and read by all queries over it.
_RUNS: dict[tuple[str, str], Warehouse] = {}


def _stored_run(spark, sf):
    """A monthly run over written tables."""
    done = (spark.sparkContext.applicationId, sf)
    if done in _RUNS:
        return _RUNS[done]
    warehouse = Warehouse(i.scratch(spark))
    write_bronze(i.bronze_events(spark, sf), warehouse.bronze)
    known = i.known_customers(spark, sf).select(F.col("customer_id").cast("string"))
    run_monthly(spark, warehouse, known, start=None, segments=i.PRIORITIES, offer_types=("O", "F"))
    _RUNS[done] = warehouse
    return warehouse


def stored_silver(spark, sf):
    silver_rows = tables.read_silver(spark, _stored_run(spark, sf).silver)
    return silver_rows.groupBy("batch").agg(
        F.count_if(F.col("zone") == silver.CLEAN).alias("n_clean"), F.count_if(F.col("zone") == silver.REJECTS).alias("n_rejects")
    )


def stored_gold_fact(spark, sf):
    """The fact as the run stored it, through a view over its files, in the declared order."""
    path = tables.gold_path(spark, _stored_run(spark, sf).gold, "fact_engagement_daily")
    tables.open_view(spark, path, "stored_fact", GOLD["fact_engagement_daily"])
    return spark.sql(
        """SELECT CAST(customer_id AS BIGINT) AS customer_id, event_date, event_type, n_events, total_amount_cents
           FROM stored_fact"""
    )


def registered_gold(spark, sf):
    """Rows and columns of the gold tables of the run, by their names in the catalog, held against their contracts."""
    warehouse = _stored_run(spark, sf)
    database = "gold_" + warehouse.root.rsplit("/", 1)[-1].replace("-", "")
    counted = []
    for name, table in zip(GOLD, tables.register_gold(spark, warehouse.gold, database)):
        rows = assert_contract(spark.table(table), GOLD[name], name)
        counted.append(rows.agg(F.lit(name).alias("name"), F.count("*").alias("n_rows"), F.lit(len(rows.columns)).alias("n_columns")))
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def cleaned_batches(spark, sf):
    """The defective orders in batches of a year, each cleaned into silver by itself."""
    warehouse = Warehouse(i.scratch(spark))
    yearly = i.bronze_events(spark, sf).withColumn("batch", F.substr("batch", F.lit(1), F.lit(4)))
    write_bronze(yearly, warehouse.bronze)
    batches = [r.batch for r in list_batches(yearly).orderBy("batch").collect()]  # one row per batch
    stats = [clean_batch(spark, warehouse, batch) for batch in batches]
    kinds = "batch string, bronze_rows bigint, silver_rows bigint, rejects bigint, duplicates bigint, reconciled boolean"
    return spark.createDataFrame([tuple(s[c.split()[0]] for c in kinds.split(", ")) for s in stats], kinds)


def _gold(spark, sf, name):
    return tables.read_gold(spark, _stored_run(spark, sf).gold, name)


def dim_customer_in_order(spark, sf):
    """The stored history, numbered by customer and time; customer ids are text here."""
    dim = _gold(spark, sf, "dim_customer").select("customer_id", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"), "segment")
    return numbered(dim, ["customer_id", "valid_from"], range_rows=RANGE_ROWS)


def fact_in_order(spark, sf):
    fact = _gold(spark, sf, "fact_engagement_daily")
    return numbered(fact, ["customer_id", "event_date", "event_type"], range_rows=RANGE_ROWS)


def dim_offer_in_order(spark, sf):
    return numbered(_gold(spark, sf, "dim_offer"), ["event_type"])


def retention_in_order(spark, sf):
    """Segments by customers now in them, most first."""
    cohorts = facts.cohort_retention(_gold(spark, sf, "dim_customer"))
    now = "customers_currently_in_segment"
    return numbered(cohorts, [now, "segment"], descending=(now,))


def stored_quality_report(spark, sf):
    path = i.scratch(spark)
    tables.write_quality_report(quality.evaluate(i.value_checks(spark, sf)), path, "workload")
    return spark.read.schema("dimension string, score double").json(f"{path}/score")


def duplicate_keys(spark, sf):
    return gates.duplicate_keys(i.line_events(spark, sf), ["l_orderkey", "l_linenumber"])


def _lines(spark, sf):
    return silver.zone_rows(
        i.line_events(spark, sf), keys=("l_orderkey", "l_linenumber"), required=("supplier", "l_partkey", "ts")
    )


def silver_dedupe(spark, sf):
    return _lines(spark, sf).drop("event_ts")


def silver_rejects(spark, sf):
    return silver.zone(_lines(spark, sf), silver.REJECTS).drop("event_ts")


def silver_reconcile(spark, sf):
    return silver.silver_stats(_lines(spark, sf))


def silver_reconcile_batches(spark, sf):
    return silver.silver_stats(silver.zone_rows(i.loaded_events(spark, sf)))


# ---- ledgers ---------------------------------------------------------------


def cost_by_pipeline(spark, sf):
    return ledger.cost_by_pipeline(ledger.record_runs(i.order_runs(spark, sf)))


def cost_total_by_pipeline(spark, sf):
    return ledger.total_cost_by_pipeline(ledger.record_runs(i.order_runs(spark, sf)))


def cost_shared_split(spark, sf):
    return ledger.split_shared_cost(i.event_runs(spark, sf), F.lit(100.0))


def _sla(spark, sf):
    return ledger.check_sla(i.event_runs(spark, sf), i.click_alerts(spark, sf), sla_seconds=100)


def sla_first_alert(spark, sf):
    return _sla(spark, sf).checks


def sla_alert_messages(spark, sf):
    return _sla(spark, sf).new_alerts


def sla_breach_count(spark, sf):
    alerts = i.click_alerts(spark, sf).unionByName(_sla(spark, sf).new_alerts.select("alert_id"))
    return ledger.breach_count(alerts)


def sla_run_elapsed(spark, sf):
    starts = i.day_runs(spark, sf, "signup", "started_at")
    ends = i.day_runs(spark, sf, "purchase", "ended_at")
    return ledger.check_run_sla(starts, ends, i.click_alerts(spark, sf), sla_seconds=3600).checks


def sla_run_alerted(spark, sf):
    """As `sla_run_elapsed`; runs of days with an error were alerted before."""
    starts = i.day_runs(spark, sf, "signup", "started_at")
    ends = i.day_runs(spark, sf, "purchase", "ended_at")
    return ledger.check_run_sla(starts, ends, i.run_alerts(spark, sf), sla_seconds=3600).checks


def sla_run_messages(spark, sf):
    starts = i.day_runs(spark, sf, "signup", "started_at")
    ends = i.day_runs(spark, sf, "purchase", "ended_at")
    return ledger.check_run_sla(starts, ends, i.run_alerts(spark, sf), sla_seconds=3600).new_alerts


def ledger_latest(spark, sf):
    return latest_per_key(i.table(spark, sf, "events"), ["user_id"], [F.col("ts")])


# ---- quality ---------------------------------------------------------------


def quality_score(spark, sf):
    return quality.score(quality.evaluate(i.value_checks(spark, sf)))


def quality_failed_checks(spark, sf):
    return quality.failed_checks(quality.evaluate(i.value_checks(spark, sf)))


# ---- vectors ---------------------------------------------------------------


def vector_topk_l2(spark, sf):
    """Every vector's five nearest of its own label."""
    v = i.vectors(spark, sf)
    found = vectors.knn(v.withColumnRenamed("id", "query_id"), v, k=5, metric="l2", on=["label"])
    return found.select("query_id", "id", "rank", F.round("distance", 5).alias("distance"))


def vector_topk_cosine(spark, sf):
    """Five nearest of all labels, with their labels, of every vector whose id is divisible by 20."""
    v = i.vectors(spark, sf)
    asked = v.where(F.col("id") % 20 == 0).withColumnRenamed("id", "query_id")
    found = vectors.knn(asked, v, k=5, metric="cosine")
    labelled = vectors.with_metadata(found, v)
    return labelled.select("query_id", "id", "rank", F.round("distance", 5).alias("distance"), "label")


def vector_topk_dirty(spark, sf):
    """Some labels' vectors hold a NaN, some a null, some are shorter than the others."""
    kind, e = F.col("label") % 4, F.col("embedding")
    broken = F.transform(e, lambda x, n: F.when(n == 3, F.when(kind == 1, float("nan"))).otherwise(x).cast("float"))
    v = i.vectors(spark, sf).withColumn(
        "embedding", F.when(kind.isin(1, 2), broken).when(kind == 3, F.slice(e, 1, 8)).otherwise(e)
    )
    found = vectors.knn(v.where(F.col("id") % 20 == 0).withColumnRenamed("id", "query_id"), v, k=5, metric="l2")
    return found.select("query_id", "id", "rank", F.round("distance", 5).alias("distance"))


def vector_upsert(spark, sf):
    """Vectors of the upper labels were upserted again under a lower label."""
    first = i.vectors(spark, sf).withColumn("updated_at", F.lit(1))
    again = first.where("label >= 5").withColumn("label", F.col("label") - 5).withColumn("updated_at", F.lit(2))
    latest = vectors.latest_vectors(first.unionByName(again))
    return latest.select("id", "label", "updated_at", F.size("embedding").alias("n_dims"))


QUERIES = {
    f.__name__: f
    for f in (
        scd2_dim_customer,
        cohort_retention,
        cohort_summary,
        scd2_overlap_audit,
        scd2_overlap_clean,
        scd2_overlap_pairs,
        scd2_multi_current,
        scd2_fingerprint,
        scd2_version_numbers,
        version_numbers_null_time,
        scd2_point_in_time,
        scd2_truth_reconcile,
        scd2_truth_along_time,
        fact_engagement_daily,
        fact_null_amounts,
        dim_offer,
        fact_by_segment,
        batch_discovery,
        gate_scorecard,
        gate_malformed_amount,
        gate_cardinality_drift,
        gate_freshness,
        gate_absent_column,
        gate_future_events,
        gate_drift_given_prior,
        failed_gates,
        gate_alerts,
        promoted_rows,
        gold_dim_customer,
        gold_fact_engagement_daily,
        gold_dim_offer,
        referential_orphans,
        json_events,
        landed_batches,
        stored_silver,
        stored_gold_fact,
        registered_gold,
        cleaned_batches,
        dim_customer_in_order,
        fact_in_order,
        dim_offer_in_order,
        retention_in_order,
        stored_quality_report,
        duplicate_keys,
        silver_dedupe,
        silver_rejects,
        silver_reconcile,
        silver_reconcile_batches,
        cost_by_pipeline,
        cost_total_by_pipeline,
        cost_shared_split,
        sla_first_alert,
        sla_alert_messages,
        sla_breach_count,
        sla_run_elapsed,
        sla_run_alerted,
        sla_run_messages,
        ledger_latest,
        quality_score,
        quality_failed_checks,
        vector_topk_l2,
        vector_topk_cosine,
        vector_topk_dirty,
        vector_upsert,
    )
}
