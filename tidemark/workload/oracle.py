"""The results of `queries` in plain SQL, written for DuckDB and without our operators."""

from __future__ import annotations

# Orders as events in monthly batches, and the same with the defects of `loaded_events`.
BASE = """
base AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS batch, month(o_orderdate) AS m, o_orderkey AS event_id,
         o_custkey AS customer_id, o_orderstatus AS event_type, o_orderpriority AS segment_at_event,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents, o_orderdate AS ts
  FROM orders
)"""

LOADED = (
    BASE
    + """,
repeated AS (
  SELECT * FROM base UNION ALL SELECT * FROM base WHERE m = 5 AND segment_at_event = '1-URGENT'
),
loaded AS (
  SELECT batch, event_id,
         CASE WHEN m = 2 AND segment_at_event = '1-URGENT' THEN -customer_id ELSE customer_id END AS customer_id,
         CASE WHEN m = 3 AND event_type = 'P' THEN NULL ELSE event_type END AS event_type,
         CASE WHEN m IN (8, 12) AND segment_at_event = '5-LOW' THEN '9-VIP' WHEN m = 10 THEN '1-URGENT'
              ELSE segment_at_event END AS segment_at_event,
         CASE WHEN m = 7 AND segment_at_event = '5-LOW' THEN -amount_cents ELSE amount_cents END AS amount_cents,
         CASE WHEN m = 12 THEN ts - INTERVAL 1 YEAR ELSE ts END AS ts
  FROM repeated
)"""
)

DOMAIN = "('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')"

# One row per batch and segment of the domain, with the share and the share one batch earlier.
SHARES = f"""
domain(segment) AS (VALUES {DOMAIN}),
sizes AS (SELECT batch, count(*) AS n FROM loaded GROUP BY batch),
ordered AS (SELECT batch, n, lag(batch) OVER (ORDER BY batch) AS prior_batch FROM sizes),
counted AS (SELECT batch, segment_at_event AS segment, count(*) AS n FROM loaded GROUP BY 1, 2),
grid AS (
  SELECT o.batch, d.segment, o.prior_batch,
         coalesce(c.n, 0) / CAST(o.n AS DOUBLE) AS share,
         coalesce(p.n, 0) / CAST(q.n AS DOUBLE) AS prior_share
  FROM ordered o CROSS JOIN domain d
  LEFT JOIN counted c ON c.batch = o.batch AND c.segment = d.segment
  LEFT JOIN sizes q ON q.batch = o.prior_batch
  LEFT JOIN counted p ON p.batch = o.prior_batch AND p.segment = d.segment
),
shares AS (SELECT *, abs(share - prior_share) AS drift FROM grid)"""

SCORECARD = (
    LOADED
    + ","
    + SHARES
    + """,
null_fields AS (
  SELECT batch, 1 AS k, 'event_id' AS f, count(*) FILTER (WHERE event_id IS NULL) AS n FROM loaded GROUP BY batch
  UNION ALL SELECT batch, 2, 'customer_id', count(*) FILTER (WHERE customer_id IS NULL) FROM loaded GROUP BY batch
  UNION ALL SELECT batch, 3, 'event_type', count(*) FILTER (WHERE event_type IS NULL) FROM loaded GROUP BY batch
  UNION ALL SELECT batch, 4, 'segment_at_event', count(*) FILTER (WHERE segment_at_event IS NULL)
            FROM loaded GROUP BY batch
  UNION ALL SELECT batch, 5, 'ts', count(*) FILTER (WHERE ts IS NULL) FROM loaded GROUP BY batch
),
required AS (
  SELECT s.batch, string_agg('''' || f || ''': ' || nf.n, ', ' ORDER BY k) AS missing
  FROM sizes s LEFT JOIN null_fields nf ON nf.batch = s.batch AND nf.n > 0 GROUP BY s.batch
),
repeats AS (SELECT batch, count(*) - count(DISTINCT event_id) AS n FROM loaded GROUP BY batch),
unknown AS (
  SELECT batch, count(*) FILTER (WHERE customer_id NOT IN (SELECT c_custkey FROM customer)) AS n
  FROM loaded GROUP BY batch
),
ranges AS (
  SELECT batch, count(*) FILTER (WHERE amount_cents < 0) AS neg,
         count(*) FILTER (WHERE segment_at_event NOT IN (SELECT segment FROM domain)) AS vip
  FROM loaded GROUP BY batch
),
drifted AS (
  SELECT batch, bool_or(prior_batch IS NULL) AS no_prior, min(segment) FILTER (WHERE drift > 0.30) AS segment,
         arg_min(drift, segment) FILTER (WHERE drift > 0.30) AS drift
  FROM shares GROUP BY batch
),
fresh AS (SELECT batch, count(*) FILTER (WHERE strftime(ts, '%Y-%m') = batch) AS n FROM loaded GROUP BY batch),
scorecard AS (
  SELECT batch, 1 AS seq, 'required_fields' AS gate, missing IS NULL AS passed,
         CASE WHEN missing IS NULL THEN '' ELSE 'null/missing: {' || missing || '}' END AS detail FROM required
  UNION ALL
  SELECT batch, 2, 'duplicates', n = 0, CASE WHEN n = 0 THEN '' ELSE n || ' duplicate event_id(s)' END FROM repeats
  UNION ALL
  SELECT batch, 3, 'referential_integrity', n = 0,
         CASE WHEN n = 0 THEN '' ELSE n || ' events reference unknown customers' END FROM unknown
  UNION ALL
  SELECT batch, 4, 'range_outliers', neg = 0 AND vip = 0,
         CASE WHEN neg > 0 THEN neg || ' events with negative amount_cents'
              WHEN vip > 0 THEN vip || ' events with an unknown segment value' ELSE '' END FROM ranges
  UNION ALL
  SELECT batch, 5, 'cardinality_drift', segment IS NULL,
         CASE WHEN no_prior THEN 'no prior month to compare' WHEN segment IS NULL THEN ''
              ELSE segment || ' share drifted ' || round(drift * 100, 1) || '%' END FROM drifted
  UNION ALL
  SELECT batch, 6, 'freshness', n > 0,
         CASE WHEN n > 0 THEN '' ELSE 'no events found for expected month ' || batch END FROM fresh
)"""
)

PROMOTED = (
    SCORECARD
    + """,
promoted AS (
  SELECT l.* FROM loaded l
  WHERE l.batch IN (SELECT batch FROM scorecard GROUP BY batch HAVING bool_and(passed))
)"""
)


def scd2(events: str, name: str = "dim", ts: str = "ts") -> str:
    """CTEs ending in `name`: the history of an events relation."""
    return f"""
{name}_e AS (
  SELECT customer_id, {ts} AS valid_from, min(segment_at_event) AS segment FROM {events} GROUP BY 1, 2
),
{name}_p AS (SELECT *, lag(segment) OVER (PARTITION BY customer_id ORDER BY valid_from) AS prev FROM {name}_e),
{name}_t AS (SELECT customer_id, segment, valid_from FROM {name}_p WHERE prev IS NULL OR prev <> segment),
{name}_d AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to FROM {name}_t
),
{name} AS (SELECT customer_id, segment, valid_from, valid_to, valid_to IS NULL AS is_current FROM {name}_d)"""


DIM = BASE + "," + scd2("base")

BROKEN = (
    DIM
    + """,
broken AS (
  SELECT customer_id, segment, valid_from, CASE WHEN segment = '1-URGENT' THEN NULL ELSE valid_to END AS valid_to,
         is_current OR segment = '1-URGENT' AS is_current
  FROM dim
)"""
)

FILLED = BASE + ", filled AS (SELECT * FROM base WHERE event_type = 'F')," + scd2("filled")


def in_force(events: str, key: str, ts: str) -> str:
    """CTE `resolved`: each row of an events relation with the version in force at its time."""
    return f"""
resolved AS (
  SELECT e.*,
         coalesce(arg_max(d.segment, d.valid_from) FILTER (WHERE d.valid_from <= e.{ts}),
                  arg_min(d.segment, d.valid_from)) AS segment,
         coalesce(max(d.valid_from) FILTER (WHERE d.valid_from <= e.{ts}), min(d.valid_from)) AS valid_from
  FROM {events} e LEFT JOIN dim d ON d.customer_id = e.customer_id
  GROUP BY {key}
)"""


LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END AS supplier,
         l_partkey, l_quantity, l_shipdate AS ts
  FROM lineitem
),
picked AS (
  SELECT *, row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber
              ORDER BY supplier IS NULL OR l_partkey IS NULL OR ts IS NULL, ts NULLS FIRST, supplier NULLS FIRST,
                       l_partkey NULLS FIRST, l_quantity NULLS FIRST) AS rn,
            count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n_copies
  FROM lines
),
survivors AS (
  SELECT l_orderkey, l_linenumber, supplier, l_partkey, l_quantity, ts, n_copies,
         CASE WHEN supplier IS NULL OR l_partkey IS NULL OR ts IS NULL THEN 'rejects' ELSE 'clean' END AS zone
  FROM picked WHERE rn = 1
)"""

EVENT_RUNS = """
runs AS (
  SELECT event_id AS run_id, event_type AS pipeline_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS run_date,
         CAST(round(value * 1000000) AS BIGINT) AS bytes_processed, value AS duration_seconds, ts AS checked_at
  FROM events
),
judged AS (
  SELECT *, pipeline_id || '#' || run_date AS alert_id, duration_seconds > 100 AS breached,
         CASE WHEN duration_seconds > 100 THEN row_number() OVER (
           PARTITION BY pipeline_id, run_date, duration_seconds > 100 ORDER BY checked_at, run_id) END AS nth
  FROM runs
)"""

CHECKS = """
checks AS (
  SELECT CASE event_type WHEN 'click' THEN 'completeness' WHEN 'view' THEN 'correctness'
                         WHEN 'purchase' THEN 'consistency' WHEN 'signup' THEN 'validity'
                         ELSE 'timeliness' END AS dimension,
         'event_' || event_id AS name, value AS measured, CAST(20.0 AS DOUBLE) AS threshold,
         event_type NOT IN ('view', 'error') AS higher_is_better, props AS detail
  FROM events
),
judged AS (
  SELECT *, CASE WHEN higher_is_better THEN measured >= threshold ELSE measured <= threshold END AS passed
  FROM checks
)"""

# Runs of a user and day with their time, and whether a day with an error was alerted before.
ALERTED_RUNS = """
starts AS (SELECT user_id || '@' || CAST(ts AS DATE) AS run_id, max(ts) AS s FROM events WHERE event_type = 'signup' GROUP BY 1),
ends AS (SELECT user_id || '@' || CAST(ts AS DATE) AS run_id, max(ts) AS e FROM events WHERE event_type = 'purchase' GROUP BY 1),
told AS (SELECT DISTINCT user_id || '@' || CAST(ts AS DATE) AS run_id FROM events WHERE event_type = 'error'),
timed AS (
  SELECT run_id, CAST(floor(epoch(e)) - floor(epoch(s)) AS BIGINT) AS elapsed_seconds, run_id IN (SELECT run_id FROM told) AS told
  FROM ends LEFT JOIN starts USING (run_id)
)"""

# The gold tables with customers as text, as a run stores them.
STORED_DIM = (
    PROMOTED
    + ","
    + scd2("promoted")
    + """,
stored AS (SELECT CAST(customer_id AS VARCHAR) AS customer_id, segment, valid_from, is_current FROM dim)"""
)

STORED_FACT = (
    PROMOTED
    + """,
fact AS (
  SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(ts AS DATE) AS event_date, event_type, count(*) AS n_events,
         CAST(sum(coalesce(amount_cents, 0)) AS BIGINT) AS total_amount_cents
  FROM promoted GROUP BY 1, 2, 3
),
offer AS (
  SELECT event_type, CAST(sum(n_events) AS BIGINT) AS n_events, count(DISTINCT customer_id) AS n_distinct_customers,
         'offer_' || event_type AS offer_id
  FROM fact WHERE event_type IN ('O', 'F') GROUP BY event_type
)"""
)

COHORTS = """
cohorts AS (
  SELECT segment, CAST(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) AS n_now,
         count(DISTINCT customer_id) AS n_ever
  FROM dim GROUP BY segment
)"""

ORACLE = {
    # ---- history
    "scd2_dim_customer": f"WITH {DIM} SELECT * FROM dim",
    "cohort_retention": f"""WITH {DIM}, {COHORTS}
  SELECT segment, n_now AS customers_currently_in_segment, n_ever AS customers_ever_in_segment,
         round(100 * CAST(n_now AS DOUBLE) / n_ever, 1) AS retention_pct
  FROM cohorts""",
    "cohort_summary": f"""WITH {DIM}, {COHORTS}
  SELECT segment, n_now AS customers_currently_in_segment, n_ever AS customers_ever_in_segment FROM cohorts""",
    # Every earlier version still open at a start, by brute force; our operator never forms these pairs.
    "scd2_overlap_audit": f"""WITH {BROKEN}
  SELECT late.customer_id, late.valid_from, count(DISTINCT late.segment) AS n_starting, count(*) AS n_open
  FROM broken late JOIN broken early USING (customer_id)
  WHERE early.valid_from < late.valid_from AND (early.valid_to IS NULL OR early.valid_to > late.valid_from)
  GROUP BY 1, 2""",
    "scd2_overlap_pairs": f"""WITH {BROKEN}
  SELECT early.customer_id, early.valid_from AS from_a, early.segment AS segment_a, early.valid_to AS to_a,
         late.valid_from AS from_b, late.segment AS segment_b
  FROM broken late JOIN broken early USING (customer_id)
  WHERE early.valid_from < late.valid_from AND (early.valid_to IS NULL OR early.valid_to > late.valid_from)""",
    "scd2_overlap_clean": f"""WITH {DIM}
  SELECT count(*) AS n_overlaps FROM dim late JOIN dim early USING (customer_id)
  WHERE early.valid_from < late.valid_from AND (early.valid_to IS NULL OR early.valid_to > late.valid_from)""",
    "scd2_multi_current": f"""WITH {BROKEN}
  SELECT customer_id, n_current
  FROM (SELECT customer_id, count(*) FILTER (WHERE is_current) AS n_current FROM broken GROUP BY customer_id)
  WHERE n_current > 1""",
    "scd2_fingerprint": f"""WITH {DIM},
  digests AS (
    SELECT sha256(concat(
      {", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')"
                 for c in ("customer_id", "segment", "valid_from", "valid_to", "is_current"))})) AS d
    FROM dim
  )
  SELECT count(*) AS n_rows,
         CAST(sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS VARCHAR) AS hash_hi,
         CAST(sum(CAST('0x' || substr(d, 16, 15) AS BIGINT)) AS VARCHAR) AS hash_lo
  FROM digests""",
    "scd2_version_numbers": f"""WITH {DIM}
  SELECT customer_id, valid_from, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS version
  FROM dim""",
    "version_numbers_null_time": f"""WITH {DIM},
  blurred AS (
    SELECT customer_id, segment, CASE WHEN month(valid_from) <> 2 THEN valid_from END AS valid_from FROM dim
  )
  SELECT customer_id, valid_from, segment,
         row_number() OVER (PARTITION BY customer_id ORDER BY valid_from NULLS FIRST, segment) AS version
  FROM blurred""",
    "scd2_point_in_time": f"""WITH {FILLED},
  asked AS (SELECT event_id, customer_id, ts AS event_ts FROM base),
  {in_force("asked", "e.event_id, e.customer_id, e.event_ts", "event_ts")}
  SELECT * FROM resolved""",
    "scd2_truth_reconcile": f"""WITH {BASE},
  g AS (SELECT * FROM base WHERE event_type <> 'P'), w AS (SELECT * FROM base WHERE event_type <> 'O'),
  {scd2("g", "got")}, {scd2("w", "want")},
  gv AS (SELECT customer_id, segment,
                row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS version FROM got),
  wv AS (SELECT customer_id, segment AS true_segment,
                row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS version FROM want)
  SELECT customer_id, version, segment, true_segment,
         CASE WHEN segment IS NULL THEN 'missing' WHEN true_segment IS NULL THEN 'extra'
              WHEN segment = true_segment THEN 'match' ELSE 'wrong_segment' END AS status
  FROM gv FULL OUTER JOIN wv USING (customer_id, version)""",
    "scd2_truth_along_time": f"""WITH {DIM},
  numbered AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS version FROM dim),
  got AS (
    SELECT customer_id, CASE WHEN month(valid_from) = 4 THEN '9-VIP' ELSE segment END AS segment, valid_from, valid_to
    FROM numbered WHERE version <> 2
  )
  SELECT d.customer_id, d.valid_from, d.valid_to, g.segment, d.segment AS true_segment,
         CASE WHEN g.customer_id IS NULL THEN 'missing' WHEN g.segment = d.segment THEN 'match'
              ELSE 'wrong_segment' END AS status
  FROM dim d LEFT JOIN got g ON g.customer_id = d.customer_id AND g.valid_from = d.valid_from""",
    # ---- facts
    "fact_engagement_daily": """
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS event_date, event_type, count(*) AS n_events,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_amount_cents
  FROM events GROUP BY 1, 2, 3""",
    "fact_null_amounts": """
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS event_date, event_type, count(*) AS n_events,
         CAST(sum(CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END) AS BIGINT)
           AS total_amount_cents
  FROM events GROUP BY 1, 2, 3""",
    "dim_offer": """
  SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_distinct_customers,
         'offer_' || event_type AS offer_id
  FROM events WHERE event_type IN ('view', 'purchase') GROUP BY event_type""",
    "fact_by_segment": f"""WITH {FILLED},
  fact AS (
    SELECT customer_id, CAST(ts AS DATE) AS event_date, event_type, count(*) AS n_events,
           sum(amount_cents) AS cents
    FROM base GROUP BY 1, 2, 3
  ),
  {in_force("fact", "e.customer_id, e.event_date, e.event_type, e.n_events, e.cents", "event_date")}
  SELECT segment, event_type, CAST(sum(n_events) AS BIGINT) AS n_events,
         CAST(sum(cents) AS BIGINT) AS total_amount_cents
  FROM resolved GROUP BY 1, 2""",
    # ---- gates and promotion
    "batch_discovery": f"WITH {BASE} SELECT batch, count(*) AS n_rows FROM base GROUP BY batch",
    "gate_scorecard": f"WITH {SCORECARD} SELECT * FROM scorecard",
    "gate_cardinality_drift": f"""WITH {LOADED}, {SHARES}
  SELECT batch, segment, round(share, 6) AS share, round(prior_share, 6) AS prior_share,
         round(drift, 6) AS drift, NOT drift > 0.30 AS passed
  FROM shares WHERE prior_batch IS NOT NULL""",
    "gate_freshness": f"""WITH {BASE}
  SELECT batch, 6 AS seq, 'freshness' AS gate,
         count(*) FILTER (WHERE m <> 4 AND (m <> 3 OR event_type = 'P')) > 0 AS passed,
         CASE WHEN count(*) FILTER (WHERE m <> 4 AND (m <> 3 OR event_type = 'P')) > 0 THEN ''
              ELSE 'no events found for expected month ' || batch END AS detail
  FROM base GROUP BY batch""",
    "gate_malformed_amount": """
  SELECT strftime(o_orderdate, '%Y-%m') AS batch, 1 AS seq, 'required_fields' AS gate,
         count(*) FILTER (WHERE month(o_orderdate) IN (5, 6) AND o_orderstatus = 'P') = 0 AS passed,
         CASE WHEN count(*) FILTER (WHERE month(o_orderdate) IN (5, 6) AND o_orderstatus = 'P') = 0 THEN ''
              ELSE 'null/missing: {''line'': not readable in '
                   || count(*) FILTER (WHERE month(o_orderdate) IN (5, 6) AND o_orderstatus = 'P') || '}' END AS detail
  FROM orders GROUP BY batch""",
    "gate_absent_column": f"""WITH {BASE}
  SELECT batch, 1 AS seq, 'required_fields' AS gate, false AS passed,
         'null/missing: {{' || CASE WHEN count(*) FILTER (WHERE event_type = 'P') > 0
           THEN '''event_type'': ' || count(*) FILTER (WHERE event_type = 'P') || ', ' ELSE '' END
         || '''segment_at_event'': ''column absent''}}' AS detail
  FROM base GROUP BY batch""",
    "gate_future_events": f"""WITH {BASE},
  late AS (SELECT batch, count(*) FILTER (WHERE ts > TIMESTAMP '1996-01-01') AS n FROM base GROUP BY batch)
  SELECT batch, 4 AS seq, 'range_outliers' AS gate, n = 0 AS passed,
         CASE WHEN n = 0 THEN '' ELSE n || ' events with a future timestamp' END AS detail
  FROM late""",
    "gate_drift_given_prior": f"""WITH {LOADED}, {SHARES},
  given AS (
    SELECT d.segment, count(l.segment_at_event) / CAST((SELECT count(*) FROM loaded) AS DOUBLE) AS given_share
    FROM domain d LEFT JOIN loaded l ON l.segment_at_event = d.segment GROUP BY d.segment
  ),
  judged AS (
    SELECT batch, segment, share, CASE WHEN prior_batch IS NULL THEN given_share ELSE prior_share END AS prior_share
    FROM shares JOIN given USING (segment)
  )
  SELECT batch, segment, round(share, 6) AS share, round(prior_share, 6) AS prior_share,
         round(abs(share - prior_share), 6) AS drift, NOT abs(share - prior_share) > 0.30 AS passed
  FROM judged""",
    "failed_gates": f"WITH {SCORECARD} SELECT batch, seq, gate, detail FROM scorecard WHERE NOT passed",
    "gate_alerts": f"""WITH {SCORECARD}
  SELECT batch, 'Quality gate blocked promotion of ' || batch || ': '
                || string_agg(gate || ': ' || detail, '; ' ORDER BY seq) AS message
  FROM scorecard WHERE NOT passed GROUP BY batch""",
    "promoted_rows": f"WITH {PROMOTED} SELECT * FROM promoted",
    "gold_dim_customer": f"WITH {PROMOTED}, {scd2('promoted')} SELECT * FROM dim",
    "gold_fact_engagement_daily": f"""WITH {PROMOTED}
  SELECT customer_id, CAST(ts AS DATE) AS event_date, event_type, count(*) AS n_events,
         CAST(sum(coalesce(amount_cents, 0)) AS BIGINT) AS total_amount_cents
  FROM promoted GROUP BY 1, 2, 3""",
    "stored_gold_fact": f"""WITH {PROMOTED}
  SELECT customer_id, CAST(ts AS DATE) AS event_date, event_type, count(*) AS n_events,
         CAST(sum(coalesce(amount_cents, 0)) AS BIGINT) AS total_amount_cents
  FROM promoted GROUP BY 1, 2, 3""",
    "stored_silver": f"""WITH {PROMOTED}
  SELECT batch, count(*) AS n_clean, CAST(0 AS BIGINT) AS n_rejects FROM promoted GROUP BY batch""",
    "registered_gold": f"""WITH {STORED_FACT}, {scd2("promoted")}
  SELECT 'dim_customer' AS name, count(*) AS n_rows, 5 AS n_columns FROM dim
  UNION ALL SELECT 'fact_engagement_daily', count(*), 5 FROM fact
  UNION ALL SELECT 'dim_offer', count(*), 4 FROM offer""",
    "cleaned_batches": f"""WITH {LOADED},
  yearly AS (SELECT * EXCLUDE (batch), substr(batch, 1, 4) AS batch FROM loaded),
  kept AS (SELECT DISTINCT * FROM yearly),
  sides AS (
    SELECT batch, count(*) FILTER (WHERE event_type IS NOT NULL) AS silver_rows,
           count(*) FILTER (WHERE event_type IS NULL) AS rejects
    FROM kept GROUP BY batch
  ),
  sizes AS (SELECT batch, count(*) AS bronze_rows FROM yearly GROUP BY batch)
  SELECT batch, bronze_rows, silver_rows, rejects, bronze_rows - silver_rows - rejects AS duplicates,
         bronze_rows = silver_rows + rejects AS reconciled
  FROM sizes JOIN sides USING (batch)""",
    "dim_customer_in_order": f"""WITH {STORED_DIM}
  SELECT customer_id, valid_from, segment, row_number() OVER (ORDER BY customer_id, valid_from) AS row_no FROM stored""",
    "fact_in_order": f"""WITH {STORED_FACT}
  SELECT *, row_number() OVER (ORDER BY customer_id, event_date, event_type) AS row_no FROM fact""",
    "dim_offer_in_order": f"WITH {STORED_FACT} SELECT *, row_number() OVER (ORDER BY event_type) AS row_no FROM offer",
    "retention_in_order": f"""WITH {STORED_DIM}, {COHORTS}
  SELECT segment, n_now AS customers_currently_in_segment, n_ever AS customers_ever_in_segment,
         round(100 * CAST(n_now AS DOUBLE) / n_ever, 1) AS retention_pct,
         row_number() OVER (ORDER BY n_now DESC, segment) AS row_no
  FROM cohorts""",
    "landed_batches": """
  SELECT strftime(o_orderdate, '%Y-%m') AS batch, count(*) AS n_rows,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS amount_cents
  FROM orders GROUP BY 1""",
    "gold_dim_offer": f"""WITH {PROMOTED}
  SELECT event_type, count(*) AS n_events, count(DISTINCT customer_id) AS n_distinct_customers,
         'offer_' || event_type AS offer_id
  FROM promoted WHERE event_type IN ('O', 'F') GROUP BY event_type""",
    "referential_orphans": """
  SELECT o_custkey AS customer_id, count(*) AS n_events FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1""",
    # ---- bronze and silver
    "json_events": f"""WITH {BASE}
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(customer_id AS VARCHAR) AS customer_id,
         CASE WHEN event_type <> 'O' THEN amount_cents END AS amount_cents,
         CASE WHEN event_type <> 'P' THEN CAST(epoch(ts) AS BIGINT) END AS epoch
  FROM base""",
    "duplicate_keys": """
  SELECT l_orderkey, l_linenumber, count(*) - 1 AS n_surplus FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "silver_dedupe": f"WITH {LINES} SELECT * FROM survivors",
    "silver_rejects": f"WITH {LINES} SELECT * EXCLUDE (n_copies, zone) FROM survivors WHERE zone = 'rejects'",
    "silver_reconcile": f"""WITH {LINES},
  totals AS (
    SELECT (SELECT count(*) FROM lines) AS bronze_rows, count(*) FILTER (WHERE zone = 'clean') AS silver_rows,
           count(*) FILTER (WHERE zone = 'rejects') AS rejects
    FROM survivors
  )
  SELECT *, bronze_rows - silver_rows - rejects AS duplicates, bronze_rows = silver_rows + rejects AS reconciled
  FROM totals""",
    "silver_reconcile_batches": f"""WITH {LOADED},
  kept AS (SELECT DISTINCT * FROM loaded),
  sides AS (
    SELECT batch, count(*) FILTER (WHERE event_type IS NOT NULL) AS silver_rows,
           count(*) FILTER (WHERE event_type IS NULL) AS rejects
    FROM kept GROUP BY batch
  ),
  sizes AS (SELECT batch, count(*) AS bronze_rows FROM loaded GROUP BY batch)
  SELECT batch, bronze_rows, silver_rows, rejects, bronze_rows - silver_rows - rejects AS duplicates,
         bronze_rows = silver_rows + rejects AS reconciled
  FROM sizes JOIN sides USING (batch)""",
    # ---- ledgers
    "cost_by_pipeline": """WITH ranked AS (
    SELECT o_orderpriority || '#' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS pipeline_id,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_date,
           CAST(round(o_totalprice * 1000000) AS BIGINT) AS bytes,
           row_number() OVER (PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE)
                              ORDER BY o_orderdate DESC, o_totalprice DESC) AS rn
    FROM orders
  )
  SELECT pipeline_id, run_date, round(bytes / CAST(1073741824 AS DOUBLE) * CAST(0.023 AS DOUBLE), 6) AS cost_usd
  FROM ranked WHERE rn = 1""",
    "cost_total_by_pipeline": """
  SELECT o_orderpriority || '#' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS pipeline_id,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_date,
         round(CAST(sum(CAST(round(o_totalprice * 1000000) AS BIGINT)) AS DOUBLE) / CAST(1073741824 AS DOUBLE)
               * CAST(0.023 AS DOUBLE), 6) AS cost_usd
  FROM orders GROUP BY 1, 2""",
    "cost_shared_split": f"""WITH {EVENT_RUNS},
  per AS (SELECT run_date, pipeline_id, CAST(sum(bytes_processed) AS BIGINT) AS bytes_processed
          FROM runs GROUP BY 1, 2),
  shared AS (SELECT *, bytes_processed / CAST(sum(bytes_processed) OVER (PARTITION BY run_date) AS DOUBLE) AS s
             FROM per)
  SELECT run_date, pipeline_id, bytes_processed, round(s, 6) AS share,
         round(s * CAST(100.0 AS DOUBLE), 6) AS cost_usd
  FROM shared""",
    "sla_first_alert": f"""WITH {EVENT_RUNS}
  SELECT run_id, pipeline_id, run_date, duration_seconds, breached,
         CASE WHEN breached THEN nth = 1 AND pipeline_id <> 'click' END AS alert_sent,
         CASE WHEN breached AND NOT (nth = 1 AND pipeline_id <> 'click')
              THEN 'already alerted today (deduped)' END AS reason
  FROM judged""",
    "sla_alert_messages": f"""WITH {EVENT_RUNS}
  SELECT alert_id, 'SLA breach: ' || pipeline_id || ' took ' || printf('%.0f', duration_seconds)
                   || 's (limit 100s) on ' || run_date AS message
  FROM judged WHERE nth = 1 AND pipeline_id <> 'click'""",
    "sla_breach_count": f"""WITH {EVENT_RUNS}
  SELECT count(DISTINCT alert_id) AS sla_breaches_recorded FROM judged WHERE breached OR pipeline_id = 'click'""",
    "sla_run_elapsed": """WITH
  starts AS (SELECT user_id || '@' || CAST(ts AS DATE) AS run_id, max(ts) AS s
             FROM events WHERE event_type = 'signup' GROUP BY 1),
  ends AS (SELECT user_id || '@' || CAST(ts AS DATE) AS run_id, max(ts) AS e
           FROM events WHERE event_type = 'purchase' GROUP BY 1),
  timed AS (SELECT run_id, CAST(floor(epoch(e)) - floor(epoch(s)) AS BIGINT) AS elapsed_seconds
            FROM ends LEFT JOIN starts USING (run_id))
  SELECT run_id, elapsed_seconds, coalesce(elapsed_seconds > 3600, false) AS breached,
         CASE WHEN elapsed_seconds > 3600 THEN true END AS alert_sent,
         CASE WHEN elapsed_seconds IS NULL THEN 'no start time recorded' END AS reason
  FROM timed""",
    "sla_run_alerted": f"""WITH {ALERTED_RUNS}
  SELECT run_id, elapsed_seconds, coalesce(elapsed_seconds > 3600, false) AS breached,
         CASE WHEN elapsed_seconds > 3600 THEN NOT told END AS alert_sent,
         CASE WHEN elapsed_seconds IS NULL THEN 'no start time recorded' END AS reason
  FROM timed""",
    "sla_run_messages": f"""WITH {ALERTED_RUNS}
  SELECT run_id || '#sla' AS alert_id, 'SLA breach: run ' || run_id || ' took ' || elapsed_seconds || 's (limit 3600s)' AS message
  FROM timed WHERE elapsed_seconds > 3600 AND NOT told""",
    "ledger_latest": """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
  ) WHERE rn = 1""",
    # ---- quality
    "quality_score": f"""WITH {CHECKS}
  SELECT dimension, round(avg(CASE WHEN passed THEN 1 ELSE 0 END), 4) AS score FROM judged GROUP BY dimension
  UNION ALL SELECT 'overall', round(avg(CASE WHEN passed THEN 1 ELSE 0 END), 4) FROM judged""",
    "stored_quality_report": f"""WITH {CHECKS}
  SELECT dimension, round(avg(CASE WHEN passed THEN 1 ELSE 0 END), 4) AS score FROM judged GROUP BY dimension
  UNION ALL SELECT 'overall', round(avg(CASE WHEN passed THEN 1 ELSE 0 END), 4) FROM judged""",
    "quality_failed_checks": f"WITH {CHECKS} SELECT * FROM judged WHERE NOT passed",
    # ---- vectors
    "vector_topk_l2": """WITH pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id AS id,
           list_sum(list_transform(list_zip(q.embedding, v.embedding),
             lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE))
                       * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))) AS d
    FROM embeddings q JOIN embeddings v ON q.label = v.label
  ),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS INTEGER) AS rank FROM pairs)
  SELECT query_id, id, rank, round(d, 5) AS distance FROM ranked WHERE rank <= 5""",
    "vector_topk_cosine": """WITH wide AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  ),
  pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id AS id, v.label, 1.0 - list_cosine_similarity(q.e, v.e) AS d
    FROM wide q CROSS JOIN wide v WHERE q.vec_id % 20 = 0
  ),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS INTEGER) AS rank FROM pairs)
  SELECT query_id, id, rank, round(d, 5) AS distance, label FROM ranked WHERE rank <= 5""",
    "vector_topk_dirty": """WITH good AS (
    SELECT vec_id, CAST(CASE WHEN label % 4 = 3 THEN embedding[1:8] ELSE embedding END AS DOUBLE[]) AS e
    FROM embeddings WHERE label % 4 NOT IN (1, 2)
  ),
  pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id AS id, list_sum(list_transform(list_zip(q.e, v.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM good q JOIN good v ON len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0
  ),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS INTEGER) AS rank FROM pairs)
  SELECT query_id, id, rank, round(d, 5) AS distance FROM ranked WHERE rank <= 5""",
    "vector_upsert": """
  SELECT vec_id AS id, CASE WHEN label >= 5 THEN label - 5 ELSE label END AS label,
         CASE WHEN label >= 5 THEN 2 ELSE 1 END AS updated_at, CAST(len(embedding) AS INTEGER) AS n_dims
  FROM embeddings""",
}
