"""History operators against brute force, on data made to fall on lane boundaries."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import history as h
from tidemark.operators.lanes import cut_lanes, hot_keys, running_total

START = datetime(2024, 1, 1)
EVENTS = "customer_id string, segment_at_event string, event_ts timestamp_ntz"
VERSIONS = "customer_id string, segment string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def random_events(seed, n=400, customers=4, hours=24 * 6, step=3):
    """Few customers and segments, coarse times: many ties, long and short runs, one hot customer."""
    rng = random.Random(seed)
    ids = ["hot"] * customers + [f"c{i}" for i in range(customers)]
    return [
        (rng.choice(ids), rng.choice("AAB C".replace(" ", "")), START + timedelta(hours=rng.randrange(0, hours, step)))
        for _ in range(n)
    ]


def brute_history(rows):
    out = []
    for c in {r[0] for r in rows}:
        at = {}
        for _, s, t in (r for r in rows if r[0] == c):
            at[t] = min(s, at.get(t, s))
        runs = []
        for t in sorted(at):
            if not runs or runs[-1][0] != at[t]:
                runs.append((at[t], t))
        for (s, t), nxt in zip(runs, [*runs[1:], (None, None)]):
            out.append((c, s, t, nxt[1], nxt[1] is None))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("lane_rows", [2, 20])
@pytest.mark.parametrize("seed, n, step", [(1, 400, 3), (3, 600, 12), (4, 5, 24)])
def test_history_equals_brute_force(spark, lane_rows, seed, n, step):
    rows = random_events(seed, n=n, step=step)
    for hot_rows in (0, 30):  # all customers in lanes, some
        got = h.build_dim_customer(spark.createDataFrame(rows, EVENTS), lane_rows=lane_rows, hot_rows=hot_rows)
        assert as_rows(got) == brute_history(rows)


def test_second_run_of_a_lane_closes_the_version_of_an_earlier_lane(spark):
    """Lane 2 opens with the segment carried over and changes twice inside."""
    d = [START + timedelta(hours=h) for h in (1, 25, 30, 35, 49, 73)]
    rows = [("c", s, t) for s, t in zip("AABAAC", d)]
    got = h.build_dim_customer(spark.createDataFrame(rows, EVENTS), hot_rows=0, lane_rows=2, ordered=True).collect()
    assert [(r.segment, r.valid_from, r.valid_to) for r in got] == [
        ("A", d[0], d[2]),
        ("B", d[2], d[3]),
        ("A", d[3], d[5]),
        ("C", d[5], None),
    ]


def test_fixture_of_the_change_from_mass_to_student(spark):
    rows = [("cust_000000", "mass", datetime(2024, 1, 3)), ("cust_000000", "student", datetime(2024, 1, 31))]
    mass, student = h.build_dim_customer(spark.createDataFrame(rows, EVENTS), ordered=True).collect()
    assert (mass.segment, mass.valid_to, mass.is_current) == ("mass", datetime(2024, 1, 31), False)
    assert (student.segment, student.valid_to, student.is_current) == ("student", None, True)


def test_null_segments_and_times_open_no_version(spark):
    rows = [("c", "A", START), ("c", None, START + timedelta(days=1)), ("c", "A", START + timedelta(days=2))]
    rows += [("c", "B", None), (None, "B", START)]
    got = h.build_dim_customer(spark.createDataFrame(rows, EVENTS)).collect()
    assert [(r.segment, r.valid_from, r.valid_to) for r in got] == [("A", START, None)]


def test_ties_give_the_same_history_for_any_input_order(spark):
    rows = random_events(11, n=300, step=24)
    prints = set()
    for order in range(3):
        random.Random(order).shuffle(rows)
        frame = spark.createDataFrame(rows, EVENTS).repartition(1 + order)
        prints.add(tuple(h.fingerprint(h.build_dim_customer(frame, hot_rows=order * 40)).first()))
    assert len(prints) == 1


def test_copies_change_nothing(spark):
    rows = random_events(5, n=50)
    frame = spark.createDataFrame(rows, EVENTS)
    many = frame.unionAll(frame).unionAll(frame)
    assert as_rows(h.build_dim_customer(many)) == as_rows(h.build_dim_customer(frame))


def test_rebuilt_history_passes_its_audits(spark):
    dim = h.build_dim_customer(spark.createDataFrame(random_events(8), EVENTS))
    assert h.overlap_audit(dim).isEmpty()
    assert h.inverted_ranges(dim).isEmpty()
    assert h.current_row_audit(dim, include_none=True).isEmpty()


def random_versions(seed, n=60):
    rng = random.Random(seed)
    rows = set()
    for _ in range(n):
        a = START + timedelta(hours=rng.randrange(0, 96, 4))
        end = rng.choice([None, *[a + timedelta(hours=x) for x in (0, 4, 12, 40)]])
        rows.add((rng.choice("xy"), rng.choice("AB"), a, end, end is None))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlap_audit_counts_the_pairs_it_never_forms(spark, seed):
    rows = random_versions(seed)
    forever = datetime(9999, 12, 31)
    pairs = sum(
        1
        for a in rows
        for b in rows
        if a[0] == b[0]
        and a[2] < b[2]
        and a[2] < (b[3] or forever)
        and (a[3] or forever) > b[2]
    )
    frame = spark.createDataFrame(rows, VERSIONS)
    for lane_rows, hot_rows in ((2, 0), (20, 0), (20, 40), (20, h.HOT_ROWS)):
        found = h.overlap_audit(frame, lane_rows=lane_rows, hot_rows=hot_rows).collect()
        assert sum(r.n_starting * r.n_open for r in found) == pairs > 0
    assert h.overlap_audit(frame, limit=1).count() == 1


def test_inverted_range_is_reported_as_such(spark):
    rows = [("c", "A", START + timedelta(days=2), START, False)]
    frame = spark.createDataFrame(rows, VERSIONS)
    assert h.inverted_ranges(frame).count() == 1
    assert h.overlap_audit(frame).isEmpty()


def test_current_row_audit(spark):
    rows = [("two", "A", START, None, True), ("two", "B", START, None, True), ("one", "A", START, None, True)]
    rows += [("none", "A", START, START + timedelta(days=1), False)]
    frame = spark.createDataFrame(rows, VERSIONS)
    assert as_rows(h.current_row_audit(frame)) == [("two", 2)]
    assert as_rows(h.current_row_audit(frame, include_none=True)) == [("none", 0), ("two", 2)]
    assert h.current_row_audit(frame, include_none=True, limit=1).count() == 1


@pytest.mark.parametrize("lane_rows, hot_rows", [(2, 0), (9, 0), (10**6, 0), (9, 100), (9, h.HOT_ROWS)])
def test_running_total(spark, lane_rows, hot_rows):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    times = rng.sample(range(24 * 40), 200)
    rows = [(rng.choice("ab"), START + timedelta(hours=t), rng.randrange(-5, 6)) for t in times]
    frame = spark.createDataFrame(rows, "k string, t timestamp_ntz, v bigint")
    got = {
        (r.k, r.t): r.total
        for r in running_total(
            frame, key="k", ts="t", value=F.col("v"), out="total", lane_rows=lane_rows, hot_rows=hot_rows
        ).collect()
    }
    want = {(k, t): sum(v2 for k2, t2, v2 in rows if k2 == k and t2 <= t) for k, t, _ in rows}
    assert got == want


@pytest.mark.parametrize(
    "lane_rows, hot_rows, part_rows", [(50, 5_000_000, 9), (50, 70, 9), (50, 0, 3), (2, 70, 1), (10**6, 0, 10)]
)
def test_point_in_time_equals_brute_force(spark, lane_rows, hot_rows, part_rows):
    rng = random.Random(9)
    versions = brute_history(random_events(21, n=60, customers=3, hours=24 * 10))
    asked = [
        (i, rng.choice(["hot", "hot", "c0", "c1", "nobody", None]), START + timedelta(hours=rng.randrange(-30, 260)))
        for i in range(300)
    ] + [(1000, "hot", None), (1001, None, None)]

    def truth(customer, ts):
        mine = [v for v in versions if v[0] == customer]
        if not mine or ts is None:
            return (None, None)
        started = [v for v in mine if v[2] <= ts]
        pick = max(started, key=lambda v: v[2]) if started else min(mine, key=lambda v: v[2])
        return (pick[1], pick[2])

    got = h.point_in_time(
        spark.createDataFrame(asked, "event_id int, customer_id string, event_ts timestamp_ntz"),
        spark.createDataFrame(versions, VERSIONS),
        lane_rows=lane_rows,
        hot_rows=hot_rows,
        part_rows=part_rows,
    )
    assert got.columns == ["event_id", "customer_id", "event_ts", "segment", "valid_from"]
    assert {r.event_id: (r.segment, r.valid_from) for r in got.collect()} == {i: truth(c, t) for i, c, t in asked}


def test_point_in_time_boundaries(spark):
    versions = [("c", "A", START, START + timedelta(days=1), False), ("c", "B", START + timedelta(days=1), None, True)]
    asked = [(0, "c", START - timedelta(days=9)), (1, "c", START), (2, "c", START + timedelta(days=1))]
    got = h.point_in_time(
        spark.createDataFrame(asked, "event_id int, customer_id string, event_ts timestamp_ntz"),
        spark.createDataFrame(versions, VERSIONS),
    )
    assert [r.segment for r in got.orderBy("event_id").collect()] == ["A", "A", "B"]


def test_point_in_time_keeps_identical_events(spark):
    asked = spark.createDataFrame([(1, "c", START)] * 7, "event_id int, customer_id string, event_ts timestamp_ntz")
    versions = spark.createDataFrame([("c", "A", START, None, True)], VERSIONS)
    got = h.point_in_time(asked, versions, hot_rows=0, part_rows=2).collect()
    assert [r.segment for r in got] == ["A"] * 7


def test_reconcile_classes(spark):
    def versions(rows):
        return spark.createDataFrame(
            [(c, s, START + timedelta(days=d), None, False) for c, s, d in rows], VERSIONS
        )

    rebuilt = versions([("a", "A", 0), ("a", "B", 3), ("b", "A", 0), ("b", "B", 1), ("d", "A", 0)])
    truth = versions([("a", "A", 0), ("a", "B", 2), ("b", "C", 0), ("c", "A", 0)])
    got = {(r.customer_id, r.version): r.status for r in h.reconcile_history(rebuilt, truth, hot_rows=0).collect()}
    assert got == {
        ("a", 1): "match",
        ("a", 2): "match",
        ("b", 1): "wrong_segment",
        ("b", 2): "extra",
        ("c", 1): "missing",
        ("d", 1): "extra",
    }


def test_fingerprint_sees_every_change_but_no_order(spark):
    rows = random_versions(4)
    frame = spark.createDataFrame(rows, VERSIONS)
    base = tuple(h.fingerprint(frame).first())
    assert tuple(h.fingerprint(frame.repartition(5)).first()) == base
    changed = [(*rows[0][:1], "Z", *rows[0][2:]), *rows[1:]]
    assert tuple(h.fingerprint(spark.createDataFrame(changed, VERSIONS)).first()) != base
    twice = spark.createDataFrame([*rows, rows[0]], VERSIONS)
    assert tuple(h.fingerprint(twice).first()) != base
    assert h.fingerprint(frame.limit(0)).first().n_rows == 0


def test_empty_events(spark):
    empty = spark.createDataFrame([], EVENTS)
    dim = h.build_dim_customer(empty)
    assert dim.isEmpty() and dim.columns == h.HISTORY_COLUMNS
    assert h.overlap_audit(dim).isEmpty()


@pytest.mark.parametrize("slots", [1, 3])
def test_versions_without_time_count_first_whether_hot_or_not(spark, monkeypatch, slots):
    monkeypatch.setattr("tidemark.operators.lanes.SLOTS", slots)
    rng = random.Random(slots)
    rows = [
        (rng.choice("abc"), rng.choice(["s", "t"]), None if rng.random() < 0.2 else datetime(2024, 1, rng.randrange(1, 9), rng.randrange(24)))
        for _ in range(120)
    ]
    frame = spark.createDataFrame(rows, "customer_id string, segment string, valid_from timestamp_ntz")
    ways = [
        sorted(map(tuple, h.number_versions(frame, hot_rows=hot, lane_rows=lane).select("customer_id", "version", "valid_from", "segment").collect()), key=repr)
        for hot, lane in ((10**9, 9), (0, 9), (0, 2), (300 * slots, 9))
    ]
    assert all(way == ways[0] for way in ways)
    plain = {c: sorted((r for r in rows if r[0] == c), key=lambda r: (r[2] is not None, r[2] or datetime.min, r[1])) for c in "abc"}
    assert ways[0] == sorted(((c, n + 1, r[2], r[1]) for c, own in plain.items() for n, r in enumerate(own)), key=repr)


def test_fingerprint_tells_texts_with_its_own_marks_apart(spark):
    def mark(*rows):
        return h.fingerprint(spark.createDataFrame(list(rows), "a string, b string")).first()

    frames = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("\\N", "c"), ("n", "c"), ("1:a", ""), ("1", ":a"), ("", None), (None, "")]
    assert len({mark(r) for r in frames}) == len(frames)
    assert mark(frames[0], frames[1]) == mark(frames[1], frames[0])


def pairs_of(rows):
    forever = datetime(9999, 12, 31)
    return sorted(
        ((a[0], a[2], a[1], a[3], b[2], b[1]) for a in rows for b in rows if a[0] == b[0] and a[2] < b[2] < (a[3] or forever)), key=repr
    )


@pytest.mark.parametrize("seed, lane_starts, part_rows, hot_rows", [(1, 64, 10**6, 10**6), (2, 2, 3, 0), (3, 1, 1, 40), (4, 5, 2, 10**6)])
def test_overlap_pairs_equal_brute_force(spark, seed, lane_starts, part_rows, hot_rows):
    rows = random_versions(seed)
    rows += rows[:5]  # versions that are there twice
    frame = spark.createDataFrame(rows, VERSIONS)
    got = h.overlap_pairs(frame, lane_starts=lane_starts, part_rows=part_rows, hot_rows=hot_rows, lane_rows=4)
    assert as_rows(got) == pairs_of(rows)
    counted = h.overlap_audit(frame, hot_rows=hot_rows, lane_rows=4).collect()
    assert sum(r.n_starting * r.n_open for r in counted) == len(pairs_of(rows)) > 0


def test_overlap_pairs_of_odd_versions(spark):
    day = [START + timedelta(days=i) for i in range(6)]
    rows = [(None, "A", day[0], None, True), ("c", "A", None, None, True), ("c", "B", day[3], day[1], False), ("c", None, day[0], None, True)]
    rows += [("c", "A", day[2], day[2], False), ("d", "A", day[0], day[2], False), ("d", "A", day[2], None, True)]
    frame = spark.createDataFrame(rows, VERSIONS)
    got = {(r.customer_id, r.from_a, r.segment_a, r.from_b, r.segment_b) for r in h.overlap_pairs(frame).collect()}
    assert got == {("c", day[0], None, day[2], "A"), ("c", day[0], None, day[3], "B")}
    assert h.overlap_pairs(frame.limit(0)).isEmpty()


def test_pairs_are_joined_by_customer_and_lane(spark):
    text = h.overlap_pairs(spark.createDataFrame(random_versions(1), VERSIONS))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert all("customer_id" in line for line in text.splitlines() if "MergeJoin" in line or "HashJoin" in line)


def test_a_version_goes_to_few_lanes_where_it_meets_few_starts(spark):
    """Many versions in a row, one that is open all the time: rows of the join stay near the pairs."""
    from pyspark.sql import functions as F

    n = 2000
    rows = [("c", "A", START + timedelta(minutes=i), START + timedelta(minutes=i + 1), False) for i in range(n)]
    frame = spark.createDataFrame([*rows, ("c", "B", START - timedelta(days=1), None, True)], VERSIONS)
    assert h.overlap_pairs(frame, lane_starts=50).count() == n
    assert h.overlap_pairs(frame.where(F.col("segment") == "A"), lane_starts=50).isEmpty()


@pytest.mark.parametrize("spread", ["one day", "one second", "years"])
def test_no_lane_of_a_hot_key_holds_more_rows_than_allowed(spark, spread):
    from pyspark.sql import functions as F

    n, lane_rows = 3000, 40
    step = {"one day": F.col("id") * F.col("id") % 86_399_000_000, "one second": F.col("id") * 300, "years": F.col("id") * 300_000_000_000}[spread]
    rows = spark.range(n).select(F.lit("c").alias("k"), (F.lit(1_700_000_000_000_000) + step).alias("us"))
    for kind in ("timestamp", "timestamp_ntz"):
        typed = rows.select("k", F.timestamp_micros("us").cast(kind).alias("t")).distinct()
        hot = hot_keys(typed, "k", "t", F.xxhash64("t"), hot_rows=1, lane_rows=lane_rows)
        lanes = cut_lanes(typed, "k", "t", hot).groupBy("k", "_lane").agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("b")).orderBy("_lane").collect()
        assert max(r.n for r in lanes) <= lane_rows and len(lanes) <= 2 * n / lane_rows + 1
        assert all(x.b < y.a for x, y in zip(lanes, lanes[1:]))


def test_only_hot_keys_have_lanes(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("a", START)] * 5 + [("b", START)] + [("a", None), (None, START)], "k string, t timestamp_ntz")
    hot = hot_keys(rows, "k", "t", F.xxhash64("k", "t"), hot_rows=3, lane_rows=2)
    assert [r.k for r in hot.collect()] == ["a"]
    cut = cut_lanes(rows, "k", "t", hot)
    assert {(r.k, r.t is None, r._lane is None) for r in cut.collect()} == {("a", False, False), ("b", False, True), ("a", True, True), (None, False, True)}
    none = hot_keys(rows, "k", "t", F.xxhash64("k", "t"), hot_rows=99)
    assert "Join" not in cut_lanes(rows, "k", "t", none)._jdf.queryExecution().optimizedPlan().toString()


def slices_of(got, want):
    """The same by looking at every instant."""
    out = []
    for c in sorted({r[0] for r in got + want}):
        sides = [sorted((r for r in side if r[0] == c), key=lambda r: (r[2], r[1])) for side in (got, want)]
        times = sorted({t for side in sides for r in side for t in (r[2], r[3]) if t})

        def at(side, t):
            first = [r for i, r in enumerate(side) if i == 0 or side[i - 1][2] != r[2]]
            held = [r for r in first if r[2] <= t]
            return held[-1] if held and (held[-1][3] is None or held[-1][3] > t) else None

        for t, nxt in zip(times, [*times[1:], None]):
            g, w = at(sides[0], t), at(sides[1], t)
            if g or w:
                status = "missing" if not g else "extra" if not w else "match" if g[1] == w[1] else "wrong_segment"
                out.append((c, t, nxt, g and g[1], w and w[1], status))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, hot_rows, lane_rows", [(1, 10**6, 9), (2, 0, 4), (3, 20, 2)])
def test_slices_equal_brute_force(spark, seed, hot_rows, lane_rows):
    rng = random.Random(seed)
    truth = brute_history(random_events(seed, n=80))
    got = [(c, rng.choice("AB") if rng.random() < 0.1 else s, a, b, n) for c, s, a, b, n in truth if rng.random() < 0.8]
    frames = spark.createDataFrame(got, VERSIONS), spark.createDataFrame(truth, VERSIONS)
    found = h.reconcile_slices(*frames, hot_rows=hot_rows, lane_rows=lane_rows)
    assert as_rows(found) == slices_of(got, truth)
    # Without valid_to a version holds until the next.
    assert as_rows(h.reconcile_slices(frames[0], frames[1].drop("valid_to"), hot_rows=hot_rows, lane_rows=lane_rows)) == slices_of(got, truth)


def test_one_lost_version_is_one_wrong_slice(spark):
    day = [START + timedelta(days=i) for i in range(5)]
    truth = [("c", s, day[i], day[i + 1] if i < 3 else None, i == 3) for i, s in enumerate("ABAC")]
    got = [truth[0], *truth[2:]]
    found = h.reconcile_slices(spark.createDataFrame(got, VERSIONS), spark.createDataFrame(truth, VERSIONS)).orderBy("valid_from").collect()
    assert [r.status for r in found] == ["match", "missing", "match", "match"]
    assert (found[1].valid_from, found[1].valid_to, found[1].segment, found[1].true_segment) == (day[1], day[2], None, "B")


def test_slices_of_odd_versions(spark):
    day = [START + timedelta(days=i) for i in range(4)]
    got = [(None, "A", day[0], None, True), ("c", "A", None, None, True), ("c", "B", day[2], day[1], False), ("c", None, day[0], None, True)]
    want = [("c", None, day[0], day[1], False), ("d", "A", day[1], None, True)]
    frames = spark.createDataFrame(got, VERSIONS), spark.createDataFrame(want, VERSIONS)
    assert as_rows(h.reconcile_slices(*frames)) == sorted(
        [("c", day[0], day[1], None, None, "match"), ("c", day[1], None, None, None, "extra"), ("d", day[1], None, None, "A", "missing")], key=repr
    )
    assert h.reconcile_slices(frames[0].limit(0), frames[1].limit(0)).isEmpty()


def test_without_hot_customers_the_history_shuffles_its_events_once(spark):
    rows = [(f"c{i % 7}", "ab"[i % 2], f"2024-01-{1 + i % 28:02d} 00:00:00") for i in range(80)] * 2
    events = spark.createDataFrame(rows, "customer_id string, segment_at_event string, ts string").selectExpr(
        "customer_id", "segment_at_event", "CAST(ts AS timestamp) AS event_ts"
    )
    dim = h.build_dim_customer(events)
    plan = dim._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count(" Sort ") == 1
    assert sorted(dim.collect()) == sorted(h.build_dim_customer(events, hot_rows=1, lane_rows=4).collect())
