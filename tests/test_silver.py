from conftest import event

from pyspark.sql import functions as F

from tidemark.operators import silver
from tidemark.operators.silver import silverize, zone_rows


def test_conservation_for_unique_events(events):
    frame = events([event(event_id="a"), event(event_id="b", customer_id="c2"), event(event_id="c", customer_id=None)])
    valid, rejects, stats = silverize(frame)
    s = stats.first()
    assert (s.bronze_rows, s.silver_rows, s.rejects, s.duplicates, s.reconciled) == (3, 2, 1, 0, True)
    assert [r.event_id for r in rejects.collect()] == ["c"]
    assert valid.count() == 2
    assert valid.columns == rejects.columns


def test_copies_collapse_to_the_earliest_and_do_not_reconcile(events):
    frame = events([event(event_id="d", ts="2024-01-01T11:00:00Z"), event(event_id="d", ts="2024-01-01T10:00:00Z")])
    valid, rejects, stats = silverize(frame)
    assert [r.ts for r in valid.collect()] == ["2024-01-01T10:00:00Z"]
    s = stats.first()
    assert rejects.count() == 0
    assert (s.bronze_rows, s.duplicates, s.reconciled) == (2, 1, False)


def test_a_complete_copy_wins_over_an_incomplete_one(events):
    early_but_incomplete = event(event_id="d", ts="2024-01-01T09:00:00Z", event_type=None)
    valid, rejects, _ = silverize(events([early_but_incomplete, event(event_id="d")]))
    assert valid.count() == 1 and rejects.count() == 0


def test_rows_without_id_are_each_a_reject(events):
    frame = events([event(event_id=None), event(event_id=None), event()])
    _, rejects, stats = silverize(frame)
    s = stats.first()
    assert rejects.count() == 2
    assert (s.bronze_rows, s.silver_rows, s.rejects, s.duplicates) == (3, 1, 2, 0)


def test_very_many_equal_rows_without_id_come_back_in_chunks(spark, events, monkeypatch):
    sizes = spark.sql("select bigint(n) as n from values (1), (65536), (65537), (8589934597) as v(n)").select("n", silver.chunks(F.col("n")).alias("c"))
    for n, c in sizes.collect():
        assert sum(c) == n and max(c) <= silver.CHUNK
    monkeypatch.setattr(silver, "CHUNK", 7)
    frame = events([event(event_id=None)] * 100 + [event()] * 3)
    _, rejects, stats = silverize(frame)
    assert rejects.count() == 100 and stats.first().duplicates == 2


def test_equal_rows_without_id_do_not_meet_in_one_group(spark, events):
    frame = events([event(event_id=None)] * 100).repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = zone_rows(frame).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 100


def test_unreadable_time_is_a_reject(events):
    _, rejects, _ = silverize(events([event(ts="soon"), event(event_id="e2")]))
    assert [r.ts for r in rejects.collect()] == ["soon"]


def test_same_id_in_two_batches_stays_twice(events):
    frame = events([event(), event(batch="2024-02")])
    assert zone_rows(frame).count() == 2


def test_without_a_batch_column_the_frame_is_one_batch(events):
    _, _, stats = silverize(events([event(), event(batch="2024-02")]).drop("batch"))
    assert stats.first().duplicates == 1


def test_result_does_not_depend_on_input_order(events):
    rows = [event(event_id=f"e{i % 5}", amount_cents=i, ts=f"2024-01-{1 + i % 3:02d}T00:00:00Z") for i in range(40)]
    a = {tuple(r) for r in zone_rows(events(rows)).collect()}
    b = {tuple(r) for r in zone_rows(events(rows[::-1]).repartition(3)).collect()}
    assert a == b and len(a) == 5


def test_empty_input(events):
    valid, rejects, stats = silverize(events([]).drop("batch"))
    s = stats.first()
    assert (s.bronze_rows, s.silver_rows, s.rejects, s.reconciled) == (0, 0, 0, True)
