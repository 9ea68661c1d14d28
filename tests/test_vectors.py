import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import vectors as v


def table(spark, n, seed, dims=6, copies=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        emb = [float(rng.randrange(-3, 4)) for _ in range(dims)] if copies else [rng.gauss(0, 1) for _ in range(dims)]
        rows.append((i, emb, "big" if rng.random() < 0.7 else rng.choice("abc")))
    return rows, spark.createDataFrame(rows, "id bigint, embedding array<float>, doc string")


def distance(a, b, metric):
    if metric == "l2":
        return sum((x - y) ** 2 for x, y in zip(a, b))
    n = math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    return 1.0 - (sum(x * y for x, y in zip(a, b)) / n if n else 0.0)


@pytest.mark.parametrize("metric", v.METRICS)
@pytest.mark.parametrize("on", [["doc"], None])
@pytest.mark.parametrize("query_rows, vector_rows, cells", [(256, 4096, None), (3, 7, 1), (3, 7, 9)])
def test_knn_equals_brute_force(spark, metric, on, query_rows, vector_rows, cells):
    rows, frame = table(spark, 120, seed=1)
    asked, queries = table(spark, 15, seed=2)
    queries = queries.withColumnRenamed("id", "query_id").repartition(2)
    got = v.knn(
        queries, frame.repartition(3), k=4, metric=metric, on=on, query_rows=query_rows, vector_rows=vector_rows, cells=cells
    )
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((round(r.distance, 9), r.id))
    for q, emb, doc in asked:
        pool = [(round(distance(emb, e, metric), 9), i) for i, e, d in rows if not on or d == doc]
        want = sorted(pool)[:4]
        assert [d for d, _ in found[q]] == pytest.approx([d for d, _ in want], abs=1e-9)
        if metric == "l2":  # whole numbers: ties are exact, so the smaller id must win
            assert found[q] == want


def test_filter_applies_before_ranking(spark):
    _, frame = table(spark, 60, seed=3, copies=False)
    queries = frame.where("id = 0").withColumnRenamed("id", "query_id")
    got = v.knn(queries, frame, k=3, where=F.col("doc") == "a").join(frame, "id").collect()
    assert len(got) == 3 and {r.doc for r in got} == {"a"}


def test_empty_match_gives_no_rows_and_k_may_exceed_the_pool(spark):
    _, frame = table(spark, 10, seed=4)
    queries = frame.limit(2).withColumnRenamed("id", "query_id")
    assert v.knn(queries, frame, where=F.col("doc") == "nothing").isEmpty()
    assert v.knn(queries, frame, k=50).count() == 20


def test_zero_vectors_and_null_embeddings(spark):
    frame = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None)], "id bigint, embedding array<float>")
    queries = spark.createDataFrame([(9, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    got = v.knn(queries, frame, metric="cosine").orderBy("rank").collect()
    assert [(r.id, r.distance) for r in got] == [(2, 0.0), (1, 1.0)]


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        v.knn(None, None, metric="dot")


def test_metadata_and_text_ids(spark):
    frame = spark.createDataFrame(
        [("x", [1.0], "d1"), ("y", [2.0], "d2")], "id string, embedding array<float>, doc string"
    )
    queries = spark.createDataFrame([("q", [2.1])], "query_id string, embedding array<float>")
    got = v.with_metadata(v.knn(queries, frame, k=1), frame).collect()
    assert [(r.query_id, r.id, r.rank, r.doc) for r in got] == [("q", "y", 1, "d2")]


def test_upsert_keeps_the_newest_row_of_an_id(spark):
    rows = [(1, [1.0], "old", 1), (1, [2.0], "new", 2), (2, [3.0], "only", 1)]
    frame = spark.createDataFrame(rows, "id bigint, embedding array<float>, doc string, updated_at int")
    got = v.latest_vectors(frame).orderBy("id").collect()
    assert [(r.id, r.embedding, r.doc) for r in got] == [(1, [2.0], "new"), (2, [3.0], "only")]
    assert v.latest_vectors(frame).columns == frame.columns


def clusters(spark, n, seed, dims=8, centres=12):
    """Vectors in tight clusters, some zero, some shorter, some there many times."""
    rng = random.Random(seed)
    means = [[rng.gauss(0, 10) for _ in range(dims)] for _ in range(centres)]
    rows = [(i, [m + rng.gauss(0, 0.1) for m in means[i % centres]]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id bigint, embedding array<float>")


@pytest.mark.parametrize("metric", v.METRICS)
def test_fewer_blocks_meet_where_vectors_lie_in_clusters(spark, metric):
    _, frame = clusters(spark, 1200, seed=7)
    keys, rows = ["_dim"], 10
    vectors = v._usable(frame, "id", "embedding", [])
    pivots = v._pivots(vectors, "id", "embedding", 40, metric)
    asked = v._balls(vectors.where("id < 100"), "id", "embedding", keys, 5, "q", pivots, metric)
    blocks = v._balls(vectors.coalesce(2), "id", "embedding", keys, rows, "v", pivots, metric)
    met = v.near_pairs(asked, blocks, keys, pivots, 3, metric, 2).select("q_block", "v_ids").count()
    assert 0 < met < asked.count() * blocks.count() / 4
    got, plain = (
        v.knn(frame.where("id < 100").withColumnRenamed("id", "query_id"), frame, k=3, metric=metric, vector_rows=rows, cells=c).collect()
        for c in (40, 1)
    )
    assert sorted(got) == sorted(plain)


def test_cells_with_zero_short_and_equal_vectors(spark):
    rows, _ = clusters(spark, 100, seed=3)
    rows += [(1000 + i, [0.0] * 8) for i in range(5)] + [(2000 + i, [float(i), 1.0]) for i in range(20)] + [(3000 + i, [1.0] * 8) for i in range(40)]
    rows += [(4000, [2.0, 2.0, 2.0])]
    frame = spark.createDataFrame(rows, "id bigint, embedding array<float>")
    queries = frame.where("id % 9 = 0 or id >= 4000 or id = 1002").withColumnRenamed("id", "query_id")
    for metric in v.METRICS:
        got, plain = (v.knn(queries, frame, k=4, metric=metric, vector_rows=6, query_rows=4, cells=c).collect() for c in (7, 1))
        assert sorted(got) == sorted(plain)
        # A dimension without a pivot.
        few = v.knn(queries.where("query_id >= 4000"), frame, k=4, metric=metric, cells=2).collect()
        assert [(r.query_id, r.id) for r in few] == [(4000, 4000)]


def test_no_vectors_and_no_queries(spark):
    _, frame = clusters(spark, 30, seed=1)
    queries = frame.withColumnRenamed("id", "query_id")
    assert v.knn(queries, frame.limit(0), cells=4).isEmpty()
    assert v.knn(queries.limit(0), frame, cells=4).isEmpty()
    assert v.knn(queries, frame.limit(0)).isEmpty()


def test_blocks_go_to_a_few_pieces_and_not_to_every_shuffle_partition(spark):
    rows, frame = table(spark, 400, seed=5)
    queries = frame.withColumnRenamed("id", "query_id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        for cells in (1, 5):
            found = v.knn(queries, frame, k=3, on=["doc"], query_rows=8, vector_rows=16, cells=cells)
            plan = found._jdf.queryExecution().analyzed().toString()
            assert "explode(sequence(0, " in plan and "sequence(0, 63" not in plan
            assert found.count() == 3 * len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_every_pair_of_blocks_meets_once_in_the_grid_of_its_key(spark):
    _, frame = table(spark, 500, seed=6)
    vectors = v._usable(frame, "id", "embedding", ["doc"])
    keys = ["doc", "_dim"]
    most, sides = v._sides(vectors, vectors, keys, 1000)
    sizes = {r["doc"]: r["count"] for r in frame.groupBy("doc").count().collect()}
    assert most == sizes["big"]
    grids = {r["doc"]: (r["_rows"], r["_columns"]) for r in sides.collect()}
    # Most pairs are in the largest value: nearly all pieces are its own, and a small value is one piece.
    assert set(grids) == {"big"} and 4 <= grids["big"][0] * grids["big"][1] <= 12
    asked = v._blocks(vectors, "id", "embedding", keys, 8, "q")
    blocks = v._blocks(vectors, "id", "embedding", keys, 16, "v")
    met = v._met(asked, blocks, keys, 7, sides).select("doc", "q_ids", "v_ids").collect()
    a, b = asked.collect(), blocks.collect()
    want = sorted((x["doc"], x["q_ids"], y["v_ids"]) for x in a for y in b if x["doc"] == y["doc"])
    assert sorted(tuple(r) for r in met) == want
    assert v._sides(vectors.limit(0), vectors, keys, 8) == (0, None)


def test_equal_queries_under_two_filter_values(spark):
    rows = [(i, [float(i % 5), 1.0], d) for d in ("x", "y") for i in range(60)]
    frame = spark.createDataFrame(rows, "id bigint, embedding array<float>, doc string")
    queries = frame.withColumnRenamed("id", "query_id")
    got, plain = (v.knn(queries, frame, k=2, on=["doc"], vector_rows=4, query_rows=4, cells=c).collect() for c in (5, 1))
    assert sorted(got) == sorted(plain)
