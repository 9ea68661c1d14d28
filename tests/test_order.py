"""Numbers of a global order against a sort in plain Python."""

import random
from datetime import date, datetime

import pytest

from tidemark.operators.order import numbered, range_bounds

DDL = "k string, d date, t timestamp_ntz, n bigint, x double, tags array<string>"


def rows(n, hot=0.3):
    rng = random.Random(7)
    out = []
    for i in range(n):
        k = "hot" if rng.random() < hot else rng.choice([None, "", "a", f"k{rng.randrange(40)}"])
        t = None if i % 17 == 0 else datetime(2024, 1, 1 + rng.randrange(20), 3, 0, 0, rng.randrange(3))
        out.append((k, date(2024, 1, 1 + rng.randrange(28)), t, rng.randrange(n), rng.choice([None, -1.5, 2.0]), [str(i)]))
    return out


def first_null(value):
    return (value is not None, value if value is not None else 0)


@pytest.mark.parametrize("range_rows", [1, 7, 50, 10_000])
def test_numbers_equal_a_sort(spark, range_rows):
    given = rows(400)
    df = spark.createDataFrame(given, DDL).repartition(5)
    got = numbered(df, ["k", "t", "n"], range_rows=range_rows).collect()
    want = sorted(given, key=lambda r: (*[first_null(r[i]) for i in (0, 2, 3, 1, 4)], str(r[5])))
    assert [r.row_no for r in sorted(got, key=lambda r: r.row_no)] == list(range(1, 401))
    keys = [(r.k, r.t, r.n) for r in sorted(got, key=lambda r: r.row_no)]
    assert keys == [(r[0], r[2], r[3]) for r in want]


def test_descending_numbers_and_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", None)], "s string, n bigint")
    got = numbered(df, ["n", "s"], descending=("n",), range_rows=1).orderBy("row_no").collect()
    assert [(r.s, r.row_no) for r in got] == [("d", 1), ("c", 2), ("a", 3), ("b", 4)]


def test_a_hot_value_of_the_first_column_is_cut_by_the_next(spark):
    df = spark.range(2000).selectExpr("'same' AS k", "id AS n")
    bounds = range_bounds(df, 100)
    assert len(bounds) > 10
    got = numbered(df, ["k"], range_rows=100)
    assert got.where("row_no <> n + 1").count() == 0


def test_rows_equal_in_all_columns_and_an_old_number(spark):
    df = spark.createDataFrame([("a", 9)] * 30 + [("b", 9)], "k string, row_no int")
    got = numbered(df, ["k"], range_rows=4).orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(1, 32)) and got[-1].k == "b"


def test_empty(spark):
    assert numbered(spark.createDataFrame([], DDL), ["k"]).collect() == []


def test_no_window_over_all_rows_and_no_join_without_a_key(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS n")
    text = numbered(df, ["k"], range_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    # The only exchange into a single partition holds the counts of ranges.
    assert text.count("SinglePartition") == 1


def test_the_plan_does_not_grow_with_the_ranges(spark):
    df = spark.range(2000).selectExpr("CAST(id % 7 AS string) AS k", "id AS n")

    def text(range_rows):
        return numbered(df, ["k"], range_rows=range_rows)._jdf.queryExecution().optimizedPlan().toString()

    few, many = text(500), text(2)
    # Two steps of halving against ten, and no function over an array of bounds.
    assert len(many) < 8 * len(few) and many.count("Project") < 10 * few.count("Project")
    assert "lambda" not in many
    got = numbered(df, ["k"], range_rows=2)
    assert got.selectExpr("CAST(k AS bigint) * 1000000 + n AS at", "row_no").orderBy("at").selectExpr("row_no").limit(3).collect() == [(1,), (2,), (3,)]
    assert got.selectExpr("count(DISTINCT row_no)", "min(row_no)", "max(row_no)").first() == (2000, 1, 2000)


def test_values_of_every_kind_and_descending_ones_fall_into_ranges(spark):
    rng = random.Random(3)
    nan = float("nan")
    given = [(rng.choice([None, True, False]), rng.choice([None, nan, -0.5, 3.0]), bytes([rng.randrange(4)]), {"m": rng.randrange(9)}, i) for i in range(300)]
    df = spark.createDataFrame(given, "b boolean, x double, raw binary, tags map<string, int>, n bigint").repartition(3)
    got = numbered(df, ["b", "x", "n"], descending=("n",), range_rows=5).orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(1, 301)) and [r.asDict().keys() for r in got[:1]] == [{**dict.fromkeys(df.columns), "row_no": 0}.keys()]

    def place(b, x, n):
        return (*first_null(b), x is not None, x != x, 0 if x is None or x != x else x, -n)

    assert [r.n for r in got] == [r[4] for r in sorted(given, key=lambda r: place(r[0], r[1], r[4]))]
