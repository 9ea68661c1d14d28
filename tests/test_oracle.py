"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import re

import __spark_entry__ as entry
import oracle
import pytest

from tidemark.operators import history
from tidemark.workload import inputs
from tidemark.workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert oracle.differences(entry.queries()[name](spark, SMALL), duck, entry.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def plan(spark, name):
    df = entry.queries()[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_pairs_rows_without_a_key(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_history_reads_three_columns_once(spark):
    text = plan(spark, "scd2_dim_customer")
    scans = re.findall(r"ReadSchema: struct<(\S*)", text)
    assert len(scans) == 1 and scans[0].count(":") == 3 and "o_totalprice" not in scans[0]
    # Hot customers were counted before; where there are none, nothing of them is left.
    assert "Join" not in text


def test_windows_over_events_of_hot_customers_are_keyed_by_customer_and_lane(spark):
    dim = history.build_dim_customer(inputs.order_history_events(spark, SMALL), hot_rows=1)
    text = dim._jdf.queryExecution().executedPlan().toString()
    specs = re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", text)
    assert "_lane" in specs[-1] and "_stay" in specs[0]


def test_ids_are_read_for_the_duplicate_count_only(spark):
    schemas = re.findall(r"ReadSchema: struct<(\S*)", plan(spark, "gate_scorecard"))
    assert sum("o_orderkey" in s for s in schemas) == 1
    assert sum("o_custkey" in s for s in schemas) == 1


def test_nearest_neighbours_are_cut_to_k_before_the_shuffle(spark):
    text = plan(spark, "vector_topk_l2")
    assert re.search(r"WindowGroupLimit .*, 5, Partial", text)


@pytest.mark.parametrize("name", ["silver_dedupe", "cost_by_pipeline", "ledger_latest", "vector_upsert"])
def test_copies_collapse_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "partial_m" in text and "Window" not in text
