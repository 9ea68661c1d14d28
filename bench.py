"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Every query computes all its rows and columns (a noop write, nothing collected).
It runs twice and the faster run counts, so compilation is left out of the figures.
`monthly_run` is the whole run on written tables: gates over all order batches, silver,
the three gold tables and the SLA check. `gold_read` reads the history it wrote.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.plans.monthly import Warehouse, run_monthly  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources import tables  # noqa: E402
from tidemark.sources.bronze import write_bronze  # noqa: E402
from tidemark.workload import inputs  # noqa: E402
from tidemark.workload.queries import QUERIES  # noqa: E402


def land_orders(spark, sf_dir: str) -> Warehouse:
    """The defective order batches as a bronze table in a new folder of $BENCH_WAREHOUSE.

    The root must be shared by all executors; only on a local master a temporary folder will do.
    """
    root = os.environ.get("BENCH_WAREHOUSE")
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set BENCH_WAREHOUSE to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    warehouse = Warehouse(f"{root}/{uuid.uuid4()}")
    write_bronze(inputs.bronze_events(spark, sf_dir), warehouse.bronze)
    return warehouse


def monthly_run(spark, warehouse: Warehouse, sf_dir: str) -> None:
    known = inputs.known_customers(spark, sf_dir).select(F.col("customer_id").cast("string"))
    run_monthly(spark, warehouse, known, start=None, segments=inputs.PRIORITIES, offer_types=("O", "F"))


def gold_read(spark, warehouse: Warehouse) -> None:
    assert tables.read_gold(spark, warehouse.gold, "dim_customer").count() > 0


def fastest(job) -> float:
    runs = []
    for _ in range(2):
        start = time.perf_counter()
        job()
        runs.append(time.perf_counter() - start)
    return round(min(runs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:] or [*QUERIES, "monthly_run", "gold_read"]
    seconds = {
        name: fastest(lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())
        for name, query in QUERIES.items()
        if name in only
    }
    if {"monthly_run", "gold_read"} & set(only):
        warehouse = land_orders(spark, sf_dir)
        seconds["monthly_run"] = fastest(lambda: monthly_run(spark, warehouse, sf_dir))
        seconds["gold_read"] = fastest(lambda: gold_read(spark, warehouse))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
