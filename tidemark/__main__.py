"""Jobs for spark-submit: land, run, clean-batch, gold, register, cohorts, costs, sla."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.facts import cohort_retention
from tidemark.operators.ledger import breach_count, cost_by_pipeline
from tidemark.operators.silver import CLEAN
from tidemark.plans.monthly import Warehouse, clean_batch, run_monthly, write_gold_tables
from tidemark.session import build_session
from tidemark.sources import tables
from tidemark.sources.bronze import land_bronze, list_batches


def customers_from(spark: SparkSession, source: str) -> DataFrame:
    """Known customers: a Parquet path with customer_id, or a number N for cust_000000 to N-1."""
    if source.isdigit():
        return spark.range(int(source)).select(F.format_string("cust_%06d", "id").alias("customer_id"))
    return spark.read.parquet(source).select("customer_id")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("--warehouse", required=True, help="root of the tables on shared storage")
    jobs = parser.add_subparsers(dest="job", required=True)
    land = jobs.add_parser("land", help="month=*.jsonl files to the bronze table")
    land.add_argument("--in", dest="source", required=True)
    run = jobs.add_parser("run", help="gates, silver and gold for all batches")
    run.add_argument("--customers", required=True, help="Parquet path with customer_id, or a number")
    run.add_argument("--start", default="2024-01", help="month of batch 00, yyyy-MM")
    run.add_argument("--sla-seconds", type=int, default=180)
    one = jobs.add_parser("clean-batch", help="one batch to silver, without gates")
    one.add_argument("--batch", required=True)
    jobs.add_parser("gold", help="rebuild the gold tables from silver as it is")
    register = jobs.add_parser("register", help="gold tables into the catalog")
    register.add_argument("--database", default="tidemark_gold")
    jobs.add_parser("cohorts", help="print cohort retention by segment")
    jobs.add_parser("costs", help="print the cost of each pipeline and day")
    jobs.add_parser("sla", help="print the number of alerted SLA breaches")
    args = parser.parse_args(argv)

    spark = spark or build_session(f"tidemark-{args.job}")
    warehouse = Warehouse(args.warehouse)
    if args.job == "land":
        list_batches(land_bronze(spark, args.source, warehouse.bronze)).orderBy("batch").show(truncate=False)
    elif args.job == "run":
        known = customers_from(spark, args.customers)
        result = run_monthly(spark, warehouse, known, start=args.start, sla_seconds=args.sla_seconds)
        print(json.dumps(result, indent=2))
    elif args.job == "clean-batch":
        print(json.dumps(clean_batch(spark, warehouse, args.batch)))
    elif args.job == "gold":
        for name, rows in write_gold_tables(spark, warehouse, tables.read_silver(spark, warehouse.silver, CLEAN)).items():
            print(f"{name}: {rows} rows")
    elif args.job == "register":
        print("\n".join(tables.register_gold(spark, warehouse.gold, args.database)))
    elif args.job == "cohorts":
        cohort_retention(tables.read_gold(spark, warehouse.gold, "dim_customer"), ordered=True).show(truncate=False)
    elif args.job == "costs":
        cost_by_pipeline(tables.read_ledger(spark, warehouse.ops, "pipeline_cost")).orderBy("pipeline_id").show(truncate=False)
    elif args.job == "sla":
        breach_count(tables.read_ledger(spark, warehouse.ops, "sla_alerts")).show()


if __name__ == "__main__":
    main()
