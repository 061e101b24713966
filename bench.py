"""Time the headline queries; prints one JSON line.

The stored facts, code history and customer dimension are built from the given tables first and timed
on their own (``store_*``); marts and KPIs then read them, as they would in a warehouse. Queries named
``build_*``, ``merge_*``, ``snapshot_*`` and ``*_history`` start from the given tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import entries, views  # noqa: E402
from tillwise.plans.monthly import RetailWarehouse  # noqa: E402
from tillwise.sources.shared import fresh_path  # noqa: E402

HEADLINE = [
    "build_fact_sales", "build_code_history", "merge_code_history", "customer_history", "snapshot_customer", "snapshot_check",
    "asof_version_join", "retained_buyers", "store_performance", "store_directory", "sales_summary", "sales_by_product",
    "sales_by_customer", "customer_profile", "kpi_revenue", "kpi_orders", "kpi_customer_retention", "kpi_store",
    "kpi_product", "kpi_exec_summary", "kpi_revenue_lines", "kpi_orders_lines", "kpi_customer_retention_lines",
    "sales_summary_lines", "sales_by_customer_lines", "check_sales_resolve", "run_checks",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        # small files: let them fill all cores
        .config("spark.sql.files.openCostInBytes", "512KB")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def _warehouse(spark: SparkSession, tables) -> dict[str, float]:
    """A full build without its last month, then that month as a batch; marts are timed on their own above."""
    sources = {"src_sales": tables["src_sales_files"]} | {name: tables[name] for name in ("src_store", "src_customer")}
    warehouse = RetailWarehouse(spark, fresh_path(spark))
    before = views.LAST_MONTH.replace(month=views.LAST_MONTH.month - 1)
    full = _timed(lambda: warehouse.full(sources, before, views.AS_OF, with_marts=False))
    return {"warehouse_full": full, "warehouse_batch": _timed(lambda: warehouse.batch(sources, views.LAST_MONTH, views.AS_OF, with_marts=False))}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in HEADLINE:
        _consume(entries.run(name)(spark, warm_dir))

    tables = views.tables(spark, sf_dir)
    seconds = {f"store_{name}": _timed(lambda: tables[name]) for name in ("fact_sales", "sales_lines", "code_history", "dim_customer")}
    seconds["store_marts_and_kpis"] = _timed(lambda: [tables[name] for name in sorted(views.STORED)])
    for name in HEADLINE:
        seconds[name] = _timed(lambda: _consume(entries.run(name)(spark, sf_dir)))
    seconds |= _warehouse(spark, tables)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
