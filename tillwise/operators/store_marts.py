"""Store marts: monthly performance and the store directory.

``unique_orders`` states that no order id occurs twice in the fact (see ``quality.check_unique``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions import calendar, measures, windows
from tillwise.functions.aggregates import count_orders, least_row, order_count, ordered_concat
from tillwise.operators.relational import aggregate_distinct, asof_version_join, left_star, rank_in_slices
from tillwise.schemas import OPEN_END


def store_months(fact: DataFrame, history: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """Stable store x month. Sales that fit no code version form a group with a NULL store."""
    sales = fact.select("order_id", "order_date", "store_code", "customer_id", "quantity", "total_amount")
    placed = asof_version_join(sales, history, "store_code", "order_date")
    counted, orders = order_count("total_orders", unique_orders)
    monthly = aggregate_distinct(
        placed, {"initial_store_code": F.col("initial_store_code"), "_m": calendar.month_start(F.col("order_date"))},
        {"unique_customers": "customer_id"} | orders,
        F.sum("quantity").alias("total_qty_sold"),
        F.sum("total_amount").alias("total_revenue"),
        measures.mean("total_amount").alias("avg_order_value"),
        *counted,
    )
    return monthly.select(
        "initial_store_code", calendar.month_key(F.col("_m")).alias("month"), "total_orders", "unique_customers",
        "total_qty_sold", "total_revenue", "avg_order_value",
    )


def store_performance(fact: DataFrame, history: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """``store_months`` with the rank inside the month and the store's revenue so far."""
    months = store_months(fact, history, unique_orders=unique_orders)
    ranked = rank_in_slices(months, "month", {"revenue_rank": "total_revenue"}, ["initial_store_code"])
    return ranked.withColumn("cumulative_revenue", windows.running_sum("total_revenue", "month", ["initial_store_code"]))


def store_directory(fact: DataFrame, history: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """One row per stable store, with its lifetime sales.

    A store with several open versions (a code that came back) has one row for each of them.
    """
    status = F.when(F.col("end_date") == F.lit(OPEN_END), "active").otherwise("closed")
    latest = least_row(
        -F.unix_date("start_date"), F.col("store_code"), payload={"status": F.col("status")}
    )
    versions = history.withColumn("status", status)
    stores = versions.groupBy("initial_store_code").agg(
        latest["status"].alias("status"), (F.count(F.lit(1)) - 1).alias("total_code_changes")
    )
    current = versions.filter("status = 'active'").select(
        "initial_store_code", F.col("store_code").alias("current_store_code"), F.col("start_date").alias("active_since")
    )
    placed = asof_version_join(
        fact.select("order_id", "order_date", "store_code", "total_amount"), history, "store_code", "order_date", how="inner"
    )
    lifetime = placed.groupBy("initial_store_code").agg(
        F.sum("total_amount").alias("revenue"), count_orders(unique_orders).alias("orders")
    )
    return left_star(stores, [current, lifetime], "initial_store_code").select(
        "initial_store_code", "current_store_code", "status", "active_since", "total_code_changes",
        F.coalesce("revenue", F.lit(0)).alias("lifetime_revenue"),
        F.coalesce("orders", F.lit(0)).alias("lifetime_orders"),
    )


def store_code_journey(history: DataFrame) -> DataFrame:
    """All codes of a store in the order they were used."""
    return history.groupBy("initial_store_code").agg(
        ordered_concat("store_code", "start_date", " → ").alias("code_journey")
    )
