"""Monthly KPIs. Each reduces its input to months first; everything after that is month-level.

``unique_orders`` states that no order id occurs twice in the fact (see ``quality.check_unique``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import calendar, measures, windows
from tillwise.functions.aggregates import descending, least_row, order_count
from tillwise.operators.relational import aggregate_distinct, full_join_months


def _by_month(fact: DataFrame, unique_orders: bool, distincts: dict[str, str], *aggs: Column) -> DataFrame:
    counted, orders = order_count("total_orders", unique_orders)
    keys = {"_m": calendar.month_start(F.col("order_date"))}
    months = aggregate_distinct(fact, keys, distincts | orders, *aggs, *counted)
    return months.withColumn("month", calendar.month_key(F.col("_m"))).drop("_m")


def month_base(fact: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """One row per month: what the revenue and the order KPIs have in common. Worth storing when both are built."""
    return _by_month(
        fact, unique_orders,
        {"unique_buyers": "customer_id", "active_stores": "store_code", "distinct_products": "product_id"},
        F.sum("quantity").alias("total_qty_sold"),
        F.sum("total_amount").alias("total_revenue"),
        measures.mean("total_amount").alias("avg_order_value"),
    )


def kpi_revenue(fact: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    return revenue_of_months(_by_month(
        fact, unique_orders, {"unique_buyers": "customer_id"},
        F.sum("total_amount").alias("total_revenue"),
        F.sum("quantity").alias("total_qty_sold"),
    ))


def revenue_of_months(months: DataFrame) -> DataFrame:
    months = months.withColumn("prev_month_revenue", windows.prev("total_revenue", "month"))
    return months.select(
        "month", "total_orders", "unique_buyers", "total_revenue", "total_qty_sold", "prev_month_revenue",
        measures.growth_pct(F.col("total_revenue"), F.col("prev_month_revenue")).alias("revenue_mom_growth_pct"),
        windows.moving_avg("total_revenue", "month", 3).alias("revenue_3m_rolling_avg"),
        windows.running_sum("total_revenue", "month").alias("cumulative_revenue"),
        windows.share_of_total("total_revenue").alias("revenue_share_pct"),
    )


def kpi_orders(fact: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    return orders_of_months(month_base(fact, unique_orders=unique_orders))


def orders_of_months(months: DataFrame) -> DataFrame:
    months = months.withColumns({
        "prev_month_orders": windows.prev("total_orders", "month"),
        "prev_month_aov": windows.prev("avg_order_value", "month"),
    })
    c = F.col
    return months.select(
        "month", "total_orders", "unique_buyers", "active_stores", "distinct_products", "total_qty_sold",
        "total_revenue", "avg_order_value",
        measures.ratio(c("total_qty_sold"), c("total_orders")).alias("avg_items_per_order"),
        "prev_month_orders",
        measures.growth_pct(c("total_orders"), c("prev_month_orders")).alias("orders_mom_growth_pct"),
        "prev_month_aov",
        measures.growth_pct(c("avg_order_value"), c("prev_month_aov")).alias("aov_mom_change_pct"),
        measures.ratio(c("total_revenue"), c("active_stores")).alias("avg_revenue_per_store"),
        measures.ratio(c("total_orders"), c("unique_buyers")).alias("avg_orders_per_buyer"),
    )


def kpi_customer_retention(fact: DataFrame) -> DataFrame:
    """New, returning and retained buyers.

    A customer's months are at most as many as the calendar has, so one window over the distinct
    (customer, month) pairs gives first purchase and previous purchase together; there is no
    self-join and raw sales are reduced to pairs before the shuffle.
    """
    m = F.col("_m")
    pairs = fact.filter("customer_id is not null").select(
        "customer_id", calendar.month_start(F.col("order_date")).alias("_m")
    ).distinct()
    visits = windows.by(["customer_id"], m.asc_nulls_last())
    marked = pairs.withColumns({
        "_first": F.min(m).over(visits.rowsBetween(Window.unboundedPreceding, 0)),
        "_before": F.lag(m).over(visits),
    })
    return retention_of_months(marked.groupBy("_m").agg(
        F.count("customer_id").alias("total_buyers"),
        F.count_if(F.col("_first") == m).alias("new_customers"),
        F.count_if(F.col("_first") < m).alias("returning_customers"),
        F.count_if(F.col("_before") == F.add_months(m, -1)).alias("retained_from_prev_month"),
    ))


def retention_of_months(months: DataFrame) -> DataFrame:
    """Retention from the buyers of each month ``_m``: counted from sales, or from ``mergeable.retention_months``."""
    m = F.col("_m")
    months = months.withColumn("month", calendar.month_key(m)).withColumn("prev_month_buyers", windows.prev("total_buyers", "month"))
    buyers, before, kept = F.col("total_buyers"), F.col("prev_month_buyers"), F.col("retained_from_prev_month")
    return months.select(
        "month", "total_buyers", "new_customers", "returning_customers", "retained_from_prev_month", "prev_month_buyers",
        measures.retention_pct(kept, before).alias("retention_rate_pct"),
        measures.one_minus_ratio(kept, before, 2, pct=True).alias("churn_rate_pct"),
        measures.ratio(F.col("new_customers"), buyers, 2, pct=True).alias("new_customer_pct"),
        measures.growth_pct(buyers, before).alias("buyers_mom_growth_pct"),
    )


def kpi_store(store_performance: DataFrame) -> DataFrame:
    """Network KPIs from the store mart (one row per store and month), in one aggregation.

    The mart's rank column already orders the stores of a month.
    """
    code, revenue, rank = F.col("initial_store_code"), F.col("total_revenue"), F.col("revenue_rank")
    top = least_row(code, payload={
        "code": code, "revenue": revenue, "orders": F.col("total_orders"), "customers": F.col("unique_customers"),
    }, where=rank == 1)
    bottom = least_row(revenue, code, payload={"code": code, "revenue": revenue})
    months = store_performance.filter("month is not null").groupBy("month").agg(
        F.count(code).alias("active_store_count"),
        F.sum(revenue).alias("total_market_revenue"),
        F.sum("total_orders").alias("market_total_orders"),
        F.sum("unique_customers").alias("market_unique_customers"),
        measures.mean(revenue).alias("avg_revenue_per_store"),
        F.min(revenue).alias("min_store_revenue"),
        F.max(revenue).alias("max_store_revenue"),
        F.sum(F.when(rank <= 3, revenue)).alias("top3_revenue"),
        top.alias("_top"),
        bottom.alias("_bottom"),
    ).withColumn("prev_month_market_revenue", windows.prev("total_market_revenue", "month"))
    market = F.col("total_market_revenue")
    return months.select(
        "month", "active_store_count", "total_market_revenue", "market_total_orders", "market_unique_customers",
        "avg_revenue_per_store", "min_store_revenue", "max_store_revenue",
        F.col("_top.code").alias("top_store_code"), F.col("_top.revenue").alias("top_store_revenue"),
        F.col("_top.orders").alias("top_store_orders"), F.col("_top.customers").alias("top_store_unique_customers"),
        measures.ratio(F.col("_top.revenue"), market, 2, pct=True).alias("top_store_revenue_share_pct"),
        F.col("_bottom.code").alias("bottom_store_code"), F.col("_bottom.revenue").alias("bottom_store_revenue"),
        F.round(F.col("_top.revenue") - F.col("_bottom.revenue"), 2).alias("revenue_gap_top_bottom"),
        "top3_revenue", measures.ratio(F.col("top3_revenue"), market, 2, pct=True).alias("top3_concentration_pct"),
        "prev_month_market_revenue",
        measures.growth_pct(market, F.col("prev_month_market_revenue")).alias("market_revenue_mom_growth_pct"),
    )


def kpi_product(sales_by_product: DataFrame) -> DataFrame:
    """Portfolio KPIs from the product mart (one row per product and month), in one aggregation.

    Leaders are picked inside it and not by the mart's ranks, so over a lazily built mart the rank
    windows are pruned away.
    """
    product, revenue, qty = F.col("product_id"), F.col("total_revenue"), F.col("total_qty_sold")
    best = least_row(*descending(revenue), product, payload={
        "product": product, "revenue": revenue, "qty": qty,
        "buyers": F.col("unique_buyers"), "stores": F.col("sold_in_stores"),
    })
    most = least_row(*descending(qty), product, payload={"product": product, "qty": qty})
    months = sales_by_product.filter("month is not null").groupBy("month").agg(
        F.count(product).alias("distinct_products_sold"),
        F.sum(revenue).alias("total_product_revenue"),
        F.sum(qty).alias("total_qty_sold"),
        F.sum("total_transactions").alias("total_transactions"),
        measures.mean(revenue).alias("avg_revenue_per_product"),
        best.alias("_best"),
        most.alias("_most"),
    ).withColumns({
        "prev_month_product_count": windows.prev("distinct_products_sold", "month"),
        "prev_month_product_revenue": windows.prev("total_product_revenue", "month"),
    })
    total = F.col("total_product_revenue")
    return months.select(
        "month", "distinct_products_sold", "total_product_revenue", "total_qty_sold", "total_transactions",
        "avg_revenue_per_product",
        F.col("_best.product").alias("top_product_by_revenue"), F.col("_best.revenue").alias("top_product_revenue"),
        F.col("_best.qty").alias("top_product_qty_sold"), F.col("_best.buyers").alias("top_product_unique_buyers"),
        F.col("_best.stores").alias("top_product_sold_in_stores"),
        measures.ratio(F.col("_best.revenue"), total, 2, pct=True).alias("top_product_revenue_share_pct"),
        F.col("_most.product").alias("top_product_by_qty"), F.col("_most.qty").alias("top_product_qty"),
        measures.one_minus_ratio(F.col("_best.revenue"), total, 4).alias("product_diversity_index"),
        "prev_month_product_count",
        (F.col("distinct_products_sold") - F.coalesce("prev_month_product_count", F.lit(0))).alias("product_count_mom_change"),
        "prev_month_product_revenue",
        measures.growth_pct(total, F.col("prev_month_product_revenue")).alias("product_revenue_mom_growth_pct"),
    )


# Columns of the executive table, by the KPI they come from, in output order.
EXEC_COLUMNS = {
    "revenue": [
        "total_revenue", "prev_month_revenue", "revenue_mom_growth_pct", "revenue_3m_rolling_avg",
        "cumulative_revenue", "revenue_share_pct",
    ],
    "orders": [
        "total_orders", "unique_buyers", "active_stores", "distinct_products", "total_qty_sold", "avg_order_value",
        "avg_items_per_order", "orders_mom_growth_pct", "aov_mom_change_pct", "avg_revenue_per_store",
        "avg_orders_per_buyer",
    ],
    "retention": [
        "new_customers", "returning_customers", "retained_from_prev_month", "prev_month_buyers",
        "retention_rate_pct", "churn_rate_pct", "new_customer_pct", "buyers_mom_growth_pct",
    ],
    "store": [
        "active_store_count", "store_avg_revenue", "top_store_code", "top_store_revenue",
        "top_store_revenue_share_pct", "bottom_store_code", "bottom_store_revenue", "revenue_gap_top_bottom",
        "top3_concentration_pct", "market_revenue_mom_growth_pct",
    ],
    "product": [
        "distinct_products_sold", "avg_revenue_per_product", "top_product_by_revenue", "top_product_revenue",
        "top_product_revenue_share_pct", "top_product_by_qty", "product_diversity_index",
        "product_revenue_mom_growth_pct",
    ],
}


def kpi_exec_summary(
    revenue: DataFrame, orders: DataFrame, retention: DataFrame, store: DataFrame, product: DataFrame
) -> DataFrame:
    store = store.withColumnRenamed("avg_revenue_per_store", "store_avg_revenue")
    parts = zip((revenue, orders, retention, store, product), EXEC_COLUMNS.values(), strict=True)
    joined = full_join_months([df.select("month", *columns) for df, columns in parts])
    return joined.select("month", *[c for columns in EXEC_COLUMNS.values() for c in columns])
