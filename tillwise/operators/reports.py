"""Dashboard cards and layer audits over stored tables.

``REPORTS`` maps a report to its function; ``report`` runs one over a mapping of tables. Row order is
part of a report only where it limits rows; other reports leave sorting to the reader.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions import calendar, measures, windows
from tillwise.operators.relational import aggregate_distinct, count_rows, monthly_buyers, retained_buyers, row_counts, top_k

Tables = Mapping[str, DataFrame]
REPORTS: dict[str, Callable[[Tables], DataFrame]] = {}


def report(name: str, tables: Tables) -> DataFrame:
    return REPORTS[name](tables)


def _register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REPORTS[fn.__name__] = fn
    return fn


def _card(name: str, table: str, build: Callable[[DataFrame], DataFrame]) -> None:
    REPORTS[name] = lambda tables: build(tables[table])


def _total(name: str, table: str, col: str, alias: str) -> None:
    _card(name, table, lambda df: df.agg(F.sum(col).alias(alias)))


def _mean(name: str, table: str, col: str, alias: str, scale: int = 2) -> None:
    _card(name, table, lambda df: df.agg(measures.mean(col, scale).alias(alias)))


def _max(name: str, table: str, col: str, alias: str) -> None:
    _card(name, table, lambda df: df.agg(F.max(col).alias(alias)))


def _columns(name: str, table: str, cols: str) -> None:
    _card(name, table, lambda df: df.select(*cols.split()))


# --- executive tab ---------------------------------------------------------------------------------

_total("exec_total_revenue", "kpi_exec_summary", "total_revenue", "total_revenue")
_total("exec_total_orders", "kpi_exec_summary", "total_orders", "total_orders")
_total("exec_sum_monthly_buyers", "kpi_exec_summary", "unique_buyers", "sum_monthly_buyers")
_mean("exec_avg_order_value", "kpi_exec_summary", "avg_order_value", "avg_order_value")
_mean("exec_avg_retention", "kpi_exec_summary", "retention_rate_pct", "avg_retention_rate_pct")
_columns("exec_revenue_trend", "kpi_exec_summary", "month total_revenue revenue_3m_rolling_avg")
_columns("exec_new_vs_returning", "kpi_exec_summary", "month new_customers returning_customers")
_columns("exec_revenue_share", "kpi_exec_summary", "month total_revenue revenue_share_pct")
_columns("exec_retention_vs_churn", "kpi_exec_summary", "month retention_rate_pct churn_rate_pct")
_columns("exec_growth", "kpi_exec_summary", "month revenue_mom_growth_pct orders_mom_growth_pct")
_columns(
    "exec_table", "kpi_exec_summary",
    "month total_revenue revenue_mom_growth_pct revenue_3m_rolling_avg cumulative_revenue total_orders"
    " avg_order_value unique_buyers active_store_count distinct_products_sold new_customers returning_customers"
    " retention_rate_pct churn_rate_pct top_store_code top3_concentration_pct top_product_by_revenue"
    " product_diversity_index",
)

# --- revenue and orders tab ------------------------------------------------------------------------

_total("revenue_total", "kpi_revenue", "total_revenue", "total_revenue")
_max("revenue_cumulative", "kpi_revenue", "cumulative_revenue", "cumulative_revenue")
_mean("orders_avg_value", "kpi_orders", "avg_order_value", "avg_order_value")
_mean("orders_avg_items", "kpi_orders", "avg_items_per_order", "avg_items_per_order")
_columns(
    "revenue_trend_detail", "kpi_revenue",
    "month total_revenue revenue_3m_rolling_avg prev_month_revenue revenue_mom_growth_pct",
)
_columns("orders_volume", "kpi_orders", "month total_orders orders_mom_growth_pct")
_columns("order_value_vs_items", "kpi_orders", "month avg_order_value avg_items_per_order aov_mom_change_pct")
_columns(
    "product_detail", "sales_by_product",
    "product_id month total_revenue total_qty_sold unique_buyers avg_unit_price revenue_rank qty_rank",
)


def _product_totals(by_product: DataFrame) -> DataFrame:
    return by_product.groupBy("product_id").agg(
        F.sum("total_revenue").alias("total_revenue_all_time"), F.sum("total_qty_sold").alias("total_qty_all_time")
    )


@_register
def top_products_by_revenue(tables: Tables) -> DataFrame:
    order = [windows.desc("total_revenue_all_time"), F.col("product_id")]
    return top_k(_product_totals(tables["sales_by_product"]), order, 10)


@_register
def top_products_by_quantity(tables: Tables) -> DataFrame:
    order = [windows.desc("total_qty_all_time"), F.col("product_id")]
    return top_k(_product_totals(tables["sales_by_product"]), order, 10)


# --- customer and retention tab --------------------------------------------------------------------

_total("buyers_total", "kpi_customer_retention", "total_buyers", "total_buyers")
_total("new_customers_total", "kpi_customer_retention", "new_customers", "total_new_customers")
_mean("avg_retention_rate", "kpi_customer_retention", "retention_rate_pct", "avg_retention_rate_pct")
_mean("avg_churn_rate", "kpi_customer_retention", "churn_rate_pct", "avg_churn_rate_pct")
_mean("avg_new_customer_pct", "kpi_customer_retention", "new_customer_pct", "avg_new_customer_pct")
_columns(
    "customer_breakdown", "kpi_customer_retention",
    "month new_customers returning_customers retained_from_prev_month total_buyers",
)
_columns("retention_trend", "kpi_customer_retention", "month retention_rate_pct prev_month_buyers")
_columns("buyers_growth", "kpi_customer_retention", "month total_buyers buyers_mom_growth_pct")


@_register
def segment_distribution(tables: Tables) -> DataFrame:
    return count_rows(tables["sales_by_customer"], ["customer_segment"], "customer_count")


@_register
def segment_averages(tables: Tables) -> DataFrame:
    return tables["sales_by_customer"].groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        measures.mean("total_spend", 0).alias("avg_spend"),
        measures.mean("total_orders").alias("avg_orders"),
    )


@_register
def top_customers(tables: Tables) -> DataFrame:
    best = top_k(tables["sales_by_customer"], [windows.desc("total_spend"), F.col("customer_id")], 20)
    return best.select(
        "customer_id", "total_spend", "total_orders", "avg_order_value", "customer_segment",
        "days_since_last_purchase", "recency_score", "monetary_score",
    )


# --- store and product tab -------------------------------------------------------------------------

_max("max_active_stores", "kpi_store", "active_store_count", "active_stores")
_mean("avg_top3_concentration", "kpi_store", "top3_concentration_pct", "avg_top3_concentration")
_max("max_distinct_products", "kpi_product", "distinct_products_sold", "distinct_products")
_mean("avg_diversity_index", "kpi_product", "product_diversity_index", "avg_diversity_index", 4)
_columns(
    "network_growth", "kpi_store", "month total_market_revenue market_revenue_mom_growth_pct avg_revenue_per_store"
)
_columns(
    "diversity_trend", "kpi_product",
    "month product_diversity_index distinct_products_sold top_product_by_revenue top_product_revenue_share_pct",
)
_columns(
    "store_month_table", "store_performance",
    "initial_store_code month total_revenue total_orders unique_customers avg_order_value revenue_rank cumulative_revenue",
)


@_register
def latest_top_store(tables: Tables) -> DataFrame:
    return top_k(tables["kpi_store"], [windows.desc("month")], 1).select("top_store_code")


@_register
def store_revenue_totals(tables: Tables) -> DataFrame:
    return tables["store_performance"].groupBy("initial_store_code").agg(
        F.sum("total_revenue").alias("total_revenue_all_time"),
        F.sum("total_orders").alias("total_orders_all_time"),
        F.countDistinct("month").alias("months_active"),
    )


@_register
def product_revenue_share(tables: Tables) -> DataFrame:
    """Share of all revenue per product. The total is a scalar subquery, not a window over all products."""
    mart = tables["sales_by_product"]
    everything = mart.agg(F.sum("total_revenue")).scalar()
    products = mart.groupBy("product_id").agg(F.sum("total_revenue").alias("total_revenue"))
    share = measures.ratio(F.col("total_revenue"), everything, 2, pct=True)
    return products.withColumn("revenue_share_pct", share)


# --- audits from raw data to cards -----------------------------------------------------------------

_columns("kpi_revenue_shares", "kpi_revenue", "month total_revenue cumulative_revenue revenue_share_pct")
_columns(
    "kpi_retention_rates", "kpi_customer_retention",
    "month retained_from_prev_month prev_month_buyers retention_rate_pct churn_rate_pct",
)
_columns(
    "kpi_retention_audit", "kpi_customer_retention",
    "month total_buyers new_customers retained_from_prev_month prev_month_buyers retention_rate_pct churn_rate_pct",
)
_mean("exec_avg_retention_exact", "kpi_exec_summary", "retention_rate_pct", "avg_retention_rate", 6)
_card("exec_all_months", "kpi_exec_summary", lambda df: df)
_card("code_history_listing", "code_history", lambda df: df)


def _batch_day() -> Column:
    return F.to_date("partition_time").alias("batch")


@_register
def sales_batch_profile(tables: Tables) -> DataFrame:
    return tables["src_sales"].groupBy(_batch_day()).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_amount").alias("revenue_raw")
    )


for _source in ("src_sales", "src_store", "src_customer"):
    _card(f"{_source}_batch_rows", _source, lambda df: df.groupBy(_batch_day()).agg(F.count(F.lit(1)).alias("rows")))


@_register
def fact_date_range(tables: Tables) -> DataFrame:
    return tables["fact_sales"].agg(
        F.count(F.lit(1)).alias("total_rows"), F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date")
    )


@_register
def fact_month_profile(tables: Tables) -> DataFrame:
    months = aggregate_distinct(
        tables["fact_sales"], {"_m": calendar.month_start(F.col("order_date"))},
        {"total_orders": "order_id", "unique_buyers": "customer_id"},
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_amount").alias("revenue"),
        measures.mean("total_amount").alias("avg_order_value"),
    )
    return months.withColumn("month", calendar.month_key(F.col("_m"))).drop("_m")


@_register
def raw_code_store_months(tables: Tables) -> DataFrame:
    """Store x month on the code as sold, before identities are resolved."""
    months = tables["fact_sales"].groupBy("store_code", calendar.month_start(F.col("order_date")).alias("_m")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("total_amount").alias("revenue"),
    )
    return months.withColumn("month", calendar.month_key(F.col("_m"))).drop("_m")


@_register
def buyer_list(tables: Tables) -> DataFrame:
    """Buyers of each month, one row per buyer: a month's buyers are too many for one text cell."""
    buyers = monthly_buyers(tables["fact_sales"]).filter("customer_id is not null")
    totals = buyers.groupBy("month").agg(F.count("customer_id").alias("total_buyers"))
    # one row per calendar month
    return buyers.join(F.broadcast(totals), "month").select("month", "total_buyers", "customer_id")


@_register
def retained_list(tables: Tables) -> DataFrame:
    """Buyers of each month who had bought in the month before, one row per buyer."""
    retained = retained_buyers(monthly_buyers(tables["fact_sales"]))
    totals = tables["kpi_customer_retention"].select(
        "month", "total_buyers", F.col("retained_from_prev_month").alias("retained_count")
    )
    # one row per calendar month
    return retained.join(F.broadcast(totals), "month").select("month", "total_buyers", "retained_count", "customer_id")


@_register
def layer_row_counts(tables: Tables) -> DataFrame:
    names = [
        "src_sales", "fact_sales", "kpi_exec_summary", "kpi_revenue", "kpi_orders", "kpi_customer_retention",
        "kpi_store", "kpi_product", "store_performance", "store_directory", "sales_summary", "sales_by_product",
        "sales_by_customer",
    ]
    return row_counts({name: tables[name] for name in names})
