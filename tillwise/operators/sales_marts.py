"""Sales marts: period summary, product by month, price bands.

``unique_orders`` states that no order id occurs twice in the fact (see ``quality.check_unique``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions import calendar, measures, windows
from tillwise.functions.aggregates import order_count
from tillwise.operators.relational import aggregate_distinct, rank_in_slices


def daily_sales(fact: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    counted, orders = order_count("total_orders", unique_orders)
    return aggregate_distinct(
        fact, {"order_date": F.col("order_date")},
        {"unique_customers": "customer_id", "active_stores": "store_code"} | orders,
        F.sum("quantity").alias("total_qty"),
        F.sum("total_amount").alias("total_revenue"),
        measures.mean("total_amount").alias("avg_order_value"),
        *counted,
    ).withColumn("month", calendar.month_key(F.col("order_date")))


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """Months from days: customers are summed, stores are the best day, order value is a mean of means."""
    return _summed(daily, "month")


def _summed(days: DataFrame, *keys: str) -> DataFrame:
    return days.groupBy(*keys).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("unique_customers").alias("unique_customers"),
        F.max("active_stores").alias("active_stores"),
        F.sum("total_qty").alias("total_qty"),
        F.sum("total_revenue").alias("total_revenue"),
        measures.mean("avg_order_value").alias("avg_order_value"),
    )


def sales_summary(fact: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """Days and months in one table.

    Sales are reduced to days once. Each day then counts towards two periods, itself and its month;
    a day's own period has that one row, which every aggregate leaves as it is.
    """
    periods = F.array(
        F.struct(F.lit("daily").alias("grain"), F.col("order_date").cast("string").alias("period")),
        F.struct(F.lit("monthly").alias("grain"), F.col("month").alias("period")),
    )
    days = daily_sales(fact, unique_orders=unique_orders).select("*", F.inline(periods))
    both = _summed(days, "grain", "period", "month")
    growth = measures.growth_pct(F.col("total_revenue"), windows.prev("total_revenue", "month", ["grain"]))
    return both.select(
        "grain", "period", "month", "total_orders", "unique_customers", "active_stores", "total_qty", "total_revenue",
        "avg_order_value", F.when(F.col("grain") == "monthly", growth).alias("revenue_growth_pct"),
    )


def product_months(fact: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """Product x month."""
    counted, orders = order_count("total_transactions", unique_orders)
    monthly = aggregate_distinct(
        fact, {"product_id": F.col("product_id"), "_m": calendar.month_start(F.col("order_date"))},
        {"unique_buyers": "customer_id", "sold_in_stores": "store_code"} | orders,
        F.sum("quantity").alias("total_qty_sold"),
        F.sum("total_amount").alias("total_revenue"),
        measures.mean("unit_price").alias("avg_unit_price"),
        F.min("unit_price").alias("min_unit_price"),
        F.max("unit_price").alias("max_unit_price"),
        *counted,
    )
    return monthly.select(
        "product_id", calendar.month_key(F.col("_m")).alias("month"), "total_transactions", "unique_buyers",
        "sold_in_stores", "total_qty_sold", "total_revenue", "avg_unit_price", "min_unit_price", "max_unit_price",
    )


def sales_by_product(fact: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """Product x month with ranks inside the month."""
    ranks = {"revenue_rank": "total_revenue", "qty_rank": "total_qty_sold"}
    return rank_in_slices(product_months(fact, unique_orders=unique_orders), "month", ranks, ["product_id"])


def price_band(by_product: DataFrame, low, high) -> DataFrame:
    """Budget below ``low``, Premium from ``high``, Mid between, by average unit price."""
    price = F.col("avg_unit_price")
    band = F.when(price < F.lit(low), "Budget").when(price >= F.lit(high), "Premium").when(price.isNotNull(), "Mid")
    return by_product.withColumn("price_band", band)
