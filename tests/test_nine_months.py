"""The monthly figures of nine known batches, built at once and batch by batch."""

import datetime as dt

import nine_months
import pytest
import seed
from pyspark.sql import functions as F

from tillwise.operators import customer_marts, facts, identity, kpis, mergeable, sales_marts, store_marts

D = seed.D
LAST = D("2026-09-01")
AS_OF = D("2026-10-01")


@pytest.fixture(scope="module")
def fact(spark):
    rows = [seed.sale(i, day, s, c, p, q, price, D(batch), total) for i, (day, s, c, p, q, price, total, batch) in enumerate(nine_months.SALES, 1)]
    return facts.build_fact_sales(seed.sales(spark, rows), LAST).cache()


@pytest.fixture(scope="module")
def history(spark):
    stores = [(str(dt.date(2026, m, 1)), f"Y00{i}", f"-{i}", "100") for m in range(1, 10) for i in range(1, 6)]
    return identity.build_code_history(seed.stores(spark, stores), LAST)


def figures(spark, fact, history, retention):
    by_store = kpis.kpi_store(store_marts.store_performance(fact, history))
    by_product = kpis.kpi_product(sales_marts.product_months(fact))
    revenue, orders = kpis.kpi_revenue(fact), kpis.kpi_orders(fact)
    joined = (
        revenue.select("month", "total_revenue", "revenue_mom_growth_pct", "revenue_3m_rolling_avg", "cumulative_revenue")
        .join(orders.select("month", "total_orders", "unique_buyers", "avg_order_value", "avg_items_per_order"), "month")
        .join(retention.select("month", "new_customers", "retained_from_prev_month", "retention_rate_pct"), "month")
        .join(by_store.select("month", "top3_revenue", "top3_concentration_pct"), "month")
        .join(by_product.select("month", "product_diversity_index"), "month")
    )
    return seed.rows_of(
        joined, "month", "total_orders", "unique_buyers", "new_customers", "retained_from_prev_month", "retention_rate_pct", "total_revenue",
        "revenue_mom_growth_pct", "avg_order_value", "avg_items_per_order", "revenue_3m_rolling_avg", "cumulative_revenue", "top3_revenue",
        "top3_concentration_pct", "product_diversity_index",
    )


def test_months(spark, fact, history):
    assert figures(spark, fact, history, kpis.kpi_customer_retention(fact)) == nine_months.MONTHS


def test_retention_and_customers_from_monthly_parts(spark, fact, history):
    months = [fact.filter(F.month("partition_time") == m) for m in range(1, 10)]
    held = mergeable.merge_buyer_months(*[mergeable.buyer_months(m) for m in months])
    got = seed.rows_of(kpis.retention_of_months(mergeable.retention_months(held)), "month", "total_buyers", "new_customers", "retained_from_prev_month", "retention_rate_pct")
    assert got == [(r[0], *r[2:6]) for r in nine_months.MONTHS]
    parts = customer_marts.customer_parts(months[0])
    for m in months[1:]:
        parts = parts.unionByName(customer_marts.customer_parts(m, unique_orders=True))
    rated = customer_marts.customer_value(customer_marts.merge_customer_parts(parts), AS_OF)
    assert dict(rated.groupBy("customer_segment").count().collect()) == nine_months.SEGMENTS
    top = rated.orderBy(F.desc("total_spend"), "customer_id").first()
    assert (top.customer_id, int(top.total_spend)) == ("CUST001", 3035000)


def test_row_counts(fact, history):
    assert fact.count() == 192
    assert store_marts.store_performance(fact, history).count() == 45
    assert sales_marts.sales_by_product(fact).count() == 36
    assert dict(sales_marts.sales_summary(fact).groupBy("grain").count().collect()) == {"daily": 147, "monthly": 9}
