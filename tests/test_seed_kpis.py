"""Known figures of the small data set, from raw sales to cards."""

import pytest
import seed

from tillwise.operators import facts, identity, kpis
from tillwise.operators.reports import REPORTS, report
from tillwise.operators.snapshots import customer_history
from tillwise.plans.layers import Layers


@pytest.fixture(scope="module")
def layers(spark):
    sources = seed.load_fixture(spark)
    src = sources["src_sales"]
    fact = facts.build_fact_sales(src, seed.MONTHS[-1]).cache()
    history = identity.build_code_history(sources["src_store"], seed.MONTHS[-1]).cache()
    base = {**sources, "fact_sales": fact, "code_history": history, "dim_customer": customer_history(sources["src_customer"])}
    return Layers(base, seed.AS_OF, keep=lambda df, name: df.cache())


def test_revenue(layers):
    got = seed.rows_of(layers["kpi_revenue"], "month", "total_orders", "unique_buyers", "total_revenue",
                       "revenue_mom_growth_pct", "revenue_3m_rolling_avg", "cumulative_revenue", "revenue_share_pct")
    assert got == [
        ("2026-01", 10, 9, 1230000, None, 1230000, 1230000, 39.17),
        ("2026-02", 7, 7, 910000, -26.02, 1070000, 2140000, 28.98),
        ("2026-03", 7, 7, 1000000, 9.89, 1046666.67, 3140000, 31.85),
    ]


def test_orders(layers):
    got = seed.rows_of(layers["kpi_orders"], "month", "avg_order_value", "avg_items_per_order",
                       "orders_mom_growth_pct", "aov_mom_change_pct", "avg_revenue_per_store")
    assert got == [
        ("2026-01", 123000, 2.20, None, None, 246000),
        ("2026-02", 130000, 2.14, -30, 5.69, 182000),
        ("2026-03", 142857.14, 2.14, 0, 9.89, 200000),
    ]


def test_retention(layers):
    got = seed.rows_of(layers["kpi_customer_retention"], "month", "total_buyers", "new_customers", "returning_customers",
                       "retained_from_prev_month", "prev_month_buyers", "retention_rate_pct", "churn_rate_pct",
                       "new_customer_pct", "buyers_mom_growth_pct")
    assert got == [
        ("2026-01", 9, 9, 0, 0, None, None, None, 100, None),
        ("2026-02", 7, 5, 2, 2, 9, 22.22, 77.78, 71.43, -22.22),
        ("2026-03", 7, 0, 7, 3, 7, 42.86, 57.14, 0, 0),
    ]


def test_store_and_product(layers):
    got = seed.rows_of(layers["kpi_store"], "month", "active_store_count", "top_store_code", "top_store_revenue",
                       "bottom_store_code", "top3_concentration_pct", "market_revenue_mom_growth_pct")
    assert got == [
        ("2026-01", 5, "Y004", 290000, "Y001", 67.48, None),
        ("2026-02", 5, "Y001", 290000, "Y002", 73.63, -26.02),
        ("2026-03", 5, "Y001", 290000, "Y004", 73.00, 9.89),
    ]
    got = seed.rows_of(layers["kpi_product"], "month", "top_product_by_revenue", "top_product_revenue_share_pct",
                       "product_diversity_index", "product_count_mom_change", "top_product_by_qty")
    assert got == [
        ("2026-01", "PRD003", 29.27, 0.7073, 4, "PRD004"),
        ("2026-02", "PRD003", 39.56, 0.6044, 0, "PRD001"),
        ("2026-03", "PRD003", 36.00, 0.6400, 0, "PRD001"),
    ]


def test_exec_summary(layers):
    wide = layers["kpi_exec_summary"]
    assert len(wide.columns) == 44 and wide.columns[0] == "month"
    assert wide.columns[1:] == [c for cols in kpis.EXEC_COLUMNS.values() for c in cols]
    assert wide.count() == 3


def test_marts(layers):
    sums = layers["sales_summary"].groupBy("grain").count()
    assert seed.rows_of(sums) == [("daily", 23), ("monthly", 3)]
    assert layers["store_performance"].count() == 15
    assert layers["sales_by_product"].count() == 12
    assert seed.rows_of(report("segment_distribution", layers)) == [("At Risk", 4), ("Loyal", 4), ("Need Attention", 6)]
    assert report("top_customers", layers).first()["customer_id"] == "CUST003"
    assert layers["customer_profile"].count() == 14


def test_cards(layers):
    one = lambda name: float(report(name, layers).first()[0])
    assert one("exec_total_revenue") == one("revenue_total") == one("revenue_cumulative") == 3140000
    assert one("exec_total_orders") == 24
    assert one("exec_sum_monthly_buyers") == one("buyers_total") == 23
    assert one("exec_avg_order_value") == one("orders_avg_value") == 131952.38
    assert one("exec_avg_retention") == one("avg_retention_rate") == 32.54
    assert one("avg_churn_rate") == 67.46
    assert one("orders_avg_items") == 2.16
    assert one("avg_new_customer_pct") == 57.14
    assert one("new_customers_total") == 14
    assert one("avg_top3_concentration") == 71.37
    assert one("avg_diversity_index") == 0.6506
    assert one("max_active_stores") == 5 and one("max_distinct_products") == 4
    assert report("latest_top_store", layers).first()[0] == "Y001"
    assert [tuple(map(str, r)) for r in report("top_products_by_revenue", layers).collect()] == [
        ("PRD003", "1080000.00", "9"), ("PRD001", "800000.00", "16"), ("PRD002", "750000.00", "10"), ("PRD004", "510000.00", "17"),
    ]
    assert seed.rows_of(report("product_revenue_share", layers)) == [
        ("PRD001", 800000, 25.48), ("PRD002", 750000, 23.89), ("PRD003", 1080000, 34.39), ("PRD004", 510000, 16.24),
    ]
    assert seed.rows_of(report("store_revenue_totals", layers), "initial_store_code", "total_revenue_all_time") == [
        ("Y001", 755000), ("Y002", 600000), ("Y003", 620000), ("Y004", 610000), ("Y005", 555000),
    ]
    assert [r[3] for r in seed.rows_of(report("retained_list", layers))] == ["CUST002", "CUST003", "CUST002", "CUST003", "CUST010"]


def test_every_report_runs(layers):
    for name in REPORTS:
        assert report(name, layers).collect(), name


def test_revenue_is_conserved(layers):
    total = layers["fact_sales"].agg({"total_amount": "sum"}).first()[0]
    for table in ("store_performance", "sales_by_product", "kpi_revenue"):
        assert layers[table].agg({"total_revenue": "sum"}).first()[0] == total, table
