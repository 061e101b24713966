from decimal import Decimal

import pytest
import seed
from pyspark.sql import functions as F

from tillwise.operators import customer_marts, facts, kpis, sales_marts, snapshots, store_marts
from tillwise.schemas import CODE_HISTORY, OPEN_END, SRC_SALES

D = seed.D
AS_OF = D("2026-10-01")


def history(spark, *codes):
    return spark.createDataFrame([(c, c, D("2026-01-01"), OPEN_END) for c in codes], CODE_HISTORY)


# --- fact ------------------------------------------------------------------------------------------


def test_fact_load_and_append(spark):
    s = seed.sale
    src = seed.sales(spark, [
        s(1, "2026-01-05", " y1", "c1 ", "p1", 1, 10), s(1, "2026-01-05", "y1", "c1", "p1", 2, 10),
        s(2, "2026-02-05", "y1", "c1", "p1", 3, 10), s(2, "2026-02-05", "y1", "c1", "p1", 4, 10),
        s(1, "2026-01-05", "y1", "c1", "p1", 9, 10, batch=D("2026-02-01")),
        s(None, "2026-02-06", "y1", "c1", "p1", 5, 10), s(3, "2026-01-07", "y1", "c2", "p1", 6, 10, batch=D("2026-02-01")),
    ])
    january = facts.build_fact_sales(src, D("2026-01-01"))
    assert seed.rows_of(january, "order_id", "store_code", "customer_id", "quantity") == [(1, "Y1", "C1", 1), (1, "Y1", "C1", 2)]
    fresh = facts.new_fact_rows(src, january, D("2026-02-01"))
    # unseen orders only, repeated ones all kept, corrections ignored, a missing id always new
    assert seed.rows_of(fresh, "order_id", "quantity") == [(None, 5), (2, 3), (2, 4), (3, 6)]
    loaded = january.unionByName(fresh)
    assert seed.rows_of(facts.new_fact_rows(src, loaded, D("2026-02-01")), "quantity") == [(5,)]


# --- store marts -----------------------------------------------------------------------------------


def test_orphans_form_a_null_store(spark):
    s = seed.sale
    fact = seed.sales(spark, [
        s(1, "2026-01-05", "Y1", "C1", "P1", 1, 100), s(2, "2026-01-06", "??", "C2", "P1", 1, 300), s(3, "2026-01-07", "Y2", "C2", "P1", 1, 100)])
    mart = store_marts.store_performance(fact, history(spark, "Y1", "Y2"))
    assert seed.rows_of(mart, "initial_store_code", "revenue_rank", "total_revenue") == [(None, 1, 300), ("Y1", 2, 100), ("Y2", 2, 100)]
    kpi = kpis.kpi_store(mart).first()
    assert kpi["active_store_count"] == 2 and kpi["total_market_revenue"] == 500
    assert kpi["top_store_code"] is None and kpi["top_store_revenue"] == 300
    assert kpi["bottom_store_code"] == "Y1"
    directory = store_marts.store_directory(fact, history(spark, "Y1", "Y2", "Y3"))
    assert seed.rows_of(directory, "initial_store_code", "lifetime_revenue", "lifetime_orders") == [("Y1", 100, 1), ("Y2", 100, 1), ("Y3", 0, 0)]


def test_directory_status(spark):
    h = spark.createDataFrame([
        ("A", "A", D("2026-01-01"), D("2026-02-01")), ("A", "B", D("2026-02-01"), OPEN_END),
        ("C", "C", D("2026-01-01"), D("2026-03-01"))], CODE_HISTORY)
    out = store_marts.store_directory(seed.sales(spark, []), h)
    assert seed.rows_of(out, "initial_store_code", "current_store_code", "status", "active_since", "total_code_changes") == [
        ("A", "B", "active", D("2026-02-01"), 1), ("C", None, "closed", None, 0)]
    assert seed.rows_of(store_marts.store_code_journey(h)) == [("A", "A → B"), ("C", "C")]


def test_top3_counts_ties(spark):
    prices = {"Y1": 900, "Y2": 800, "Y3": 500, "Y4": 500, "Y5": 100}
    fact = seed.sales(spark, [seed.sale(i, "2026-01-05", y, "C", "P", 1, p) for i, (y, p) in enumerate(prices.items())])
    kpi = kpis.kpi_store(store_marts.store_performance(fact, history(spark, *prices))).first()
    assert kpi["top3_revenue"] == 2700 and float(kpi["top3_concentration_pct"]) == 96.43


# --- months ----------------------------------------------------------------------------------------


def test_gap_month_and_zero_month(spark):
    s = seed.sale
    fact = seed.sales(spark, [
        s(1, "2026-01-05", "Y", "C1", "P", 1, 100), s(2, "2026-03-05", "Y", "C1", "P", 1, 0), s(3, "2026-04-05", "Y", "C1", "P", 1, 50)])
    growth = kpis.kpi_revenue(fact)
    # previous month is the previous month with sales; growth on zero revenue is unknown
    assert seed.rows_of(growth, "month", "prev_month_revenue", "revenue_mom_growth_pct") == [
        ("2026-01", None, None), ("2026-03", 100, -100), ("2026-04", 0, None)]
    kept = kpis.kpi_customer_retention(fact)
    # retention needs the previous calendar month
    assert seed.rows_of(kept, "month", "retained_from_prev_month", "prev_month_buyers", "retention_rate_pct") == [
        ("2026-01", 0, None, None), ("2026-03", 0, 1, 0), ("2026-04", 1, 1, 100)]


def test_single_month(spark):
    fact = seed.sales(spark, [seed.sale(1, "2026-01-05", "Y", "C1", "P", 2, 100)])
    row = kpis.kpi_product(sales_marts.sales_by_product(fact)).first()
    assert row["product_count_mom_change"] == 1 and row["product_diversity_index"] == 0
    assert row["prev_month_product_revenue"] is None
    assert float(kpis.kpi_revenue(fact).first()["revenue_share_pct"]) == 100


def test_null_amounts(spark):
    rows = [(1, D("2026-01-05"), "Y", "C1", "P1", 1, None, None, D("2026-01-01")),
            (2, D("2026-01-05"), "Y", None, "P2", 1, Decimal(5), Decimal(5), D("2026-01-01"))]
    fact = spark.createDataFrame(rows, SRC_SALES)
    assert float(kpis.kpi_orders(fact).first()["avg_order_value"]) == 5
    ranks = sales_marts.sales_by_product(fact)
    assert seed.rows_of(ranks, "product_id", "revenue_rank") == [("P1", 1), ("P2", 2)]  # NULL revenue ranks first
    assert kpis.kpi_customer_retention(fact).first()["total_buyers"] == 1
    rated = customer_marts.sales_by_customer(fact, AS_OF)
    assert seed.rows_of(rated, "customer_id", "stores_visited", "customer_segment") == [(None, 1, None), ("C1", 1, "Need Attention")]


def test_summary_months_add_up_days(spark):
    s = seed.sale
    fact = seed.sales(spark, [
        s(1, "2026-01-05", "Y1", "C1", "P", 1, 100), s(1, "2026-01-05", "Y1", "C1", "Q", 1, 50),
        s(2, "2026-01-06", "Y1", "C1", "P", 1, 30), s(3, "2026-01-06", "Y2", "C2", "P", 1, 40)])
    out = sales_marts.sales_summary(fact)
    assert seed.rows_of(out.filter("grain = 'monthly'"), "period", "total_orders", "unique_customers", "active_stores", "avg_order_value") == [
        ("2026-01", 3, 3, 2, 55)]
    assert seed.rows_of(out.filter("grain = 'daily'"), "period", "total_orders", "avg_order_value", "revenue_growth_pct") == [
        ("2026-01-05", 1, 75, None), ("2026-01-06", 2, 35, None)]


# --- customers -------------------------------------------------------------------------------------


@pytest.mark.parametrize("days, orders, spend, scores, segment", [
    (30, 5, "300000", (3, 3, 3), "Champions"), (31, 5, "300000", (2, 3, 3), "Champions"),
    (90, 4, "299999.99", (2, 2, 2), "Loyal"), (91, 4, "99999.99", (1, 2, 1), "At Risk"),
    (90, 1, "99999.99", (2, 1, 1), "Promising"), (91, 1, "100000", (1, 1, 2), "Need Attention"),
    (30, 1, "300000", (3, 1, 3), "Loyal"), (91, 2, "100000", (1, 2, 2), "At Risk"),
])
def test_rfm_limits(spark, days, orders, spend, scores, segment):
    base = spark.createDataFrame([(days, orders, Decimal(spend))], "days_since_last_purchase int, total_orders int, total_spend decimal(12,2)")
    row = customer_marts.rfm_segment(customer_marts.rfm_scores(base)).first()
    assert (row["recency_score"], row["frequency_score"], row["monetary_score"]) == scores
    assert row["customer_segment"] == segment


def test_favorite_product_tie(spark):
    s = seed.sale
    fact = seed.sales(spark, [s(1, "2026-01-05", "Y", "C", "P2", 2, 1), s(2, "2026-01-05", "Y", "C", "P1", 1, 1), s(3, "2026-01-06", "Y", "C", "P1", 1, 1)])
    assert seed.rows_of(customer_marts.favorite_product(fact)) == [("C", "P1")]
    assert customer_marts.sales_by_customer(fact, AS_OF).first()["favorite_product_id"] == "P1"


def test_profile(spark):
    src = seed.customers(spark, [
        ("2026-01-01", " c1", "Bronze", " A@X "), ("2026-02-01", " c1", "Silver", " A@X "), ("2026-03-01", " c1", "Silver", "b@x"),
        ("2026-01-01", "c2", "Gold")])
    fact = seed.sales(spark, [seed.sale(1, "2026-01-05", "Y", "C1", "P", 1, 10), seed.sale(2, "2026-01-07", "Y", "C1", "P", 1, 10)])
    out = customer_marts.customer_profile(snapshots.customer_history(src), fact, AS_OF)
    got = out.select("customer_id", "email", "current_tier", "total_tier_upgrades", "tier_journey", "lifetime_orders",
                     F.col("tier_since").cast("date").cast("string").alias("since"), "days_since_last_purchase", "days_as_customer")
    # every version counts as a step, an e-mail change too
    assert seed.rows_of(got) == [
        ("C1", "b@x", "Silver", 2, "Bronze → Silver → Silver", 2, "2026-03-01", 267, 638),
        ("C2", "c2@x", "Gold", 0, "Gold", 0, "2026-01-01", None, 638)]


def test_price_band(spark):
    df = spark.createDataFrame([(Decimal(p),) for p in (9, 10, 19, 20)], "avg_unit_price decimal(12,2)")
    assert seed.rows_of(sales_marts.price_band(df, 10, 20)) == [(9, "Budget"), (10, "Mid"), (19, "Mid"), (20, "Premium")]


@pytest.mark.parametrize("build", [
    lambda f, h, u: store_marts.store_performance(f, h, unique_orders=u), lambda f, h, u: store_marts.store_directory(f, h, unique_orders=u),
    lambda f, h, u: sales_marts.sales_summary(f, unique_orders=u), lambda f, h, u: sales_marts.sales_by_product(f, unique_orders=u),
    lambda f, h, u: customer_marts.sales_by_customer(f, AS_OF, unique_orders=u), lambda f, h, u: kpis.kpi_orders(f, unique_orders=u),
    lambda f, h, u: kpis.kpi_revenue(f, unique_orders=u),
])
def test_unique_orders_changes_nothing_but_the_plan(spark, build):
    fact, h = facts.build_fact_sales(seed.sales(spark), seed.MONTHS[-1]), history(spark, "Y001", "Y002", "Y003", "Y004", "Y005")
    assert seed.rows_of(build(fact, h, True)) == seed.rows_of(build(fact, h, False))
