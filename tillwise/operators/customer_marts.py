"""Customer marts: value profile with RFM segments, and the customer directory.

``unique_orders`` states that no order id occurs twice in the fact (see ``quality.check_unique``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions import calendar, measures, windows
from tillwise.functions.aggregates import count_orders, ordered_concat
from tillwise.functions.text import clean_email, clean_id, clean_name
from tillwise.operators.relational import current_versions, first_per_group, left_star


RATING_COLUMNS = ["recency_score", "frequency_score", "monetary_score", "customer_segment"]


@dataclass(frozen=True)
class RfmConfig:
    """Score limits, best first (fixed values by default)."""

    recency_days: tuple[int, int] = (30, 90)
    orders: tuple[int, int] = (5, 2)
    spend: tuple[Decimal, Decimal] = (Decimal(300000), Decimal(100000))


def _score(best: Column, good: Column) -> Column:
    return F.when(best, 3).when(good, 2).otherwise(1)


def rfm_scores(base: DataFrame, cfg: RfmConfig = RfmConfig()) -> DataFrame:
    days, orders, spend = F.col("days_since_last_purchase"), F.col("total_orders"), F.col("total_spend")
    return base.withColumns({
        "recency_score": _score(*[days <= n for n in cfg.recency_days]),
        "frequency_score": _score(*[orders >= n for n in cfg.orders]),
        "monetary_score": _score(*[spend >= F.lit(n) for n in cfg.spend]),
    })


def rfm_segment(scored: DataFrame) -> DataFrame:
    """Segment by total score, then by the recency/frequency pattern; the first match wins."""
    r, f = F.col("recency_score"), F.col("frequency_score")
    total = r + f + F.col("monetary_score")
    segment = (
        F.when(total >= 8, "Champions")
        .when(total >= 6, "Loyal")
        .when((r >= 2) & (f == 1), "Promising")
        .when((r == 1) & (f >= 2), "At Risk")
        .otherwise("Need Attention")
    )
    return scored.withColumn("customer_segment", segment)


def _by_product(fact: DataFrame, *more: Column) -> DataFrame:
    return fact.groupBy("customer_id", "product_id").agg(F.sum("quantity").alias("qty"), *more)


def _favorite(bought: DataFrame) -> DataFrame:
    """Product bought most by quantity; the lesser product id on equal quantity. A task keeps one row per customer."""
    rows = bought.select("customer_id", "product_id", "qty")
    first = first_per_group(rows, ["customer_id"], [windows.desc("qty")], "product_id")
    return first.select("customer_id", F.col("product_id").alias("favorite_product_id"))


def favorite_product(fact: DataFrame) -> DataFrame:
    return _favorite(_by_product(fact))


def customer_parts(fact: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """What sales add to their customers, as rows that merge: per product, per store and, unless orders are unique, per order.

    Each reduction spreads a customer with very many sales over its products, stores or orders. ``part`` tells which
    of the three a row is. Parts of loads that share no order can be stored and united; see ``merge_customer_parts``.
    """
    amount, day = F.col("total_amount"), F.col("order_date")
    bought = _by_product(
        fact, F.sum(amount).alias("spend"), F.count(amount).alias("n"), F.min(day).alias("first"),
        F.max(day).alias("last"), *([F.count("order_id").alias("orders")] if unique_orders else []),
    )
    stores = fact.select("customer_id", "store_code").distinct()
    parts = [bought.withColumn("part", F.lit("product")), stores.withColumn("part", F.lit("store"))]
    if not unique_orders:
        orders = fact.select("customer_id", "order_id").distinct()
        known = F.col("order_id").isNotNull().cast("long")
        parts.append(orders.select("customer_id", "order_id", known.alias("orders"), F.lit("order").alias("part")))
    together = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    missing = {c: F.lit(None).cast(fact.schema[c].dataType if c in fact.columns else "long") for c in ("order_id", "orders") if c not in together.columns}
    return together.withColumns(missing)


_PART_KEYS = ["customer_id", "part", "product_id", "store_code", "order_id"]


def merge_customer_parts(parts: DataFrame) -> DataFrame:
    """Parts of several loads as those of all sales: one row per customer and product, store or order."""
    measure = {"qty": F.sum, "spend": F.sum, "n": F.sum, "orders": F.sum, "first": F.min, "last": F.max}
    merged = parts.groupBy(*_PART_KEYS).agg(*[f(c).cast(parts.schema[c].dataType).alias(c) for c, f in measure.items()])
    return merged.select(*parts.columns)


def sales_by_customer(
    fact: DataFrame, as_of: dt.date, cfg: RfmConfig = RfmConfig(), *, unique_orders: bool = False
) -> DataFrame:
    """Value profile per customer."""
    return customer_value(customer_parts(fact, unique_orders=unique_orders), as_of, cfg)


def customer_value(parts: DataFrame, as_of: dt.date, cfg: RfmConfig = RfmConfig()) -> DataFrame:
    """Value profile per customer from ``customer_parts`` or ``merge_customer_parts``, for any day.

    The parts are aggregated per customer in one shuffle and with numbers only, so that it stays a hash
    aggregation. The favourite product, a text, is found on its own and joined.
    """
    bought = parts.filter("part = 'product'")
    base = parts.groupBy("customer_id").agg(
        F.sum("orders").alias("total_orders"),
        F.count("store_code").alias("stores_visited"),
        F.count("product_id").alias("unique_products_bought"),
        F.sum("qty").alias("total_qty"),
        F.sum("spend").alias("total_spend"),
        measures.ratio(F.sum("spend"), F.sum("n")).alias("avg_order_value"),
        F.min("first").alias("first_purchase_date"),
        F.max("last").alias("last_purchase_date"),
    ).join(_favorite(bought.filter("customer_id is not null")), "customer_id", "left")
    first, last = F.col("first_purchase_date"), F.col("last_purchase_date")
    dated = base.withColumns({
        "customer_lifespan_days": calendar.days_between(last, first),
        "days_since_last_purchase": calendar.days_between(F.lit(as_of), last),
    })
    rated = rfm_segment(rfm_scores(dated, cfg))
    # sales without a customer are totalled but not rated
    known = F.col("customer_id").isNotNull()
    rated = rated.withColumns({c: F.when(known, F.col(c)) for c in ("favorite_product_id", *RATING_COLUMNS)})
    return rated.select(
        "customer_id", "total_orders", "stores_visited", "unique_products_bought", "total_qty", "total_spend",
        "avg_order_value", "first_purchase_date", "last_purchase_date", "customer_lifespan_days",
        "days_since_last_purchase", "favorite_product_id", *RATING_COLUMNS,
    )


def lifetime_sales(fact: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    return fact.groupBy("customer_id").agg(
        count_orders(unique_orders).alias("orders"),
        F.sum("total_amount").alias("spend"),
        F.min("order_date").alias("first_purchase_date"),
        F.max("order_date").alias("last_purchase_date"),
    )


def lifetime_of_parts(parts: DataFrame) -> DataFrame:
    """``lifetime_sales`` from parts, merged or not."""
    return parts.groupBy("customer_id").agg(
        F.sum("orders").alias("orders"), F.sum("spend").cast(parts.schema["spend"].dataType).alias("spend"),
        F.min("first").alias("first_purchase_date"), F.max("last").alias("last_purchase_date"),
    )


def customer_profile(
    dim_customer: DataFrame, fact: DataFrame, as_of: dt.date, *, unique_orders: bool = False
) -> DataFrame:
    """Current profile, tier history and lifetime sales of every customer with an open version."""
    return profile_with_sales(dim_customer, lifetime_sales(fact, unique_orders=unique_orders), as_of)


def profile_with_sales(dim_customer: DataFrame, lifetime: DataFrame, as_of: dt.date) -> DataFrame:
    """``customer_profile`` with sales that are added up already."""
    versions = dim_customer.select(
        clean_id(F.col("customer_id")).alias("customer_id"), clean_name(F.col("full_name")).alias("full_name"),
        clean_email(F.col("email")).alias("email"), "phone", clean_name(F.col("city")).alias("city"),
        clean_name(F.col("province")).alias("province"), "registration_date", "tier", "valid_from", "valid_to",
    )
    current = current_versions(versions).withColumnsRenamed({"tier": "current_tier", "valid_from": "tier_since"})
    journey = versions.groupBy("customer_id").agg(
        (F.count(F.lit(1)) - 1).alias("changes"), ordered_concat("tier", "valid_from", " → ").alias("tier_journey")
    )
    today = F.lit(as_of)
    return left_star(current, [journey, lifetime], "customer_id").select(
        "customer_id", "full_name", "email", "phone", "city", "province", "registration_date",
        calendar.days_between(today, F.col("registration_date")).alias("days_as_customer"),
        "current_tier", "tier_since", F.coalesce("changes", F.lit(0)).alias("total_tier_upgrades"), "tier_journey",
        F.coalesce("orders", F.lit(0)).alias("lifetime_orders"),
        F.coalesce("spend", F.lit(0)).alias("lifetime_spend"),
        "first_purchase_date", "last_purchase_date",
        calendar.days_between(today, F.col("last_purchase_date")).alias("days_since_last_purchase"),
    )
