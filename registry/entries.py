"""Registered queries: name -> (Spark function of the tables, SQL)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.oracle import c, d, half_up, n, pct, with_tables
from registry.views import AS_OF, CORRECTIONS, LAST_MONTH, MID, SCALED_RFM, YEARS, RetailTables, tables
from tillwise.functions import aggregates, calendar, measures, text, windows
from tillwise.operators import (
    customer_marts, facts, identity, kpis, mergeable, quality, relational, reports, sales_marts, snapshots, store_marts,
)
from tillwise.plans.monthly import RetailWarehouse
from tillwise.schemas import CUSTOMER_CHECK_COLUMNS, SALES_CHECK_COLUMNS, SRC_SALES, STORE_CHECK_COLUMNS, TIERS
from tillwise.sources import tables as sinks
from tillwise.sources.shared import fresh_path, store
from tillwise.streaming import arrivals

Query = Callable[[RetailTables], DataFrame]
SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types both engines share: integers as bigint, decimals as double, dates and times as text."""
    def cast(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegralType):
            return col.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            return col.cast("string").alias(field.name)
        return col
    return df.select(*[cast(f) for f in df.schema])


def entry(name: str, sql: str | None, fact: str = "sales"):
    def add(fn: Query) -> Query:
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = with_tables(sql, fact)
        return fn
    return add


def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain(SPARK[name](tables(spark, sf_dir)))


# === scans and sinks ===============================================================================

_BATCHES = "SELECT CAST(partition_time AS VARCHAR) AS partition_time, count(*) AS rows, CAST(sum(total_c) AS DOUBLE) / 1e2 AS total FROM sales"


def _per_batch(df: DataFrame) -> DataFrame:
    return df.groupBy("partition_time").agg(F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("total"))


@entry("source_read", "SELECT CAST(day AS VARCHAR) AS partition_time, tier, count(*) AS rows FROM src_customer GROUP BY ALL")
def _(t):
    path = fresh_path(t.spark)
    sinks.write_table(t["src_customer"], path)
    return sinks.read_source(t.spark, path, "src_customer").groupBy("partition_time", "tier").agg(F.count(F.lit(1)).alias("rows"))


@entry("scan_upto_batch", _BATCHES + " WHERE partition_time <= DATE '1999-06-01' GROUP BY ALL")
def _(t):
    return _per_batch(relational.upto_batch(t["fact_by_batch"], MID))


@entry("scan_one_batch", _BATCHES + " WHERE partition_time = DATE '1999-06-01' GROUP BY ALL")
def _(t):
    return _per_batch(relational.one_batch(t["fact_by_batch"], MID))


@entry("scan_all_batches", _BATCHES + " GROUP BY ALL")
def _(t):
    return _per_batch(relational.all_batches(t["fact_by_batch"]))


@entry("table_overwrite", _BATCHES + " GROUP BY ALL")
def _(t):
    path = fresh_path(t.spark)
    for df in (relational.upto_batch(t["fact_sales"], MID), t["fact_sales"]):
        sinks.write_table(df, path)
    return _per_batch(sinks.read_table(t.spark, path, t["fact_sales"].schema))


@entry("table_append", _BATCHES + " GROUP BY ALL")
def _(t):
    path, fact = fresh_path(t.spark), t["fact_sales"]
    sinks.append_rows(relational.upto_batch(fact, MID), path)
    stored = sinks.read_table(t.spark, path, fact.schema)
    sinks.append_rows(relational.not_in_target(fact, stored, "order_id"), path)
    return _per_batch(sinks.read_table(t.spark, path, fact.schema))


@entry("table_layout", _BATCHES + " WHERE partition_time >= DATE '1999-06-01' GROUP BY ALL")
def _(t):
    path = fresh_path(t.spark)
    sinks.write_table(t["fact_sales"], path, partition_by=["partition_time"], sort_by=["store_code"])
    return _per_batch(sinks.read_table(t.spark, path).filter(F.col("partition_time") >= F.lit(MID)))


@entry("table_clustered", _BATCHES + " GROUP BY ALL")
def _(t):
    path, fact = fresh_path(t.spark), t["fact_sales"]
    sinks.write_clustered(fact, path, ["store_code", "order_date"], files=16)
    return _per_batch(sinks.read_table(t.spark, path, fact.schema))


@entry("table_merge", f"""
    SELECT customer_id, CASE WHEN qty > 500 THEN 'big' ELSE 'any' END AS label, {n('orders')} FROM buyer_base""")
def _(t):
    base = t["sales_by_customer"]
    every = base.select("customer_id", F.lit("any").alias("label"), F.col("total_orders").alias("orders"))
    big = base.filter("total_qty > 500").select("customer_id", F.lit("big").alias("label"), F.col("total_orders").alias("orders"))
    return relational.merge_rows(every, big, ["customer_id"])


@entry("view_sink", "SELECT count(*) AS stores FROM code_history WHERE end_date = DATE '9999-12-31'")
def _(t):
    sinks.register_view(identity.active_store(t["code_history"]), "active_store")
    return t.spark.sql("SELECT count(*) AS stores FROM active_store")


# === expressions ===================================================================================

_TITLE = (
    "array_to_string(list_transform(regexp_extract_all(lower(trim({0})), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'),"
    " lambda w: upper(w[1]) || w[2:]), '')"
)


@entry("clean_id", f"SELECT store_code, customer_id, {n('count(*)', 'rows')} FROM sales GROUP BY ALL")
def _(t):
    cleaned = t["src_sales"].select(*[text.clean_id(F.col(x)).alias(x) for x in ("store_code", "customer_id")])
    return relational.count_rows(cleaned, ["store_code", "customer_id"])


@entry("clean_name", f"SELECT customer_id, {_TITLE.format('full_name')} AS full_name, count(*) AS batches FROM src_customer GROUP BY ALL")
def _(t):
    return t["src_customer"].groupBy("customer_id", text.clean_name(F.col("full_name")).alias("full_name")).agg(
        F.count(F.lit(1)).alias("batches"))


@entry("clean_name_parts", f"SELECT p_partkey, {_TITLE.format('p_name')} AS p_name, {_TITLE.format('p_brand')} AS p_brand FROM part")
def _(t):
    return t.raw("part").select("p_partkey", *[text.clean_name(F.col(x)).alias(x) for x in ("p_name", "p_brand")])


@entry("clean_email", "SELECT customer_id, lower(trim(email)) AS email, count(*) AS batches FROM src_customer GROUP BY ALL")
def _(t):
    return t["src_customer"].groupBy("customer_id", text.clean_email(F.col("email")).alias("email")).agg(
        F.count(F.lit(1)).alias("batches"))


def _orders_by_month(t):
    months = t.raw("orders").groupBy(calendar.month_start(F.col("o_orderdate")).alias("m")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("spend"))
    return months.withColumn("month", calendar.month_key(F.col("m")))


@entry("month_key", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders FROM orders GROUP BY ALL")
def _(t):
    return _orders_by_month(t).select("month", "orders")


@entry("prev_month_key", """
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month,
           strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m') AS before FROM orders""")
def _(t):
    return _orders_by_month(t).select("month", calendar.prev_month_key(F.col("month")).alias("before"))


@entry("casts", """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_text, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS growth FROM orders""")
def _(t):
    return t.raw("orders").select(
        F.col("o_orderkey").cast("string").alias("order_text"), F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"), F.lit(None).cast("double").alias("growth"))


_SEGMENT_MONTHS = """(SELECT c_mktsegment AS segment, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders,
    count(DISTINCT o_custkey) AS buyers, sum(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT)) AS spend_c,
    sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS done FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)"""


def _segment_months(t):
    joined = t.raw("orders").join(t.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
    months = joined.groupBy(F.col("c_mktsegment").alias("segment"), calendar.month_start(F.col("o_orderdate")).alias("m")).agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("o_custkey").alias("buyers"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("spend"),
        F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    return months.withColumn("month", calendar.month_key(F.col("m"))).drop("m")


@entry("growth_pct", f"""
    SELECT segment, month, {c(pct('(done - p)', 'p'), 'growth')}
    FROM (SELECT *, lag(done) OVER (PARTITION BY segment ORDER BY month) AS p FROM {_SEGMENT_MONTHS})""")
def _(t):
    before = windows.prev("done", "month", ["segment"])
    return _segment_months(t).select("segment", "month", measures.growth_pct(F.col("done"), before).alias("growth"))


@entry("ratio", f"""
    SELECT segment, month, {c(half_up('spend_c', 'done'), 'spend_per_done')}, {c(pct('done', 'orders'), 'done_pct')}
    FROM {_SEGMENT_MONTHS}""")
def _(t):
    return _segment_months(t).select(
        "segment", "month", measures.ratio(F.col("spend"), F.col("done")).alias("spend_per_done"),
        measures.ratio(F.col("done"), F.col("orders"), 2, pct=True).alias("done_pct"))


@entry("one_minus_ratio", f"""
    SELECT segment, month, CAST({half_up('(orders - done)', 'orders', 10000)} AS DOUBLE) / 1e4 AS open_share,
           {c(pct('(orders - done)', 'orders'), 'open_pct')} FROM {_SEGMENT_MONTHS}""")
def _(t):
    done, orders = F.col("done"), F.col("orders")
    return _segment_months(t).select(
        "segment", "month", measures.one_minus_ratio(done, orders, 4).alias("open_share"),
        measures.one_minus_ratio(done, orders, 2, pct=True).alias("open_pct"))


@entry("retention_pct", f"""
    SELECT segment, month, {c(pct('buyers', 'p'), 'kept_pct')}
    FROM (SELECT *, lag(buyers) OVER (PARTITION BY segment ORDER BY month) AS p FROM {_SEGMENT_MONTHS})""")
def _(t):
    before = windows.prev("buyers", "month", ["segment"])
    return _segment_months(t).select("segment", "month", measures.retention_pct(F.col("buyers"), before).alias("kept_pct"))


@entry("coalesce_default", """
    SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def _(t):
    counted = relational.count_rows(t.raw("orders"), ["o_custkey"], "orders").withColumnRenamed("o_custkey", "c_custkey")
    joined = relational.left_star(t.raw("customer").select("c_custkey"), [counted], "c_custkey")
    return joined.select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"))


@entry("days_between", f"SELECT customer_id, {n('last_day - first_day', 'span')}, {n("DATE '2001-08-01' - last_day", 'idle')} FROM buyer_base")
def _(t):
    ends = t["fact_sales"].groupBy("customer_id").agg(F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    return ends.select("customer_id", calendar.days_between(F.col("b"), F.col("a")).alias("span"),
                       calendar.days_between(F.lit(AS_OF), F.col("b")).alias("idle"))


@entry("string_concat", "SELECT month || '-01' AS first_day, count(*) AS orders FROM sales GROUP BY ALL")
def _(t):
    return _month_orders(t).select(F.concat("month", F.lit("-01")).alias("first_day"), F.col("orders"))


def _month_orders(t):
    months = t["fact_sales"].groupBy(calendar.month_start(F.col("order_date")).alias("m")).agg(F.count(F.lit(1)).alias("orders"))
    return months.select(calendar.month_key(F.col("m")).alias("month"), "orders")


@entry("tolerance", f"""
    SELECT {d('order_date', 'day')}, count(*) AS off FROM sales WHERE abs(total_c - quantity * price_c) > 10 GROUP BY ALL""")
def _(t):
    off = t["fact_sales"].filter(quality.inconsistent_total("total_amount", "quantity", "unit_price", 0.1))
    return relational.count_rows(off, ["order_date"], "off").withColumnRenamed("order_date", "day")


@entry("literal_tag", "SELECT 'monthly' AS grain, month, count(*) AS orders FROM sales GROUP BY ALL")
def _(t):
    return _month_orders(t).select(F.lit("monthly").alias("grain"), "month", "orders")


# === filters =======================================================================================

_HISTORY = f"SELECT initial_store_code, store_code, {d('start_date')}, {d('end_date')} FROM code_history"


@entry("status_active", _HISTORY + " WHERE end_date = DATE '9999-12-31'")
def _(t):
    return relational.store_by_status(t["code_history"], "active")


@entry("status_closed", _HISTORY + " WHERE end_date < DATE '1999-01-01'")
def _(t):
    return relational.store_by_status(t["code_history"], "closed", dt.date(1999, 1, 1))


@entry("status_other", _HISTORY)
def _(t):
    return relational.store_by_status(t["code_history"], "any")


@entry("current_versions", "SELECT customer_id, tier FROM dim_customer WHERE valid_to IS NULL")
def _(t):
    return relational.current_versions(t["dim_customer"]).select("customer_id", "tier")


@entry("top_rows", f"SELECT product_id, month, {n('revenue_rank')} FROM products WHERE revenue_rank <= 3")
def _(t):
    return relational.top_rows(t["sales_by_product"], "revenue_rank", 3).select("product_id", "month", "revenue_rank")


@entry("not_in_list", "SELECT customer_id, tier FROM dim_customer WHERE tier NOT IN ('Silver', 'Gold')")
def _(t):
    return relational.not_in(t["dim_customer"], "tier", ("Silver", "Gold")).select("customer_id", "tier")


@entry("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(t):
    return relational.duplicate_keys(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@entry("history_of_key", f"SELECT {d('valid_from')}, {d('valid_to')}, tier FROM dim_customer WHERE customer_id = 'c7'")
def _(t):
    return relational.history_of(t["dim_customer"], "customer_id", "c7").select("valid_from", "valid_to", "tier")


# === joins =========================================================================================

_PLACED = f"SELECT initial_store_code, store_code, {n('count(*)', 'rows')}, {c('sum(total_c)', 'total')} FROM placed"


@entry("asof_version_join", _PLACED + " GROUP BY ALL")
def _(t):
    placed = relational.asof_version_join(t["fact_sales"], t["code_history"], "store_code", "order_date")
    return placed.groupBy("initial_store_code", "store_code").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("total"))


@entry("asof_version_join_tiers", f"""
    SELECT tier, {n('count(*)', 'rows')}, {c('sum(total_c)', 'total')} FROM sales s LEFT JOIN dim_customer v
    ON upper(v.customer_id) = s.customer_id AND s.order_date >= valid_from
       AND s.order_date < coalesce(valid_to, DATE '9999-12-31') GROUP BY ALL""")
def _(t):
    versions = t["dim_customer"].select(
        text.clean_id(F.col("customer_id")).alias("customer_id"), "tier", F.to_date("valid_from").alias("start_date"),
        F.coalesce(F.to_date("valid_to"), F.lit(dt.date(9999, 12, 31))).alias("end_date"))
    joined = relational.asof_version_join(t["fact_sales"], versions, "customer_id", "order_date")
    return joined.groupBy("tier").agg(F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("total"))


@entry("asof_version_sweep", _PLACED + " GROUP BY ALL")
def _(t):
    versions = t["code_history"].withColumnRenamed("store_code", "code")
    placed = relational.asof_version_sweep(t["fact_sales"].withColumn("code", F.col("store_code")), versions, "code", "order_date")
    return placed.groupBy("initial_store_code", "store_code").agg(F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("total"))


@entry("map_to_identity", "SELECT initial_store_code, store_code, count(*) AS batches FROM src_store JOIN store_names USING (latitude, longitude) GROUP BY ALL")
def _(t):
    stores = t["src_store"].withColumn("store_code", text.clean_id(F.col("store_code")))
    mapped = relational.map_to_identity(stores, identity.initial_store(t["src_store"]))
    return relational.count_rows(mapped, ["initial_store_code", "store_code"], "batches")


_STATE_1998 = """(SELECT initial_store_code, store_code, start_date, CASE WHEN end_date > DATE '1998-12-01' THEN DATE '9999-12-31'
    ELSE end_date END AS end_date FROM code_history WHERE start_date <= DATE '1998-12-01')"""
_BATCH_1999 = """(SELECT DISTINCT initial_store_code, store_code, day FROM src_store JOIN store_names USING (latitude, longitude)
    WHERE day = DATE '1999-01-01')"""


def _state_1998(t):
    return identity.build_code_history(t["src_store"], dt.date(1998, 12, 1))


def _batch_1999(t):
    return identity.store_mapping(t["src_store"], dt.date(1999, 1, 1), t["store_seen_1998"])


@entry("store_mapping", f"SELECT initial_store_code, store_code, {d('day', 'start_date')} FROM {_BATCH_1999}")
def _(t):
    return _batch_1999(t)


@entry("closed_rows", f"""
    SELECT s.initial_store_code, s.store_code, {d('s.start_date', 'start_date')}, {d('b.day', 'end_date')}
    FROM {_STATE_1998} s JOIN {_BATCH_1999} b ON s.initial_store_code = b.initial_store_code
    WHERE s.end_date = DATE '9999-12-31' AND s.store_code <> b.store_code""")
def _(t):
    return identity.closed_rows(_state_1998(t), _batch_1999(t))


@entry("new_rows", f"""
    SELECT initial_store_code, store_code, {d('day', 'start_date')}, '9999-12-31' AS end_date FROM {_BATCH_1999} b
    WHERE NOT EXISTS (SELECT 1 FROM {_STATE_1998} s WHERE s.initial_store_code = b.initial_store_code
                      AND s.store_code = b.store_code AND s.end_date = DATE '9999-12-31')""")
def _(t):
    return identity.new_rows(_state_1998(t), _batch_1999(t))


@entry("not_in_target", _BATCHES + " WHERE partition_time > DATE '1999-06-01' GROUP BY ALL")
def _(t):
    loaded = relational.upto_batch(t["fact_sales"], MID)
    return _per_batch(relational.not_in_target(t["fact_sales"], loaded, "order_id"))


@entry("retained_buyers", "SELECT month, customer_id FROM kept")
def _(t):
    return relational.retained_buyers(relational.monthly_buyers(t["fact_sales"])).select("month", "customer_id")


@entry("left_star", f"""
    SELECT n_nationkey, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM nation
    LEFT JOIN (SELECT c_nationkey AS n_nationkey, count(*) AS customers FROM customer GROUP BY 1) USING (n_nationkey)
    LEFT JOIN (SELECT s_nationkey AS n_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) USING (n_nationkey)""")
def _(t):
    parts = [
        relational.count_rows(t.raw("customer"), ["c_nationkey"], "customers").withColumnRenamed("c_nationkey", "n_nationkey"),
        relational.count_rows(t.raw("supplier"), ["s_nationkey"], "suppliers").withColumnRenamed("s_nationkey", "n_nationkey"),
    ]
    joined = relational.left_star(t.raw("nation").select("n_nationkey"), parts, "n_nationkey")
    return joined.select("n_nationkey", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("customers", "suppliers")])


def _month_part(df, day, name):
    months = df.groupBy(calendar.month_start(F.col(day)).alias("m")).agg(F.count(F.lit(1)).alias(name))
    return months.select(calendar.month_key(F.col("m")).alias("month"), name)


_ORDERED = "(SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS ordered FROM orders GROUP BY 1)"
_SHIPPED = "(SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS shipped FROM lineitem GROUP BY 1)"
_SEEN = "(SELECT strftime(ts, '%Y-%m') AS month, count(*) AS seen FROM events GROUP BY 1)"


def _month_parts(t):
    return [_month_part(t.raw("orders"), "o_orderdate", "ordered"), _month_part(t.raw("lineitem"), "l_shipdate", "shipped"),
            _month_part(t.raw("events"), "ts", "seen")]


@entry("join_months", f"SELECT month, ordered, shipped FROM {_ORDERED} JOIN {_SHIPPED} USING (month)")
def _(t):
    return relational.join_months(_month_parts(t)[:2])


@entry("full_join_months", f"SELECT month, ordered, shipped, seen FROM {_ORDERED} FULL JOIN {_SHIPPED} USING (month) FULL JOIN {_SEEN} USING (month)")
def _(t):
    return relational.full_join_months(_month_parts(t))


# === aggregation ===================================================================================


@entry("count_rows", "SELECT l_returnflag, l_linestatus, count(*) AS rows FROM lineitem GROUP BY ALL")
def _(t):
    return relational.count_rows(t.raw("lineitem"), ["l_returnflag", "l_linestatus"])


@entry("multi_distinct", """
    SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
           count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_shipdate) AS days, max(l_tax) AS top_tax FROM lineitem GROUP BY ALL""")
def _(t):
    columns = {"orders": "l_orderkey", "parts": "l_partkey", "suppliers": "l_suppkey", "days": "l_shipdate"}
    return relational.aggregate_distinct(t.raw("lineitem"), {"l_returnflag": F.col("l_returnflag")}, columns, F.max("l_tax").alias("top_tax"))


@entry("count_if_distinct", """
    SELECT month, count(DISTINCT customer_id) FILTER (quantity >= 100) AS big_buyers,
           count(DISTINCT customer_id) FILTER (quantity < 100) AS small_buyers FROM sales GROUP BY ALL""")
def _(t):
    big, who = F.col("quantity") >= 100, F.col("customer_id")
    months = t["fact_sales"].groupBy(calendar.month_start(F.col("order_date")).alias("m")).agg(
        aggregates.count_if_distinct(big, who).alias("big_buyers"),
        aggregates.count_if_distinct(~big, who).alias("small_buyers"))
    return months.select(calendar.month_key(F.col("m")).alias("month"), "big_buyers", "small_buyers")


@entry("sum_avg_min_max", f"""
    SELECT l_suppkey, {n('sum(q)', 'qty')}, {c(half_up('sum(q)', 'count(q)', 100), 'mean_qty')}, {c('min(p)', 'low')}, {c('max(p)', 'high')},
           {c(half_up('sum(p)', 'count(p)'), 'mean_price')}
    FROM (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS q, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS p
          FROM lineitem) GROUP BY ALL""")
def _(t):
    q, p = F.col("l_quantity").cast("bigint"), F.col("l_extendedprice").cast("decimal(12,2)")
    return t.raw("lineitem").groupBy("l_suppkey").agg(
        F.sum(q).alias("qty"), measures.mean(q).alias("mean_qty"), F.min(p).alias("low"), F.max(p).alias("high"),
        measures.mean(p).alias("mean_price"))


@entry("ordered_concat", "SELECT customer_id, string_agg(tier, ' → ' ORDER BY valid_from) AS journey FROM dim_customer GROUP BY ALL")
def _(t):
    return t["dim_customer"].groupBy("customer_id").agg(aggregates.ordered_concat("tier", "valid_from", " → ").alias("journey"))


@entry("distinct_concat", "SELECT customer_id, string_agg(DISTINCT tier, ', ' ORDER BY tier) AS tiers FROM src_customer GROUP BY ALL")
def _(t):
    return t["src_customer"].groupBy("customer_id").agg(aggregates.distinct_concat("tier", ", ").alias("tiers"))


@entry("distinct_pairs", "SELECT DISTINCT month, customer_id FROM sales")
def _(t):
    pairs = t["fact_sales"].select(calendar.month_start(F.col("order_date")).alias("m"), "customer_id")
    return relational.distinct_pairs(pairs, ["m", "customer_id"]).select(
        calendar.month_key(F.col("m")).alias("month"), "customer_id")


@entry("monthly_buyers", "SELECT month, customer_id FROM visits")
def _(t):
    return relational.monthly_buyers(t["fact_sales"])


@entry("first_seen", f"SELECT customer_id, product_id, {d('min(order_date)', 'first_seen')} FROM sales GROUP BY ALL")
def _(t):
    return relational.first_seen(t["fact_sales"], ["customer_id", "product_id"], "order_date")


@entry("monthly_from_daily", f"""
    SELECT month, {n('orders', 'total_orders')}, {n('buyers', 'unique_customers')}, {n('stores', 'active_stores')},
           {n('qty', 'total_qty')}, {c('revenue_c', 'total_revenue')}, {c('aov_c', 'avg_order_value')} FROM day_months""")
def _(t):
    return sales_marts.monthly_from_daily(sales_marts.daily_sales(t["fact_sales"], unique_orders=True))


@entry("first_per_group", f"""
    SELECT DISTINCT ON (customer_id) customer_id, order_id, {c('total_c', 'total_amount')} FROM sales
    ORDER BY customer_id, total_c DESC, order_id""")
def _(t):
    sales = t["fact_sales"].select("customer_id", "order_id", "total_amount")
    return relational.first_per_group(sales, ["customer_id"], [windows.desc("total_amount")], "order_id")


@entry("least_by", f"""
    SELECT DISTINCT ON (store_code) store_code, {d('order_date', 'first_day')}, order_id FROM sales
    ORDER BY store_code, order_date, order_id""")
def _(t):
    order = [F.col("order_date"), F.col("order_id")]
    return relational.least_by(t["fact_sales"], ["store_code"], order, {"first_day": order[0], "order_id": order[1]})


@entry("global_agg", f"SELECT count(*) AS rows, {c('sum(total_c)', 'total')}, {d('max(order_date)', 'last_day')} FROM sales")
def _(t):
    return relational.global_agg(t["fact_sales"], F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("total"),
                                 F.max("order_date").alias("last_day"))


# === windows =======================================================================================


@entry("first_row", "SELECT latitude, longitude, initial_store_code FROM store_names")
def _(t):
    return identity.initial_store(t["src_store"]).select("latitude", "longitude", "initial_store_code")


@entry("version_number", f"""
    SELECT customer_id, {d('valid_from')}, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS version FROM dim_customer""")
def _(t):
    return t["dim_customer"].select("customer_id", "valid_from", windows.version_number(["customer_id"], "valid_from").alias("version"))


@entry("rank_desc", f"SELECT initial_store_code, month, {n('rank() OVER (PARTITION BY month ORDER BY orders DESC)', 'place')} FROM store_perf")
def _(t):
    return t["store_performance"].select("initial_store_code", "month", windows.rank_desc(["month"], "total_orders").alias("place"))


@entry("rank_in_slices", f"""
    SELECT initial_store_code, month, {n('rank() OVER (PARTITION BY month ORDER BY orders DESC)', 'by_orders')},
           {n('rank() OVER (PARTITION BY month ORDER BY revenue_c DESC)', 'by_revenue')} FROM store_perf""")
def _(t):
    months = t["store_performance"].select("initial_store_code", "month", "total_orders", "total_revenue")
    ranked = relational.rank_in_slices(months, "month", {"by_orders": "total_orders", "by_revenue": "total_revenue"}, ["initial_store_code"])
    return ranked.drop("total_orders", "total_revenue")


@entry("prev_row", f"SELECT month, {c('lag(revenue_c) OVER (ORDER BY month)', 'before')} FROM day_months")
def _(t):
    months = sales_marts.monthly_from_daily(sales_marts.daily_sales(t["fact_sales"], unique_orders=True))
    return months.select("month", windows.prev("total_revenue", "month").alias("before"))


@entry("next_or_open", f"""
    SELECT customer_id, {d('valid_from')}, CAST(coalesce(CAST(lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS DATE),
           DATE '9999-12-31') AS VARCHAR) AS until FROM dim_customer""")
def _(t):
    versions = t["dim_customer"].select("customer_id", "valid_from", F.to_date("valid_from").alias("day"))
    return versions.select("customer_id", "valid_from", windows.next_or_open("day", ["customer_id"]).alias("until"))


@entry("running_sum", f"SELECT initial_store_code, month, {n('sum(qty) OVER (PARTITION BY initial_store_code ORDER BY month ROWS UNBOUNDED PRECEDING)', 'running')} FROM store_perf")
def _(t):
    running = windows.running_sum("total_qty_sold", "month", ["initial_store_code"])
    return t["store_performance"].select("initial_store_code", "month", running.alias("running"))


@entry("moving_avg", f"""
    SELECT initial_store_code, month, {c(half_up('sum(revenue_c) OVER w', 'count(revenue_c) OVER w'), 'smooth')} FROM store_perf
    WINDOW w AS (PARTITION BY initial_store_code ORDER BY month ROWS 2 PRECEDING)""")
def _(t):
    smooth = windows.moving_avg("total_revenue", "month", 3, keys=["initial_store_code"])
    return t["store_performance"].select("initial_store_code", "month", smooth.alias("smooth"))


@entry("share_of_total", f"SELECT month, {c(pct('revenue_c', 'sum(revenue_c) OVER ()'), 'share')} FROM day_months")
def _(t):
    months = sales_marts.monthly_from_daily(sales_marts.daily_sales(t["fact_sales"], unique_orders=True))
    return months.select("month", windows.share_of_total("total_revenue").alias("share"))


# === order, top-k, set operations ==================================================================


@entry("sort_months", f"SELECT month, {n('orders', 'total_orders')} FROM revenue_k ORDER BY month")
def _(t):
    return kpis.kpi_revenue(t["fact_sales"], unique_orders=True).select("month", "total_orders").orderBy(windows.asc("month"))


@entry("top_k", f"SELECT order_id, {c('total_c', 'total_amount')} FROM sales ORDER BY total_c DESC, order_id LIMIT 20")
def _(t):
    return relational.top_k(t["fact_sales"].select("order_id", "total_amount"), [windows.desc("total_amount"), F.col("order_id")], 20)


@entry("top_k_sum", f"SELECT month, {c('sum(revenue_c)', 'top3')} FROM store_perf WHERE rk <= 3 GROUP BY ALL")
def _(t):
    return relational.top_k_sum(t["store_performance"], "month", "total_revenue", 3, "top3")


@entry("mixed_sort", f"SELECT month, product_id, {n('revenue_rank')} FROM products ORDER BY month DESC, revenue_rank, product_id")
def _(t):
    return t["sales_by_product"].select("month", "product_id", "revenue_rank").orderBy(
        windows.desc("month"), windows.asc("revenue_rank"), windows.asc("product_id"))


@entry("union_grains", f"SELECT grain, count(*) AS rows, {c('sum(revenue_c)', 'total')} FROM periods GROUP BY ALL")
def _(t):
    daily = sales_marts.daily_sales(t["fact_sales"], unique_orders=True).select(F.lit("daily").alias("grain"), "total_revenue")
    monthly = sales_marts.monthly_from_daily(sales_marts.daily_sales(t["fact_sales"], unique_orders=True)).select(F.lit("monthly").alias("grain"), "total_revenue")
    return relational.union_grains(daily, monthly).groupBy("grain").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_revenue").alias("total"))


_RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@entry("row_counts", " UNION ALL ".join(f"SELECT '{x}' AS \"table\", count(*) AS rows FROM {x}" for x in _RAW_TABLES))
def _(t):
    return relational.row_counts({x: t.raw(x) for x in _RAW_TABLES})


# === store identity, facts, snapshots ==============================================================


@entry("initial_store", "SELECT initial_store_code, latitude, longitude FROM store_names")
def _(t):
    return identity.initial_store(t["src_store"])


@entry("build_code_history", _HISTORY)
def _(t):
    return identity.build_code_history(t["src_store"], LAST_MONTH)


@entry("build_code_history_cutoff", f"SELECT initial_store_code, store_code, {d('start_date')}, {d('end_date')} FROM {_STATE_1998}")
def _(t):
    return _state_1998(t)


@entry("merge_code_history", _HISTORY + " WHERE start_date <= DATE '1999-01-01'")
def _(t):
    return identity.merge_code_history(_state_1998(t), t["src_store"], dt.date(1999, 1, 1), t["store_seen_1998"])


@entry("merge_first_seen", "SELECT initial_store_code, latitude, longitude FROM store_names")
def _(t):
    """State of the batches up to 1998 and, appended to it, what each of two later parts adds; merged by least row."""
    stores, cut = t["src_store"], dt.date(1998, 12, 1)
    late = stores.filter(F.col("partition_time") >= F.lit(dt.date(1999, 1, 1)))
    early = relational.upto_batch(stores, cut).filter("cast(latitude as bigint) % 3 > 0")
    state = identity.first_seen(early)
    for part in (late, relational.upto_batch(stores, cut)):
        state = state.unionByName(identity.first_seen_changes(identity.merge_first_seen(state), part))
    return identity.merge_first_seen(state).select("initial_store_code", "latitude", "longitude")


_CLASH = """
    SELECT latitude, longitude, store_code, day FROM src_store UNION ALL
    SELECT latitude, longitude, 'Q' || latitude AS store_code, day FROM src_store WHERE CAST(latitude AS BIGINT) % 7 = 0 AND month(day) = 1"""


@entry("conflicting_codes", f"SELECT latitude, longitude, count(DISTINCT store_code) AS codes FROM ({_CLASH}) WHERE day = DATE '1999-01-01' GROUP BY ALL HAVING count(DISTINCT store_code) > 1")
def _(t):
    """Every seventh store reports a second code each January."""
    stores = t["src_store"]
    second = stores.filter((F.col("latitude").cast("bigint") % 7 == 0) & (F.month("partition_time") == 1))
    second = second.withColumn("store_code", F.concat(F.lit("q"), F.col("latitude")))
    return identity.conflicting_codes(stores.unionByName(second), dt.date(1999, 1, 1))


_FACT = f"""SELECT order_id, {d('order_date')}, store_code, customer_id, product_id, quantity, {c('price_c', 'unit_price')},
    {c('total_c', 'total_amount')}, {d('partition_time')} FROM sales"""


@entry("build_fact_sales", _FACT + " WHERE partition_time <= DATE '1999-06-01'")
def _(t):
    return facts.build_fact_sales(t["src_sales"], MID)


@entry("new_fact_rows", _FACT + " WHERE partition_time > DATE '1999-06-01'")
def _(t):
    return facts.new_fact_rows(t["src_sales"], relational.upto_batch(t["fact_sales"], MID), LAST_MONTH)


@entry("active_store", _HISTORY + " WHERE end_date = DATE '9999-12-31'")
def _(t):
    return identity.active_store(t["code_history"])


@entry("closed_store", _HISTORY + " WHERE end_date < DATE '2001-08-01'")
def _(t):
    return identity.closed_store(t["code_history"], AS_OF)


_DIM_SALES = f"""SELECT order_id, {d('order_date')}, store_code, customer_id, product_id, {n('quantity')}, {c('price_c', 'unit_price')},
    {c('total_c', 'total_amount')}, {d('load', 'partition_time')}, {d('valid_from')}, {d('valid_to')} FROM dim_sales"""


@entry("snapshot_check", _DIM_SALES)
def _(t):
    """History of the first two loads, then the third load compared with it."""
    loads = t["sales_corrections"]
    before = snapshots.sales_history(relational.upto_batch(loads, CORRECTIONS[1]))
    last = relational.one_batch(loads, CORRECTIONS[2])
    return snapshots.snapshot_sales(before, last, CORRECTIONS[2])


@entry("snapshot_sales", _DIM_SALES)
def _(t):
    """Each load compared with the state before it, together with all older loads and with rows that have no id."""
    loads = t["sales_corrections"]
    nameless = loads.filter("order_id % 100 = 0").withColumn("order_id", F.lit(None).cast("bigint"))
    state = None
    for day in CORRECTIONS:
        state = snapshots.snapshot_sales(state, relational.upto_batch(loads.union(nameless), day), day)
    return state


@entry("snapshot_sales_history", _DIM_SALES)
def _(t):
    return snapshots.sales_history(t["sales_corrections"])


_DIM_CUSTOMER = f"SELECT customer_id, full_name, email, phone, city, province, tier, {d('registered', 'registration_date')}, {d('day', 'partition_date')}, {d('valid_from')}, {d('valid_to')} FROM dim_customer"


@entry("snapshot_customer", _DIM_CUSTOMER)
def _(t):
    before = snapshots.customer_history(relational.upto_batch(t["src_customer"], YEARS[-2]))
    return snapshots.snapshot_customer(before, t["src_customer"], YEARS[-1])


@entry("customer_history", _DIM_CUSTOMER)
def _(t):
    return snapshots.customer_history(t["src_customer"])


_DIM_STORE = f"""SELECT store_code, s_name AS store_description, 'X' AS country, 'area' AS area, 'city' AS city, 'district' AS district,
    lpad(CAST(sk AS VARCHAR), 9, '0') AS zip, CASE WHEN sk % 3 = 0 THEN 'mall' ELSE 'street' END AS channel_type,
    {c('gross_c', 'gross_area')}, {c('net_c', 'net_sales_area')}, 'm2' AS area_unit, CAST(sk AS VARCHAR) AS latitude,
    CAST(nk AS VARCHAR) AS longitude, '1995-01-01' AS opening_date, {d('closing', 'closing_date')}, 'EUR' AS local_currency, format,
    {d('day', 'partition_date')}, {d('valid_from')}, {d('valid_to')} FROM dim_store"""


@entry("snapshot_store", _DIM_STORE)
def _(t):
    before = snapshots.store_history(relational.upto_batch(t["src_store_detail"], YEARS[-3]))
    for day in YEARS[-2:]:
        before = snapshots.snapshot_store(before, t["src_store_detail"], day)
    return before


@entry("store_history", _DIM_STORE)
def _(t):
    return snapshots.store_history(t["src_store_detail"])


@entry("events_customer", _DIM_CUSTOMER)
def _(t):
    """Two loads of customers appended to the events of those before; a batch adds changed keys only."""
    rows = t["src_customer"].withColumnRenamed("partition_time", "partition_date")
    events = snapshots.events_of(snapshots.customer_history(relational.upto_batch(t["src_customer"], YEARS[-3])))
    for day in YEARS[-2:]:
        batch = relational.one_batch(rows, day, "partition_date")
        events = events.unionByName(snapshots.opened_versions(events, batch, "customer_id", CUSTOMER_CHECK_COLUMNS, day))
    return snapshots.versions_of(events, "customer_id")


@entry("events_store", _DIM_STORE)
def _(t):
    rows = t["src_store_detail"].withColumnRenamed("partition_time", "partition_date")
    events = snapshots.events_of(snapshots.store_history(relational.upto_batch(t["src_store_detail"], YEARS[-3])))
    for day in YEARS[-2:]:
        batch = relational.one_batch(rows, day, "partition_date")
        events = events.unionByName(snapshots.opened_versions(events, batch, "store_code", STORE_CHECK_COLUMNS, day))
    return snapshots.versions_of(events, "store_code")


@entry("events_sales", _DIM_SALES)
def _(t):
    """Each load of sales, with all older loads and rows that have no id, compared with the events before it."""
    loads = t["sales_corrections"]
    nameless = loads.filter("order_id % 100 = 0").withColumn("order_id", F.lit(None).cast("bigint"))
    events = snapshots.events_of(snapshots.sales_history(relational.one_batch(loads, CORRECTIONS[0])))
    for day in CORRECTIONS[1:]:
        batch = relational.upto_batch(loads.union(nameless), day)
        events = events.unionByName(snapshots.opened_versions(events, batch, "order_id", SALES_CHECK_COLUMNS, day, "partition_time"))
    return snapshots.versions_of(events, "order_id")


# === marts =========================================================================================


_STORE_PERFORMANCE = f"""
    SELECT initial_store_code, month, {n('orders', 'total_orders')}, {n('buyers', 'unique_customers')}, {n('qty', 'total_qty_sold')},
           {c('revenue_c', 'total_revenue')}, {c('aov_c', 'avg_order_value')}, {n('rk', 'revenue_rank')},
           {c('running_c', 'cumulative_revenue')} FROM store_perf"""


@entry("store_performance", _STORE_PERFORMANCE)
def _(t):
    return store_marts.store_performance(t["fact_sales"], t["code_history"], unique_orders=True)


_STORE_DIRECTORY = f"""
    SELECT initial_store_code, current_code AS current_store_code, status, {d('active_since')}, {n('changes', 'total_code_changes')},
           {c('revenue_c', 'lifetime_revenue')}, {n('orders', 'lifetime_orders')} FROM store_dir"""


@entry("store_directory", _STORE_DIRECTORY)
def _(t):
    return store_marts.store_directory(t["fact_sales"], t["code_history"], unique_orders=True)


@entry("store_code_journey", "SELECT initial_store_code, string_agg(store_code, ' → ' ORDER BY start_date) AS code_journey FROM code_history GROUP BY ALL")
def _(t):
    return store_marts.store_code_journey(t["code_history"])


_SUMMARY = f"""
    SELECT grain, period, month, {n('orders', 'total_orders')}, {n('buyers', 'unique_customers')}, {n('stores', 'active_stores')},
           {n('qty', 'total_qty')}, {c('revenue_c', 'total_revenue')}, {c('aov_c', 'avg_order_value')},
           {c('growth_h', 'revenue_growth_pct')} FROM periods"""


@entry("sales_summary", _SUMMARY)
def _(t):
    return sales_marts.sales_summary(t["fact_sales"], unique_orders=True)


_BY_PRODUCT = f"""
    SELECT product_id, month, {n('orders', 'total_transactions')}, {n('buyers', 'unique_buyers')}, {n('stores', 'sold_in_stores')},
           {n('qty', 'total_qty_sold')}, {c('revenue_c', 'total_revenue')}, {c('price_c', 'avg_unit_price')},
           {c('min_c', 'min_unit_price')}, {c('max_c', 'max_unit_price')}, {n('revenue_rank')}, {n('qty_rank')}"""


@entry("sales_by_product", _BY_PRODUCT + " FROM products")
def _(t):
    return sales_marts.sales_by_product(t["fact_sales"], unique_orders=True)


@entry("price_band", _BY_PRODUCT + """, CASE WHEN products.price_c < 120000 THEN 'Budget' WHEN products.price_c >= 160000 THEN 'Premium' ELSE 'Mid' END
    AS price_band FROM products""")
def _(t):
    return sales_marts.price_band(sales_marts.sales_by_product(t["fact_sales"], unique_orders=True), 1200, 1600)


_BY_CUSTOMER = f"""
    SELECT customer_id, {n('orders', 'total_orders')}, {n('stores', 'stores_visited')}, {n('products', 'unique_products_bought')},
           {n('qty', 'total_qty')}, {c('spend_c', 'total_spend')}, {c('aov_c', 'avg_order_value')},
           {d('first_day', 'first_purchase_date')}, {d('last_day', 'last_purchase_date')},
           {n('last_day - first_day', 'customer_lifespan_days')}, {n('idle', 'days_since_last_purchase')},
           favorite AS favorite_product_id, {n('r', 'recency_score')}, {n('f', 'frequency_score')}, {n('m', 'monetary_score')},
           segment AS customer_segment"""


@entry("sales_by_customer", _BY_CUSTOMER + " FROM rated")
def _(t):
    return customer_marts.sales_by_customer(t["fact_sales"], AS_OF, unique_orders=True)


def _customer_state(t):
    """Parts of the sales up to June 1999 and of those after, which hold other orders."""
    fact = t["fact_sales"]
    loads = (relational.upto_batch(fact, MID), fact.filter(F.col("partition_time") > F.lit(MID)))
    parts = [store(customer_marts.customer_parts(load, unique_orders=unique), "parts") for load, unique in zip(loads, (True, False))]
    return customer_marts.merge_customer_parts(parts[0].unionByName(parts[1]))


@entry("customers_from_parts", _BY_CUSTOMER + " FROM rated")
def _(t):
    return customer_marts.customer_value(_customer_state(t), AS_OF)


@entry("sales_by_customer_scaled", _BY_CUSTOMER + " FROM rated_scaled")
def _(t):
    return customer_marts.sales_by_customer(t["fact_sales"], AS_OF, SCALED_RFM, unique_orders=True)


@entry("rfm_scores", f"SELECT customer_id, {n('r', 'recency_score')}, {n('f', 'frequency_score')}, {n('m', 'monetary_score')} FROM rated_scaled")
def _(t):
    scored = customer_marts.rfm_scores(t["sales_by_customer"].drop(*customer_marts.RATING_COLUMNS), SCALED_RFM)
    return scored.select("customer_id", "recency_score", "frequency_score", "monetary_score")


@entry("rfm_segment", "SELECT customer_id, segment AS customer_segment FROM rated_scaled")
def _(t):
    base = t["sales_by_customer"].drop(*customer_marts.RATING_COLUMNS)
    return customer_marts.rfm_segment(customer_marts.rfm_scores(base, SCALED_RFM)).select("customer_id", "customer_segment")


@entry("favorite_product", "SELECT customer_id, favorite AS favorite_product_id FROM favorites")
def _(t):
    return customer_marts.favorite_product(t["fact_sales"])


_PROFILE = f"""
    SELECT customer_id, {_TITLE.format('full_name')} AS full_name, lower(trim(email)) AS email, phone,
           {_TITLE.format('city')} AS city, {_TITLE.format('province')} AS province, {d('registered', 'registration_date')},
           {n("DATE '2001-08-01' - registered", 'days_as_customer')}, tier AS current_tier, {d('valid_from', 'tier_since')},
           {n('changes', 'total_tier_upgrades')}, journey AS tier_journey, {n('orders', 'lifetime_orders')},
           {c('spend_c', 'lifetime_spend')}, {d('first_day', 'first_purchase_date')}, {d('last_day', 'last_purchase_date')},
           {n("DATE '2001-08-01' - last_day", 'days_since_last_purchase')} FROM profiles"""


@entry("profile_from_parts", _PROFILE)
def _(t):
    return customer_marts.profile_with_sales(t["dim_customer"], customer_marts.lifetime_of_parts(_customer_state(t)), AS_OF)


@entry("customer_profile", _PROFILE)
def _(t):
    return customer_marts.customer_profile(t["dim_customer"], t["fact_sales"], AS_OF, unique_orders=True)


# === KPIs ==========================================================================================

_REVENUE = [
    n("r.orders", "total_orders"), n("r.buyers", "unique_buyers"), c("r.revenue_c", "total_revenue"), n("r.qty", "total_qty_sold"),
    c("r.prev_c", "prev_month_revenue"), c("r.growth_h", "revenue_mom_growth_pct"), c("r.rolling_c", "revenue_3m_rolling_avg"),
    c("r.running_c", "cumulative_revenue"), c("r.share_h", "revenue_share_pct"),
]
_ORDERS = [
    n("o.orders", "total_orders"), n("o.buyers", "unique_buyers"), n("o.stores", "active_stores"), n("o.products", "distinct_products"),
    n("o.qty", "total_qty_sold"), c("o.revenue_c", "total_revenue"), c("o.aov_c", "avg_order_value"), c("o.items_h", "avg_items_per_order"),
    n("o.prev_orders", "prev_month_orders"), c("o.orders_growth_h", "orders_mom_growth_pct"), c("o.prev_aov_c", "prev_month_aov"),
    c("o.aov_growth_h", "aov_mom_change_pct"), c("o.per_store_c", "avg_revenue_per_store"), c("o.per_buyer_h", "avg_orders_per_buyer"),
]
_RETENTION = [
    n("k.buyers", "total_buyers"), n("k.fresh", "new_customers"), n("k.back", "returning_customers"),
    n("k.retained", "retained_from_prev_month"), n("k.prev_buyers", "prev_month_buyers"), c("k.retention_h", "retention_rate_pct"),
    c("k.churn_h", "churn_rate_pct"), c("k.fresh_h", "new_customer_pct"), c("k.growth_h", "buyers_mom_growth_pct"),
]
_STORE = [
    n("s.stores", "active_store_count"), c("s.revenue_c", "total_market_revenue"), n("s.orders", "market_total_orders"),
    n("s.buyers", "market_unique_customers"), c("s.mean_c", "avg_revenue_per_store"), c("s.min_c", "min_store_revenue"),
    c("s.max_c", "max_store_revenue"), "s.top AS top_store_code", c("s.top_c", "top_store_revenue"), n("s.top_orders", "top_store_orders"),
    n("s.top_buyers", "top_store_unique_customers"), c("s.top_h", "top_store_revenue_share_pct"), "s.low AS bottom_store_code",
    c("s.low_c", "bottom_store_revenue"), c("(s.top_c - s.low_c)", "revenue_gap_top_bottom"), c("s.top3_c", "top3_revenue"),
    c("s.top3_h", "top3_concentration_pct"), c("s.prev_c", "prev_month_market_revenue"), c("s.growth_h", "market_revenue_mom_growth_pct"),
]
_PRODUCT = [
    n("p.products", "distinct_products_sold"), c("p.revenue_c", "total_product_revenue"), n("p.qty", "total_qty_sold"),
    n("p.orders", "total_transactions"), c("p.mean_c", "avg_revenue_per_product"), "p.top AS top_product_by_revenue",
    c("p.top_c", "top_product_revenue"), n("p.top_qty", "top_product_qty_sold"), n("p.top_buyers", "top_product_unique_buyers"),
    n("p.top_stores", "top_product_sold_in_stores"), c("p.top_h", "top_product_revenue_share_pct"), "p.most AS top_product_by_qty",
    n("p.most_qty", "top_product_qty"), "CAST(p.diversity_tt AS DOUBLE) / 1e4 AS product_diversity_index",
    n("p.prev_products", "prev_month_product_count"), n("p.products - coalesce(p.prev_products, 0)", "product_count_mom_change"),
    c("p.prev_c", "prev_month_product_revenue"), c("p.growth_h", "product_revenue_mom_growth_pct"),
]


def _name(item: str) -> str:
    return item.rsplit(" AS ", 1)[1]


def _pick(items: list[str], names: list[str]) -> list[str]:
    by_name = {_name(i): i for i in items}
    return [by_name[x] for x in names]


_STORE_IN_EXEC = [i.replace(" AS avg_revenue_per_store", " AS store_avg_revenue") for i in _STORE]
_KPI_SQL = {
    "kpi_revenue": (_REVENUE, "revenue_k r"), "kpi_orders": (_ORDERS, "orders_k o"),
    "kpi_customer_retention": (_RETENTION, "retention_k k"), "kpi_store": (_STORE, "store_k s"), "kpi_product": (_PRODUCT, "product_k p"),
    "kpi_exec_summary": (
        [i for items, names in zip((_REVENUE, _ORDERS, _RETENTION, _STORE_IN_EXEC, _PRODUCT), kpis.EXEC_COLUMNS.values(), strict=True)
         for i in _pick(items, names)],
        "revenue_k r FULL JOIN orders_k o USING (month) FULL JOIN retention_k k USING (month) FULL JOIN store_k s USING (month)"
        " FULL JOIN product_k p USING (month)",
    ),
}


def _kpi_sql(name: str, columns: list[str] | None = None) -> str:
    items, source = _KPI_SQL[name]
    picked = items if columns is None else _pick(items, columns)
    return f"SELECT month, {', '.join(picked)} FROM {source}"


@entry("kpi_revenue", _kpi_sql("kpi_revenue"))
def _(t):
    return kpis.kpi_revenue(t["fact_sales"], unique_orders=True)


@entry("kpi_orders", _kpi_sql("kpi_orders"))
def _(t):
    return kpis.kpi_orders(t["fact_sales"], unique_orders=True)


@entry("kpi_customer_retention", _kpi_sql("kpi_customer_retention"))
def _(t):
    return kpis.kpi_customer_retention(t["fact_sales"])


@entry("retention_from_parts", _kpi_sql("kpi_customer_retention"))
def _(t):
    """Months of buyers stored for the sales up to June 1999, and one part for each of two later loads, some of it again."""
    fact = t["fact_sales"]
    cuts = [relational.upto_batch(fact, MID), fact.filter("order_id % 2 = 0"), fact.filter(F.col("partition_time") > F.lit(MID))]
    parts = [store(mergeable.buyer_months(part), "buyer_months") for part in cuts]
    return kpis.retention_of_months(mergeable.retention_months(mergeable.merge_buyer_months(*parts)))


_COUNTED = """
    SELECT 'month' AS grain, strftime(order_date, '%Y-%m') AS "key", count(DISTINCT customer_id) AS buyers FROM sales GROUP BY ALL
    UNION ALL SELECT 'day', CAST(order_date AS VARCHAR), count(DISTINCT customer_id) FROM sales GROUP BY ALL
    UNION ALL SELECT 'store', store_code, count(DISTINCT customer_id) FROM sales GROUP BY ALL
    UNION ALL SELECT 'store month', store_code || ' ' || strftime(order_date, '%Y-%m'), count(DISTINCT customer_id) FROM sales GROUP BY ALL
    UNION ALL SELECT 'all', 'all', count(DISTINCT customer_id) FROM sales"""


@entry("buyers_from_parts", _COUNTED)
def _(t):
    """Buyers of days, months, stores and all, or-ed from sets per day and store that two loads have stored."""
    fact, parts, numbers = t["fact_sales"], [], None
    for load in (relational.upto_batch(fact, MID), fact.filter(F.col("partition_time") > F.lit(MID))):
        fresh = mergeable.number_values(numbers, load, "customer_id", "store_code")
        numbers = fresh if numbers is None else numbers.unionByName(fresh)
        parts.append(store(mergeable.set_parts(load, ["order_date", "store_code"], "customer_id", numbers), "buyers"))
    month = calendar.month_key(F.col("order_date"))
    daily = parts[0].unionByName(parts[1]).withColumn("month", month)
    keys = {
        "month": F.col("month"), "day": F.col("order_date").cast("string"), "store": F.col("store_code"),
        "store month": F.concat_ws(" ", "store_code", "month"), "all": F.lit("all"),
    }
    counted = [mergeable.count_sets(daily.withColumn("key", key), ["key"], "buyers").select(F.lit(g).alias("grain"), "key", "buyers") for g, key in keys.items()]
    return reduce(DataFrame.unionByName, counted)


@entry("kpi_store", _kpi_sql("kpi_store"))
def _(t):
    return kpis.kpi_store(store_marts.store_performance(t["fact_sales"], t["code_history"], unique_orders=True))


@entry("kpi_product", _kpi_sql("kpi_product"))
def _(t):
    return kpis.kpi_product(sales_marts.product_months(t["fact_sales"], unique_orders=True))


@entry("kpi_exec_summary", _kpi_sql("kpi_exec_summary"))
def _(t):
    fact = t["fact_sales"]
    months = store(kpis.month_base(fact, unique_orders=True), "months")
    return kpis.kpi_exec_summary(
        kpis.revenue_of_months(months), kpis.orders_of_months(months), kpis.kpi_customer_retention(fact),
        kpis.kpi_store(store_marts.store_performance(fact, t["code_history"], unique_orders=True)),
        kpis.kpi_product(sales_marts.product_months(fact, unique_orders=True)))


# The same KPIs over order lines, where order ids repeat.


@entry("kpi_revenue_lines", _kpi_sql("kpi_revenue"), "sales_lines")
def _(t):
    return kpis.kpi_revenue(t["sales_lines"])


@entry("kpi_orders_lines", _kpi_sql("kpi_orders"), "sales_lines")
def _(t):
    return kpis.kpi_orders(t["sales_lines"])


@entry("kpi_customer_retention_lines", _kpi_sql("kpi_customer_retention"), "sales_lines")
def _(t):
    return kpis.kpi_customer_retention(t["sales_lines"])


@entry("store_performance_lines", _STORE_PERFORMANCE, "sales_lines")
def _(t):
    return store_marts.store_performance(t["sales_lines"], t["code_history"])


@entry("store_directory_lines", _STORE_DIRECTORY, "sales_lines")
def _(t):
    return store_marts.store_directory(t["sales_lines"], t["code_history"])


@entry("sales_by_product_lines", _BY_PRODUCT + " FROM products", "sales_lines")
def _(t):
    return sales_marts.sales_by_product(t["sales_lines"])


@entry("sales_by_customer_lines", _BY_CUSTOMER + " FROM rated", "sales_lines")
def _(t):
    return customer_marts.sales_by_customer(t["sales_lines"], AS_OF)


@entry("sales_summary_lines", _SUMMARY, "sales_lines")
def _(t):
    return sales_marts.sales_summary(t["sales_lines"])


# === full build and one batch on a warehouse folder ================================================


def _warehouse_sources(t, sales="src_sales_files", *others):
    """Sales as files, one directory per batch; the warehouse tells changed batches by their files."""
    return {"src_sales": t[sales]} | {name: t[name] for name in ("src_store", *others)}


@entry("warehouse_full_then_batch", _kpi_sql("kpi_exec_summary"))
def _(t):
    """All batches but the last are built at once, the last one is added; the result is that of all."""
    sources = _warehouse_sources(t, "src_sales_files", "src_customer", "src_store_detail")
    warehouse = RetailWarehouse(t.spark, fresh_path(t.spark))
    warehouse.full(sources, dt.date(2001, 7, 1), AS_OF, with_marts=False)
    warehouse.batch(sources, LAST_MONTH, AS_OF)
    return warehouse.table("kpi_exec_summary")


_REBUILT = f"""
    SELECT 'code_history' AS "table", initial_store_code || ' ' || store_code AS "key", {d('start_date', 'since')}, {d('end_date', 'until')}, NULL AS detail
    FROM {_STATE_1998}
    UNION ALL
    SELECT 'dim_customer', customer_id, {d('CAST(valid_from AS DATE)', 'since')},
           CASE WHEN valid_to < TIMESTAMP '1998-12-02' THEN CAST(CAST(valid_to AS DATE) AS VARCHAR) END, tier
    FROM dim_customer WHERE valid_from < TIMESTAMP '1998-12-02'
    UNION ALL
    SELECT 'dim_sales', CAST(order_id AS VARCHAR), {d('partition_time', 'since')}, NULL, store_code FROM sales WHERE partition_time <= DATE '1998-12-01'
    UNION ALL
    SELECT 'kpi_exec_summary', strftime(order_date, '%Y-%m'), NULL, NULL, CAST(count(DISTINCT order_id) AS VARCHAR)
    FROM sales WHERE partition_time <= DATE '1998-12-01' GROUP BY ALL"""


@entry("warehouse_rebuild", _REBUILT)
def _(t):
    """Built up to December, January added; as of December nothing of January is seen."""
    sources = _warehouse_sources(t, "src_sales_files", "src_customer")
    warehouse = RetailWarehouse(t.spark, fresh_path(t.spark))
    before, after = dt.date(1998, 12, 1), dt.date(1999, 1, 1)
    warehouse.full(sources, before, AS_OF)
    warehouse.batch(sources, after, AS_OF, with_marts=False)
    text, day = lambda c: F.col(c).cast("string"), lambda c: F.col(c).cast("date").cast("string")
    none = F.lit(None).cast("string")

    def rows(name, key, since=none, until=none, detail=none):
        return warehouse.table(name, before).select(
            F.lit(name).alias("table"), key.alias("key"), since.alias("since"), until.alias("until"), detail.alias("detail"))

    return reduce(DataFrame.unionByName, [
        rows("code_history", F.concat_ws(" ", "initial_store_code", "store_code"), day("start_date"), day("end_date")),
        rows("dim_customer", F.col("customer_id"), day("valid_from"), day("valid_to"), F.col("tier")),
        rows("dim_sales", text("order_id"), day("valid_from"), day("valid_to"), F.trim(F.upper("store_code"))),
        rows("kpi_exec_summary", F.col("month"), detail=text("total_orders")),
    ])


@entry("warehouse_dim_sales", _DIM_SALES)
def _(t):
    """Three batches that bring late orders and corrections, on a warehouse folder."""
    sources = _warehouse_sources(t, "sales_corrections_files")
    warehouse = RetailWarehouse(t.spark, fresh_path(t.spark))
    warehouse.full(sources, CORRECTIONS[0], AS_OF, with_marts=False)
    for day in CORRECTIONS[1:]:
        warehouse.batch(sources, day, AS_OF, with_marts=False)
    return warehouse.table("dim_sales")


@entry("sales_arrivals", _BATCHES + " GROUP BY ALL")
def _(t):
    """Sales that arrive as files in three loads, with orders that come again, appended by a stream to a started fact."""
    source, fact, state = (fresh_path(t.spark, name) for name in ("arriving", "fact", "checkpoint"))
    sales = t["src_sales"].select(*[F.col(f.name).cast(f.dataType) for f in SRC_SALES])
    arrivals.start_fact(relational.upto_batch(sales, dt.date(1997, 6, 1)), fact)
    for cut in (dt.date(1998, 1, 1), MID, LAST_MONTH):
        again = sales.filter("order_id % 10 = 0")
        arriving = relational.upto_batch(sales, cut).filter(F.col("partition_time") > F.lit(dt.date(1997, 3, 1)))
        sinks.write_table(arriving.unionByName(again), source, mode="append")
        arrivals.append_arrivals(t.spark, source, fact, state).awaitTermination()
    return _per_batch(arrivals.read_fact(t.spark, fact))


# === reports =======================================================================================


def _report(name: str, sql: str) -> None:
    entry(f"report_{name}", sql)(lambda t: reports.report(name, t))


def _report_columns(name: str, table: str, columns: str) -> None:
    _report(name, _kpi_sql(table, columns.split()))


def _report_one(name: str, expr: str, source: str) -> None:
    _report(name, f"SELECT {expr} FROM {source}")


def _avg(col: str, name: str) -> str:
    return c(half_up(f"sum({col})", f"count({col})"), name)


_report_one("exec_total_revenue", c("sum(revenue_c)", "total_revenue"), "revenue_k")
_report_one("exec_total_orders", n("sum(orders)", "total_orders"), "orders_k")
_report_one("exec_sum_monthly_buyers", n("sum(buyers)", "sum_monthly_buyers"), "orders_k")
_report_one("exec_avg_order_value", _avg("aov_c", "avg_order_value"), "orders_k")
_report_one("exec_avg_retention", _avg("retention_h", "avg_retention_rate_pct"), "retention_k")
_report_one("exec_avg_retention_exact", f"CAST({half_up('sum(retention_h)', 'count(retention_h)', 10000)} AS DOUBLE) / 1e6 AS avg_retention_rate", "retention_k")
_report_columns("exec_revenue_trend", "kpi_exec_summary", "total_revenue revenue_3m_rolling_avg")
_report_columns("exec_new_vs_returning", "kpi_exec_summary", "new_customers returning_customers")
_report_columns("exec_revenue_share", "kpi_exec_summary", "total_revenue revenue_share_pct")
_report_columns("exec_retention_vs_churn", "kpi_exec_summary", "retention_rate_pct churn_rate_pct")
_report_columns("exec_growth", "kpi_exec_summary", "revenue_mom_growth_pct orders_mom_growth_pct")
_report_columns(
    "exec_table", "kpi_exec_summary",
    "total_revenue revenue_mom_growth_pct revenue_3m_rolling_avg cumulative_revenue total_orders avg_order_value unique_buyers"
    " active_store_count distinct_products_sold new_customers returning_customers retention_rate_pct churn_rate_pct top_store_code"
    " top3_concentration_pct top_product_by_revenue product_diversity_index",
)
_report("exec_all_months", _kpi_sql("kpi_exec_summary"))
_report_one("revenue_total", c("sum(revenue_c)", "total_revenue"), "revenue_k")
_report_one("revenue_cumulative", c("max(running_c)", "cumulative_revenue"), "revenue_k")
_report_one("orders_avg_value", _avg("aov_c", "avg_order_value"), "orders_k")
_report_one("orders_avg_items", _avg("items_h", "avg_items_per_order"), "orders_k")
_report_columns(
    "revenue_trend_detail", "kpi_revenue", "total_revenue revenue_3m_rolling_avg prev_month_revenue revenue_mom_growth_pct"
)
_report_columns("orders_volume", "kpi_orders", "total_orders orders_mom_growth_pct")
_report_columns("order_value_vs_items", "kpi_orders", "avg_order_value avg_items_per_order aov_mom_change_pct")
_report("product_detail", f"""
    SELECT product_id, month, {c('revenue_c', 'total_revenue')}, {n('qty', 'total_qty_sold')}, {n('buyers', 'unique_buyers')},
           {c('price_c', 'avg_unit_price')}, {n('revenue_rank')}, {n('qty_rank')} FROM products""")
_PRODUCT_TOTALS = f"""
    SELECT product_id, {c('sum(revenue_c)', 'total_revenue_all_time')}, {n('sum(qty)', 'total_qty_all_time')} FROM products GROUP BY ALL"""
_report("top_products_by_revenue", _PRODUCT_TOTALS + " ORDER BY sum(revenue_c) DESC, product_id LIMIT 10")
_report("top_products_by_quantity", _PRODUCT_TOTALS + " ORDER BY sum(qty) DESC, product_id LIMIT 10")
_report_one("buyers_total", n("sum(buyers)", "total_buyers"), "retention_k")
_report_one("new_customers_total", n("sum(fresh)", "total_new_customers"), "retention_k")
_report_one("avg_retention_rate", _avg("retention_h", "avg_retention_rate_pct"), "retention_k")
_report_one("avg_churn_rate", _avg("churn_h", "avg_churn_rate_pct"), "retention_k")
_report_one("avg_new_customer_pct", _avg("fresh_h", "avg_new_customer_pct"), "retention_k")
_report_columns(
    "customer_breakdown", "kpi_customer_retention", "new_customers returning_customers retained_from_prev_month total_buyers"
)
_report_columns("retention_trend", "kpi_customer_retention", "retention_rate_pct prev_month_buyers")
_report_columns("buyers_growth", "kpi_customer_retention", "total_buyers buyers_mom_growth_pct")
_report("segment_distribution", "SELECT segment AS customer_segment, count(*) AS customer_count FROM rated GROUP BY ALL")
_report("segment_averages", f"""
    SELECT segment AS customer_segment, count(*) AS customer_count, CAST({half_up('sum(spend_c)', '(100 * count(*))')} AS DOUBLE) AS avg_spend,
           {c(half_up('sum(orders)', 'count(*)', 100), 'avg_orders')} FROM rated GROUP BY ALL""")
_report("top_customers", f"""
    SELECT customer_id, {c('spend_c', 'total_spend')}, {n('orders', 'total_orders')}, {c('aov_c', 'avg_order_value')},
           segment AS customer_segment, {n('idle', 'days_since_last_purchase')}, {n('r', 'recency_score')}, {n('m', 'monetary_score')}
    FROM rated ORDER BY spend_c DESC, customer_id LIMIT 20""")
_report_one("max_active_stores", n("max(stores)", "active_stores"), "store_k")
_report("latest_top_store", "SELECT top AS top_store_code FROM store_k ORDER BY month DESC LIMIT 1")
_report_one("avg_top3_concentration", _avg("top3_h", "avg_top3_concentration"), "store_k")
_report_one("max_distinct_products", n("max(products)", "distinct_products"), "product_k")
_report_one("avg_diversity_index", f"CAST({half_up('sum(diversity_tt)', 'count(diversity_tt)')} AS DOUBLE) / 1e4 AS avg_diversity_index", "product_k")
_report("store_revenue_totals", f"""
    SELECT initial_store_code, {c('sum(revenue_c)', 'total_revenue_all_time')}, {n('sum(orders)', 'total_orders_all_time')},
           count(DISTINCT month) AS months_active FROM store_perf GROUP BY ALL""")
_report_columns("network_growth", "kpi_store", "total_market_revenue market_revenue_mom_growth_pct avg_revenue_per_store")
_report("product_revenue_share", f"""
    SELECT product_id, {c('part', 'total_revenue')}, {c(pct('part', 'sum(part) OVER ()'), 'revenue_share_pct')}
    FROM (SELECT product_id, sum(revenue_c) AS part FROM products GROUP BY ALL)""")
_report_columns(
    "diversity_trend", "kpi_product",
    "product_diversity_index distinct_products_sold top_product_by_revenue top_product_revenue_share_pct",
)
_report("store_month_table", f"""
    SELECT initial_store_code, month, {c('revenue_c', 'total_revenue')}, {n('orders', 'total_orders')}, {n('buyers', 'unique_customers')},
           {c('aov_c', 'avg_order_value')}, {n('rk', 'revenue_rank')}, {c('running_c', 'cumulative_revenue')} FROM store_perf""")
_report("sales_batch_profile", f"SELECT {d('partition_time', 'batch')}, count(*) AS row_count, {c('sum(total_c)', 'revenue_raw')} FROM sales GROUP BY ALL")
_report("fact_month_profile", f"""
    SELECT month, count(*) AS orders, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_buyers,
           {c('sum(total_c)', 'revenue')}, {c(half_up('sum(total_c)', 'count(*)'), 'avg_order_value')} FROM sales GROUP BY ALL""")
_report("buyer_list", "SELECT month, count(*) OVER (PARTITION BY month) AS total_buyers, customer_id FROM visits")
_report("retained_list", f"""
    SELECT kept.month, {n('buyers', 'total_buyers')}, {n('retained', 'retained_count')}, kept.customer_id
    FROM kept JOIN retention_k ON kept.month = retention_k.month""")
_report("raw_code_store_months", f"""
    SELECT store_code, month, count(*) AS orders, count(DISTINCT customer_id) AS unique_customers, {c('sum(total_c)', 'revenue')}
    FROM sales GROUP BY ALL""")
_LAYERS = {
    "src_sales": "sales", "fact_sales": "sales", "kpi_exec_summary": "revenue_k", "kpi_revenue": "revenue_k", "kpi_orders": "orders_k",
    "kpi_customer_retention": "retention_k", "kpi_store": "store_k", "kpi_product": "product_k", "store_performance": "store_perf",
    "store_directory": "store_dir", "sales_summary": "periods", "sales_by_product": "products", "sales_by_customer": "rated",
}
_report("layer_row_counts", " UNION ALL ".join(f"SELECT '{k}' AS \"table\", count(*) AS rows FROM {v}" for k, v in _LAYERS.items()))
_report("src_sales_batch_rows", f"SELECT {d('partition_time', 'batch')}, count(*) AS rows FROM sales GROUP BY ALL")
_report("src_store_batch_rows", f"SELECT {d('day', 'batch')}, count(*) AS rows FROM src_store GROUP BY ALL")
_report("src_customer_batch_rows", f"SELECT {d('day', 'batch')}, count(*) AS rows FROM src_customer GROUP BY ALL")
_report("fact_date_range", f"SELECT count(*) AS total_rows, {d('min(order_date)', 'first_date')}, {d('max(order_date)', 'last_date')} FROM sales")
_report("code_history_listing", _HISTORY)
_report_columns("kpi_revenue_shares", "kpi_revenue", "total_revenue cumulative_revenue revenue_share_pct")
_report_columns(
    "kpi_retention_rates", "kpi_customer_retention", "retained_from_prev_month prev_month_buyers retention_rate_pct churn_rate_pct"
)
_report_columns(
    "kpi_retention_audit", "kpi_customer_retention",
    "total_buyers new_customers retained_from_prev_month prev_month_buyers retention_rate_pct churn_rate_pct",
)


# === data quality ==================================================================================


@entry("check_not_null", "SELECT initial_store_code, month FROM store_perf WHERE initial_store_code IS NULL OR month IS NULL")
def _(t):
    """Months with sales that fit no store version."""
    return quality.check_not_null(t["store_performance"], ["initial_store_code", "month"]).select("initial_store_code", "month")


@entry("check_unique", "SELECT l_orderkey, count(*) AS cnt FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(t):
    return quality.check_unique(t.raw("lineitem"), ["l_orderkey"])


@entry("check_accepted", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def _(t):
    return quality.check_accepted(t.raw("orders"), "o_orderstatus", ("F", "O")).select("o_orderkey", "o_orderstatus")


@entry("check_positive_amount", "SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM customer WHERE c_acctbal <= 0")
def _(t):
    amounts = t.raw("customer").select("c_custkey", F.col("c_acctbal").cast("decimal(12,2)").alias("amount"))
    return quality.check_positive(amounts, "amount")


@entry("check_positive_quantity", f"SELECT order_id, {n('quantity')} FROM sales WHERE quantity - 20 <= 0")
def _(t):
    return quality.check_positive(t["fact_sales"].select("order_id", (F.col("quantity") - 20).alias("left")), "left").select(
        "order_id", (F.col("left") + 20).alias("quantity"))


@entry("check_total", f"""
    SELECT order_id, {c('total_c', 'total_amount')}, {c('quantity * price_c', 'expected_amount')}, {c('abs(total_c - quantity * price_c)', 'diff')}
    FROM sales WHERE abs(total_c - quantity * price_c) > 100""")
def _(t):
    return quality.check_total(t["fact_sales"], "total_amount", "quantity", "unit_price").select(
        "order_id", "total_amount", "expected_amount", "diff")


@entry("check_rfm_score", f"SELECT customer_id, {n('r + f', 'recency_score')} FROM rated_scaled WHERE r + f NOT IN (1, 2, 3)")
def _(t):
    scored = customer_marts.rfm_scores(t["sales_by_customer"].drop(*customer_marts.RATING_COLUMNS), SCALED_RFM)
    doubled = scored.select("customer_id", (F.col("recency_score") + F.col("frequency_score")).alias("recency_score"))
    return quality.check_accepted(doubled, "recency_score", (1, 2, 3))


@entry("check_store_status", "SELECT initial_store_code, upper(status) AS status FROM store_dir WHERE upper(status) NOT IN ('active', 'closed')")
def _(t):
    shouted = t["store_directory"].select("initial_store_code", F.upper("status").alias("status"))
    return quality.check_accepted(shouted, "status", ("active", "closed"))


@entry("check_tier", "SELECT customer_id, lower(tier) AS tier FROM dim_customer WHERE lower(tier) NOT IN ('Bronze', 'Silver', 'Gold')")
def _(t):
    return quality.check_accepted(t["dim_customer"].select("customer_id", F.lower("tier").alias("tier")), "tier", TIERS)


@entry("check_one_active", "SELECT initial_store_code, count(*) AS cnt FROM code_starts GROUP BY ALL HAVING count(*) > 1")
def _(t):
    """History whose versions were never closed."""
    return quality.check_one_active(t["code_history"].withColumn("end_date", F.lit(dt.date(9999, 12, 31))))


@entry("check_one_profile", "SELECT customer_id, count(*) AS cnt FROM dim_customer GROUP BY ALL HAVING count(*) > 1")
def _(t):
    return quality.check_unique(t["dim_customer"], ["customer_id"])


@entry("check_date_range", f"SELECT initial_store_code, store_code, {d('end_date', 'start_date')}, {d('start_date', 'end_date')} FROM code_history WHERE start_date < end_date")
def _(t):
    """History with its dates exchanged."""
    swapped = t["code_history"].select("initial_store_code", "store_code", F.col("end_date").alias("start_date"), F.col("start_date").alias("end_date"))
    return quality.check_date_range(swapped)


@entry("check_sales_resolve", f"SELECT order_id, store_code, {d('order_date')} FROM placed WHERE initial_store_code IS NULL")
def _(t):
    return quality.check_sales_resolve(t["fact_sales"], t["code_history"])


@entry("check_segments", "SELECT customer_id, nullif(upper(segment), 'LOYAL') AS customer_segment FROM rated")
def _(t):
    shouted = t["sales_by_customer"].select("customer_id", F.nullif(F.upper("customer_segment"), F.lit("LOYAL")).alias("customer_segment"))
    return quality.check_segments(shouted)


_SEEN = (dt.date(2001, 8, 5), dt.date(2001, 8, 8), dt.date(2001, 8, 9), dt.date(2001, 8, 15), dt.date(2001, 8, 16))


@entry("freshness", " UNION ALL ".join(f"""
    SELECT CAST(max(partition_time) AS VARCHAR) AS latest, CAST(DATE '{day}' - max(partition_time) AS BIGINT) AS age_days,
           CASE WHEN DATE '{day}' - max(partition_time) > 14 THEN 'error' WHEN DATE '{day}' - max(partition_time) > 7 THEN 'warn' ELSE 'pass' END AS status
    FROM sales""" for day in _SEEN) + " UNION ALL SELECT NULL, NULL, 'error'")
def _(t):
    """Seen on five days, either side of both limits, and without any batch."""
    seen = [quality.freshness(t["fact_sales"], "partition_time", day) for day in _SEEN]
    return reduce(DataFrame.unionByName, [*seen, quality.freshness(t["fact_sales"].filter("false"), "partition_time", _SEEN[0])])


_CHECKED = {
    "fact_sales": with_tables(_FACT), "code_history": with_tables(_HISTORY), "active_store": SQL["active_store"],
    "closed_store": SQL["closed_store"],
}


def _outcome_sql(check: str, table: str, column: str | None, violations: str) -> str:
    col = "NULL" if column is None else f"'{column}'"
    return f"{{'check': '{check}', 'table': '{table}', 'column': {col}, 'violations': {violations}}}"


def _checks_sql() -> str:
    """Every declared rule counted over the SQL form of its table."""
    selects = []
    for table, r in quality.RULES.items():
        source = _CHECKED.get(table) or SQL[table]
        bad = {("not_null", x): f"{x} IS NULL" for x in r.not_null}
        bad |= {("positive", x): f"{x} <= 0" for x in r.positive}
        bad |= {("accepted_values", x): f"{x} NOT IN ({', '.join(map(repr, v))})" for x, v in r.accepted.items()}
        if r.total:
            whole, qty, price = r.total
            bad["total_consistent", whole] = f"abs(round({whole} * 100) - {qty} * round({price} * 100)) > 100"
        found = [_outcome_sql(kind, table, x, f"count(*) FILTER ({cond})") for (kind, x), cond in bad.items()]
        found += [_outcome_sql("unique", table, x, f"count(*) FILTER ({x}_n > 1 AND {x}_i = 1)") for x in r.unique]
        numbered = "".join(
            f", count({x}) OVER (PARTITION BY {x}) AS {x}_n, row_number() OVER (PARTITION BY {x}) AS {x}_i" for x in r.unique
        )
        selects.append(f"SELECT unnest([{', '.join(found)}]) AS o FROM (SELECT *{numbered} FROM ({source}))")
    for name, table, sql in (
        ("one_active_version", "code_history", with_tables(
            "SELECT initial_store_code FROM code_history WHERE end_date = DATE '9999-12-31' GROUP BY 1 HAVING count(*) > 1")),
        ("one_profile", "customer_profile", with_tables("SELECT customer_id FROM profiles GROUP BY 1 HAVING count(*) > 1")),
        ("date_range", "code_history", with_tables("SELECT 1 FROM code_history WHERE end_date < start_date")),
        ("sales_resolve", "fact_sales", SQL["check_sales_resolve"]),
        ("known_segment", "sales_by_customer", with_tables("SELECT 1 FROM rated WHERE segment IS NULL")),
    ):
        selects.append(f"SELECT unnest([{_outcome_sql(name, table, None, 'count(*)')}]) AS o FROM ({sql})")
    return f"SELECT unnest(o), o.violations = 0 AS passed FROM ({' UNION ALL '.join(selects)})"


@entry("run_checks", None)
def _(t):
    return quality.run_checks({name: t[name] for name in quality.RULES})


SQL["run_checks"] = _checks_sql()
