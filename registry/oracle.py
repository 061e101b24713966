"""SQL counterparts: shared table expressions over the given tables, and exact rounding.

Money is held in whole cents and percentages in whole hundredths, so every rounding is integer
arithmetic (half up, away from zero); results are divided down only in the outermost SELECT.
"""

from __future__ import annotations

import re


def half_up(num: str, den: str, mult: int = 1) -> str:
    """``round(num * mult / den)`` on integers; NULL when ``den`` is 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * sign({d}) * "
        f"((2 * {mult} * abs({n}) + abs({d})) // (2 * abs({d}))) END)"
    )


def pct(num: str, den: str) -> str:
    """Percentage in hundredths."""
    return half_up(num, den, 10000)


def growth(cur: str, prev: str) -> str:
    return pct(f"({cur} - {prev})", prev)


def mean(col: str) -> str:
    return half_up(f"sum({col})", f"count({col})")


def n(expr: str, name: str = "") -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def c(expr: str, name: str) -> str:
    """Cents or hundredths to units."""
    return f"CAST({expr} AS DOUBLE) / 1e2 AS {name}"


def d(expr: str, name: str = "") -> str:
    return f"CAST({expr} AS VARCHAR) AS {name or expr}"


def _code(key: str, day: str, fixed: str = "false") -> str:
    return (
        f"'S' || lpad(CAST({key} AS VARCHAR), 9, '0') || CASE WHEN {fixed} THEN 'A' "
        f"WHEN {key} % 10 = 0 AND {day} >= DATE '1999-01-01' THEN 'C' "
        f"WHEN {key} % 5 = 0 AND {day} >= DATE '1997-01-01' THEN 'B' ELSE 'A' END"
    )


_YEARS = ", ".join(f"DATE '{y}-01-01'" for y in range(1996, 2003))

CTES: dict[str, str] = {
    "line_orders": """
        SELECT l_orderkey AS k, min(l_suppkey) AS sk, min(l_partkey) AS pk, sum(CAST(l_quantity AS BIGINT)) AS q,
               sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)) AS cents
        FROM lineitem GROUP BY l_orderkey""",
    "head_orders": """
        SELECT o_orderkey AS k, CAST(min(o_orderdate) AS DATE) AS d, min(o_custkey) AS ck FROM orders GROUP BY o_orderkey""",
    "sales": f"""
        SELECT k AS order_id, d AS order_date, strftime(d, '%Y-%m') AS month, {_code('sk', 'd', 'sk % 17 = 0')} AS store_code,
               'C' || ck AS customer_id, 'P' || pk AS product_id, CAST(q AS BIGINT) AS quantity,
               CAST({half_up('cents', 'q')} AS BIGINT) AS price_c, CAST(cents AS BIGINT) AS total_c,
               CAST(date_trunc('month', d) AS DATE) AS partition_time
        FROM line_orders JOIN head_orders USING (k)""",
    "sales_lines": f"""
        SELECT l_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, strftime(o_orderdate, '%Y-%m') AS month,
               {_code('l_suppkey', 'CAST(o_orderdate AS DATE)')} AS store_code,
               'C' || o_custkey AS customer_id, 'P' || l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS total_c,
               CAST({half_up('CAST(l_extendedprice AS DECIMAL(12,2)) * 100', 'l_quantity')} AS BIGINT) AS price_c
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "src_store": f"""
        SELECT {_code('s_suppkey', 'day')} AS store_code, CAST(s_suppkey AS VARCHAR) AS latitude,
               CAST(s_nationkey AS VARCHAR) AS longitude, day
        FROM (SELECT s_suppkey, s_nationkey, CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01',
              INTERVAL 1 MONTH)) AS DATE) AS day FROM supplier)""",
    "store_names": """
        SELECT latitude, longitude, arg_min(store_code, (day, store_code)) AS initial_store_code
        FROM src_store GROUP BY ALL""",
    "code_starts": """
        SELECT initial_store_code, store_code, min(day) AS start_date
        FROM src_store JOIN store_names USING (latitude, longitude) GROUP BY ALL""",
    "code_history": """
        SELECT *, coalesce(lead(start_date) OVER (PARTITION BY initial_store_code ORDER BY start_date, store_code),
               DATE '9999-12-31') AS end_date FROM code_starts""",
    "placed": """
        SELECT s.*, h.initial_store_code FROM sales s LEFT JOIN code_history h
        ON h.store_code = s.store_code AND s.order_date >= h.start_date AND s.order_date < h.end_date""",
    "src_customer": f"""
        SELECT 'c' || c_custkey AS customer_id, ' o''' || lower(c_mktsegment) || '-VAN ' || c_custkey AS full_name,
               ' C' || c_custkey || '@Example.COM ' AS email, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS phone,
               lower(c_mktsegment) AS city, 'nation ' || c_nationkey AS province, registered, day,
               CASE WHEN spent < 20000000 THEN 'Bronze' WHEN spent < 70000000 THEN 'Silver' ELSE 'Gold' END AS tier
        FROM (SELECT o_custkey AS c_custkey, day,
                     sum(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT)) AS spent,
                     CAST(min(o_orderdate) AS DATE) AS registered
              FROM orders, (SELECT unnest([{_YEARS}]) AS day) WHERE o_orderdate < day GROUP BY ALL)
        JOIN customer USING (c_custkey)""",
    "dim_customer": """
        SELECT * EXCLUDE (day, changed), CAST(day AS TIMESTAMP) AS valid_from,
               CAST(lead(day) OVER (PARTITION BY customer_id ORDER BY day) AS TIMESTAMP) AS valid_to, day
        FROM (SELECT *, lag(tier) OVER (PARTITION BY customer_id ORDER BY day) IS DISTINCT FROM tier AS changed
              FROM src_customer) WHERE changed""",
    "store_perf": f"""
        SELECT *, rank() OVER (PARTITION BY month ORDER BY revenue_c DESC NULLS FIRST) AS rk,
               sum(revenue_c) OVER (PARTITION BY initial_store_code ORDER BY month ROWS UNBOUNDED PRECEDING) AS running_c
        FROM (SELECT initial_store_code, month, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS buyers,
                     sum(quantity) AS qty, sum(total_c) AS revenue_c, {mean('total_c')} AS aov_c
              FROM placed GROUP BY ALL)""",
    "store_dir": """
        SELECT initial_store_code, arg_max(store_code, start_date) FILTER (end_date = DATE '9999-12-31') AS current_code,
               CASE WHEN max(end_date) = DATE '9999-12-31' THEN 'active' ELSE 'closed' END AS status,
               max(start_date) AS active_since, count(*) - 1 AS changes,
               coalesce(any_value(revenue_c), 0) AS revenue_c, coalesce(any_value(orders), 0) AS orders
        FROM code_history LEFT JOIN (SELECT initial_store_code, sum(total_c) AS revenue_c, count(DISTINCT order_id) AS orders
                                     FROM placed GROUP BY ALL) USING (initial_store_code)
        GROUP BY initial_store_code""",
    "days": f"""
        SELECT order_date, month, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS buyers,
               count(DISTINCT store_code) AS stores, sum(quantity) AS qty, sum(total_c) AS revenue_c,
               {mean('total_c')} AS aov_c FROM sales GROUP BY ALL""",
    "day_months": f"""
        SELECT month, sum(orders) AS orders, sum(buyers) AS buyers, max(stores) AS stores, sum(qty) AS qty,
               sum(revenue_c) AS revenue_c, {mean('aov_c')} AS aov_c FROM days GROUP BY ALL""",
    "periods": f"""
        SELECT 'daily' AS grain, CAST(order_date AS VARCHAR) AS period, month, orders, buyers, stores, qty, revenue_c, aov_c,
               CAST(NULL AS HUGEINT) AS growth_h FROM days
        UNION ALL
        SELECT 'monthly', month, month, orders, buyers, stores, qty, revenue_c, aov_c,
               {growth('revenue_c', 'lag(revenue_c) OVER (ORDER BY month)')} FROM day_months""",
    "products": f"""
        SELECT *, rank() OVER (PARTITION BY month ORDER BY revenue_c DESC NULLS FIRST) AS revenue_rank,
               rank() OVER (PARTITION BY month ORDER BY qty DESC NULLS FIRST) AS qty_rank
        FROM (SELECT product_id, month, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS buyers,
                     count(DISTINCT store_code) AS stores, sum(quantity) AS qty, sum(total_c) AS revenue_c,
                     {mean('price_c')} AS price_c, min(price_c) AS min_c, max(price_c) AS max_c
              FROM sales GROUP BY ALL)""",
    "buyer_base": f"""
        SELECT customer_id, count(DISTINCT order_id) AS orders, count(DISTINCT store_code) AS stores,
               count(DISTINCT product_id) AS products, sum(quantity) AS qty, sum(total_c) AS spend_c,
               {mean('total_c')} AS aov_c, min(order_date) AS first_day, max(order_date) AS last_day
        FROM sales GROUP BY ALL""",
    "favorites": """
        SELECT customer_id, arg_min(product_id, (-qty, product_id)) AS favorite
        FROM (SELECT customer_id, product_id, sum(quantity) AS qty FROM sales GROUP BY ALL) GROUP BY ALL""",
    **{
        name: f"""
        SELECT *, CASE WHEN r + f + m >= 8 THEN 'Champions' WHEN r + f + m >= 6 THEN 'Loyal'
                       WHEN r > 1 AND f = 1 THEN 'Promising' WHEN r = 1 AND f > 1 THEN 'At Risk'
                       ELSE 'Need Attention' END AS segment
        FROM (SELECT *, DATE '2001-08-01' - last_day AS idle,
                     1 + CAST(DATE '2001-08-01' - last_day <= 90 AS INT) + CAST(DATE '2001-08-01' - last_day <= 30 AS INT) AS r,
                     1 + CAST(orders >= {o2} AS INT) + CAST(orders >= {o3} AS INT) AS f,
                     1 + CAST(spend_c >= {s2} AS INT) + CAST(spend_c >= {s3} AS INT) AS m
              FROM buyer_base JOIN favorites USING (customer_id))"""
        for name, o2, o3, s2, s3 in (
            ("rated", 2, 5, 10000000, 30000000), ("rated_scaled", 8, 11, 170000000, 240000000),
        )
    },
    "revenue_k": f"""
        SELECT *, lag(revenue_c) OVER w AS prev_c, {growth('revenue_c', 'lag(revenue_c) OVER w')} AS growth_h,
               {half_up('sum(revenue_c) OVER w3', 'count(revenue_c) OVER w3')} AS rolling_c,
               sum(revenue_c) OVER w AS running_c, {pct('revenue_c', 'sum(revenue_c) OVER ()')} AS share_h
        FROM (SELECT month, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS buyers,
                     sum(total_c) AS revenue_c, sum(quantity) AS qty FROM sales GROUP BY ALL)
        WINDOW w AS (ORDER BY month), w3 AS (ORDER BY month ROWS 2 PRECEDING)""",
    "orders_k": f"""
        SELECT *, {half_up('qty', 'orders', 100)} AS items_h, lag(orders) OVER w AS prev_orders,
               {growth('orders', 'lag(orders) OVER w')} AS orders_growth_h, lag(aov_c) OVER w AS prev_aov_c,
               {growth('aov_c', 'lag(aov_c) OVER w')} AS aov_growth_h, {half_up('revenue_c', 'stores')} AS per_store_c,
               {half_up('orders', 'buyers', 100)} AS per_buyer_h
        FROM (SELECT month, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS buyers,
                     count(DISTINCT store_code) AS stores, count(DISTINCT product_id) AS products, sum(quantity) AS qty,
                     sum(total_c) AS revenue_c, {mean('total_c')} AS aov_c FROM sales GROUP BY ALL)
        WINDOW w AS (ORDER BY month)""",
    "visits": "SELECT DISTINCT month, customer_id FROM sales",
    "kept": """
        SELECT a.month, a.customer_id FROM visits a JOIN visits b ON a.customer_id = b.customer_id
        AND b.month = strftime(CAST(a.month || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')""",
    "retention_k": f"""
        SELECT *, {pct('retained', 'prev_buyers')} AS retention_h, {pct('(prev_buyers - retained)', 'prev_buyers')} AS churn_h,
               {pct('fresh', 'buyers')} AS fresh_h, {growth('buyers', 'prev_buyers')} AS growth_h
        FROM (SELECT v.month, count(*) AS buyers, count(*) FILTER (f.born = v.month) AS fresh,
                     count(*) FILTER (f.born < v.month) AS back, coalesce(any_value(k.c), 0) AS retained,
                     lag(count(*)) OVER (ORDER BY v.month) AS prev_buyers
              FROM visits v JOIN (SELECT customer_id, min(month) AS born FROM visits GROUP BY 1) f USING (customer_id)
              LEFT JOIN (SELECT month, count(*) AS c FROM kept GROUP BY 1) k ON k.month = v.month GROUP BY v.month)""",
    "store_k": f"""
        SELECT *, lag(revenue_c) OVER (ORDER BY month) AS prev_c, {pct('top_c', 'revenue_c')} AS top_h,
               {pct('top3_c', 'revenue_c')} AS top3_h, {growth('revenue_c', 'lag(revenue_c) OVER (ORDER BY month)')} AS growth_h
        FROM (SELECT month, count(DISTINCT initial_store_code) AS stores, sum(revenue_c) AS revenue_c, sum(orders) AS orders,
                     sum(buyers) AS buyers, {mean('revenue_c')} AS mean_c, min(revenue_c) AS min_c, max(revenue_c) AS max_c,
                     sum(revenue_c) FILTER (rk <= 3) AS top3_c FROM store_perf GROUP BY month)
        JOIN (SELECT DISTINCT ON (month) month, initial_store_code AS top, revenue_c AS top_c, orders AS top_orders,
                     buyers AS top_buyers FROM store_perf ORDER BY month, revenue_c DESC, initial_store_code NULLS LAST)
             USING (month)
        JOIN (SELECT DISTINCT ON (month) month, initial_store_code AS low, revenue_c AS low_c FROM store_perf
              ORDER BY month, revenue_c, initial_store_code NULLS LAST) USING (month)""",
    "product_k": f"""
        SELECT *, {pct('top_c', 'revenue_c')} AS top_h, {half_up('(revenue_c - top_c)', 'revenue_c', 10000)} AS diversity_tt,
               lag(products) OVER (ORDER BY month) AS prev_products, lag(revenue_c) OVER (ORDER BY month) AS prev_c,
               {growth('revenue_c', 'lag(revenue_c) OVER (ORDER BY month)')} AS growth_h
        FROM (SELECT month, count(DISTINCT product_id) AS products, sum(revenue_c) AS revenue_c, sum(qty) AS qty,
                     sum(orders) AS orders, {mean('revenue_c')} AS mean_c FROM products GROUP BY month)
        JOIN (SELECT DISTINCT ON (month) month, product_id AS top, revenue_c AS top_c, qty AS top_qty, buyers AS top_buyers,
                     stores AS top_stores FROM products ORDER BY month, revenue_c DESC, product_id) USING (month)
        JOIN (SELECT DISTINCT ON (month) month, product_id AS most, qty AS most_qty FROM products
              ORDER BY month, qty DESC, product_id) USING (month)""",
    "loads": """
        SELECT order_id, order_date, store_code, customer_id, product_id, total_c, load,
               quantity + CAST(order_id % 5 = 0 AND load >= DATE '2001-10-01' AS INT) AS quantity,
               price_c + 100 * CAST(order_id % 7 = 0 AND load >= DATE '2001-11-01' AS INT) AS price_c
        FROM sales, (SELECT unnest([DATE '2001-09-01', DATE '2001-10-01', DATE '2001-11-01']) AS load)
        WHERE order_id % 11 <> 0 OR load >= DATE '2001-10-01'""",
    "dim_sales": """
        SELECT *, CAST(load AS TIMESTAMP) AS valid_from,
               CAST(lead(load) OVER (PARTITION BY order_id ORDER BY load) AS TIMESTAMP) AS valid_to
        FROM (SELECT *, lag((quantity, price_c)) OVER (PARTITION BY order_id ORDER BY load)
                        IS DISTINCT FROM (quantity, price_c) AS changed FROM loads) WHERE changed""",
    "details": f"""
        SELECT 'S' || s_suppkey AS store_code, s_name, s_suppkey AS sk, s_nationkey AS nk, day, CAST(CAST(s_acctbal AS DECIMAL(12,2)) * 100 AS BIGINT) AS gross_c,
               CAST(CAST(s_acctbal AS DECIMAL(12,2)) * 100 AS BIGINT)
                 + CASE WHEN s_suppkey % 6 = 0 AND day >= DATE '1998-01-01' THEN 1000 ELSE 0 END AS net_c,
               CASE WHEN s_suppkey % 13 = 0 AND day >= DATE '2001-01-01' THEN DATE '2001-01-01' END AS closing,
               CASE WHEN s_suppkey % 4 = 0 AND day >= DATE '1999-01-01' THEN 'large' ELSE 'small' END AS format
        FROM (SELECT *, unnest([{_YEARS}]) AS day FROM supplier)""",
    "dim_store": """
        SELECT *, CAST(day AS TIMESTAMP) AS valid_from,
               CAST(lead(day) OVER (PARTITION BY store_code ORDER BY day) AS TIMESTAMP) AS valid_to
        FROM (SELECT *, lag((net_c, closing, format)) OVER (PARTITION BY store_code ORDER BY day)
                        IS DISTINCT FROM (net_c, closing, format) AS changed FROM details) WHERE changed""",
    "profiles": """
        SELECT d.customer_id AS raw_id, upper(d.customer_id) AS customer_id, d.*  EXCLUDE (customer_id), j.changes, j.journey,
               coalesce(b.orders, 0) AS orders, coalesce(b.spend_c, 0) AS spend_c, b.first_day, b.last_day
        FROM dim_customer d
        JOIN (SELECT customer_id, count(*) - 1 AS changes, string_agg(tier, ' → ' ORDER BY day) AS journey
              FROM dim_customer GROUP BY 1) j USING (customer_id)
        LEFT JOIN buyer_base b ON b.customer_id = upper(d.customer_id) WHERE d.valid_to IS NULL""",
}

_WORD = re.compile(r"[a-z_0-9]+")


def _needed(sql: str, ctes: dict[str, str], seen: set[str]) -> set[str]:
    for word in set(_WORD.findall(sql)) & ctes.keys() - seen:
        # a column may share its name with a table expression: only FROM / JOIN / comma positions count
        if re.search(rf"(FROM|JOIN|,)\s+{word}\b", sql):
            seen.add(word)
            _needed(ctes[word], ctes, seen)
    return seen


def with_tables(sql: str, fact: str = "sales") -> str:
    """``sql`` preceded by the table expressions it uses, reading sales from ``fact``."""
    ctes = {name: re.sub(r"\bFROM sales\b", f"FROM {fact}", text) for name, text in CTES.items()}
    used = _needed(sql, ctes, set())
    parts = ",\n".join(f"{name} AS ({ctes[name]})" for name in ctes if name in used)
    return f"WITH {parts}\n{sql}" if parts else sql
