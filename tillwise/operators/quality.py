"""Data-quality checks. A check returns the violating rows; it passes when there are none."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.operators.relational import asof_version_join, duplicate_keys, not_in, store_by_status
from tillwise.schemas import GRAINS, OPEN_END, SCORES, SEGMENTS, STORE_STATUSES, TIERS

# --- conditions on one row: true where the row violates the rule. NULL passes all but not_null. --------


def null_value(col: str) -> Column:
    return F.col(col).isNull()


def not_accepted(col: str, values: Sequence) -> Column:
    return ~F.col(col).isin(*values)


def not_positive(col: str) -> Column:
    return F.col(col) <= 0


def inconsistent_total(total: str, qty: str, price: str, tol: float = 1) -> Column:
    return F.abs(F.col(total) - F.col(qty) * F.col(price)) > F.lit(tol)


# --- checks ----------------------------------------------------------------------------------------


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(reduce(Column.__or__, [null_value(c) for c in cols]))


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return duplicate_keys(df.dropna(subset=list(cols)), cols)


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return not_in(df, col, values)


def check_positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter(not_positive(col))


def check_total(df: DataFrame, total: str, qty: str, price: str, tol: float = 1) -> DataFrame:
    expected = F.col(qty) * F.col(price)
    return df.filter(inconsistent_total(total, qty, price, tol)).withColumns(
        {"expected_amount": expected, "diff": F.abs(F.col(total) - expected)}
    )


def check_one_active(history: DataFrame) -> DataFrame:
    return duplicate_keys(store_by_status(history, "active"), ["initial_store_code"])


def check_date_range(history: DataFrame) -> DataFrame:
    return history.filter("end_date < start_date")


def check_sales_resolve(fact: DataFrame, history: DataFrame) -> DataFrame:
    """Sales for which no code version was valid on the order date."""
    sales = fact.select("order_id", "store_code", "order_date")
    return asof_version_join(sales, history, "store_code", "order_date", how="left_anti")


def unknown_segment() -> Column:
    return null_value("customer_segment") | not_accepted("customer_segment", SEGMENTS)


def check_segments(by_customer: DataFrame) -> DataFrame:
    return by_customer.filter(unknown_segment()).select("customer_id", "customer_segment")


def freshness(df: DataFrame, col: str, as_of: dt.date, warn: int = 7, error: int = 14) -> DataFrame:
    """One row: newest batch, its age in days, and pass / warn / error."""
    newest = df.agg(F.max(F.to_date(col)).alias("latest"))
    age = F.datediff(F.lit(as_of), "latest")
    status = F.when(age > error, "error").when(age > warn, "warn").when(age.isNotNull(), "pass").otherwise("error")
    return newest.withColumns({"age_days": age, "status": status})


# --- declared checks -------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableRules:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    total: tuple[str, str, str] | None = None


def _rules(not_null: str, unique: str = "", positive: str = "", accepted=None, total=None) -> TableRules:
    return TableRules(tuple(not_null.split()), tuple(unique.split()), tuple(positive.split()), accepted or {}, total)


_HISTORY = "initial_store_code store_code start_date end_date"

# Which column carries which rule.
RULES: dict[str, TableRules] = {
    "fact_sales": _rules(
        "order_id order_date store_code customer_id product_id quantity unit_price total_amount partition_time",
        "order_id", "quantity unit_price total_amount", total=("total_amount", "quantity", "unit_price"),
    ),
    "code_history": _rules(_HISTORY),
    "active_store": _rules(_HISTORY, "initial_store_code store_code"),
    "closed_store": _rules(_HISTORY),
    "customer_profile": _rules(
        "customer_id full_name email city province registration_date days_as_customer current_tier tier_since"
        " total_tier_upgrades lifetime_orders lifetime_spend",
        "customer_id", accepted={"current_tier": TIERS},
    ),
    "store_performance": _rules(
        "initial_store_code month total_orders unique_customers total_qty_sold total_revenue avg_order_value"
        " revenue_rank cumulative_revenue",
        positive="total_revenue",
    ),
    "store_directory": _rules(
        "initial_store_code status total_code_changes lifetime_revenue lifetime_orders",
        "initial_store_code", accepted={"status": STORE_STATUSES},
    ),
    "sales_summary": _rules(
        "grain period total_orders total_revenue", positive="total_revenue", accepted={"grain": GRAINS}
    ),
    "sales_by_product": _rules(
        "product_id month total_qty_sold total_revenue revenue_rank qty_rank", positive="total_qty_sold total_revenue"
    ),
    "sales_by_customer": _rules(
        "customer_id total_orders total_spend avg_order_value days_since_last_purchase recency_score"
        " frequency_score monetary_score customer_segment",
        "customer_id", "total_spend",
        {"recency_score": SCORES, "frequency_score": SCORES, "monetary_score": SCORES, "customer_segment": SEGMENTS},
    ),
    "kpi_revenue": _rules(
        "month total_revenue total_orders unique_buyers total_qty_sold cumulative_revenue", "month", "total_revenue"
    ),
    "kpi_orders": _rules(
        "month total_orders avg_order_value avg_items_per_order unique_buyers active_stores", "month", "avg_order_value"
    ),
    "kpi_customer_retention": _rules(
        "month total_buyers new_customers returning_customers retained_from_prev_month new_customer_pct", "month"
    ),
    "kpi_store": _rules(
        "month active_store_count total_market_revenue avg_revenue_per_store top_store_code bottom_store_code"
        " top3_concentration_pct",
        "month", "total_market_revenue avg_revenue_per_store",
    ),
    "kpi_product": _rules(
        "month distinct_products_sold total_product_revenue avg_revenue_per_product top_product_by_revenue"
        " top_product_by_qty product_diversity_index",
        "month", "total_product_revenue avg_revenue_per_product",
    ),
    "kpi_exec_summary": _rules(
        "month total_revenue total_orders unique_buyers active_store_count distinct_products_sold", "month", "total_revenue"
    ),
}

@dataclass(frozen=True)
class TableCheck:
    """A rule with a name of its own on ``table``: violating rows, a key that may occur once, or a query over ``needs``."""

    table: str
    row: Callable[[], Column] | None = None
    key: Callable[[], Column] | None = None
    needs: tuple[str, ...] = ()
    query: Callable[..., DataFrame] | None = None


TABLE_CHECKS: dict[str, TableCheck] = {
    "one_active_version": TableCheck("code_history", key=lambda: F.when(F.col("end_date") == F.lit(OPEN_END), F.col("initial_store_code"))),
    "one_profile": TableCheck("customer_profile", key=lambda: F.col("customer_id")),
    "date_range": TableCheck("code_history", row=lambda: F.col("end_date") < F.col("start_date")),
    "sales_resolve": TableCheck("fact_sales", needs=("fact_sales", "code_history"), query=check_sales_resolve),
    "known_segment": TableCheck("sales_by_customer", row=unknown_segment),
}


def _row_conditions(rules: TableRules) -> dict[tuple[str, str], Column]:
    found = {("not_null", c): null_value(c) for c in rules.not_null}
    found |= {("positive", c): not_positive(c) for c in rules.positive}
    found |= {("accepted_values", c): not_accepted(c, values) for c, values in rules.accepted.items()}
    if rules.total:
        found["total_consistent", rules.total[0]] = inconsistent_total(*rules.total)
    return found


def run_checks(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules] = RULES,
    table_checks: Mapping[str, TableCheck] = TABLE_CHECKS,
) -> DataFrame:
    """(check, table, column, violations, passed) for every declared rule whose tables are given.

    One scan per table, whatever its rules, and one shuffle for all: a row gives a mark for each rule it violates and
    for each of its keys. Marks of violations are added up in the map tasks, those of keys are counted per value,
    where a value seen more than once is a violation. Only rules that join tables are jobs of their own.
    """
    declared: list[tuple] = []
    marks: dict[str, list[Column]] = {name: [] for name in tables}

    def declare(check: str, table: str, column: str | None) -> int:
        declared.append((len(declared), check, table, column))
        return len(declared) - 1

    def mark(table: str, rule: int, where: Column, value: Column) -> None:
        marks[table].append(F.when(where, F.struct(F.lit(rule).alias("rule"), value.cast("string").alias("value"))))

    for name, declared_rules in rules.items():
        if name in tables:
            for (check, column), violated in _row_conditions(declared_rules).items():
                mark(name, declare(check, name, column), violated, F.lit(None))
            for column in declared_rules.unique:
                mark(name, declare("unique", name, column), F.col(column).isNotNull(), F.col(column))
    joined = []
    for name, check in table_checks.items():
        if check.table not in tables or any(n not in tables for n in check.needs):
            continue
        rule = declare(name, check.table, None)
        if check.row:
            mark(check.table, rule, check.row(), F.lit(None))
        elif check.key:
            mark(check.table, rule, check.key().isNotNull(), check.key())
        else:
            found = check.query(*[tables[n] for n in check.needs]).agg(F.count(F.lit(1)).alias("violations"))
            joined.append(found.select(F.lit(rule).alias("rule"), "violations"))
    seen = [
        tables[name].select(F.inline(F.filter(F.array(*found), lambda m: m.isNotNull())).alias("rule", "value"))
        for name, found in marks.items() if found
    ]
    spark = next(iter(tables.values())).sparkSession
    every = spark.createDataFrame(declared, "rule int, check string, table string, column string")
    counted = reduce(DataFrame.unionByName, seen).groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n"))
    violations = counted.groupBy("rule").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise((F.col("n") > 1).cast("bigint"))).alias("violations"))
    violations = reduce(DataFrame.unionByName, [violations, *joined])
    out = every.join(violations, "rule", "left").withColumn("violations", F.coalesce("violations", F.lit(0)).cast("bigint"))
    return out.select("check", "table", "column", "violations", (F.col("violations") == 0).alias("passed"))
