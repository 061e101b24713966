"""Aggregate expressions that need more than one built-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_orders(unique: bool) -> Column:
    """Distinct orders. Where order ids are known to be unique a plain count says the same without
    shuffling every order id."""
    return F.count("order_id") if unique else F.countDistinct("order_id")


def order_count(name: str, unique: bool) -> tuple[list[Column], dict[str, str]]:
    """The same for ``relational.aggregate_distinct``: ordinary aggregates, distinct counts."""
    return ([F.count("order_id").alias(name)], {}) if unique else ([], {name: "order_id"})


def count_if_distinct(cond: Column, c: Column) -> Column:
    return F.countDistinct(F.when(cond, c))


def ordered_concat(c: str, order: str, sep: str) -> Column:
    """Non-NULL values joined in ``order``. For groups that stay small, such as versions of one entity."""
    pairs = F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("v"))))
    joined = F.array_join(F.transform(F.array_sort(pairs), lambda p: p["v"]), sep)
    return F.when(F.count(c) > 0, joined)


def distinct_concat(c: str, sep: str) -> Column:
    """Distinct non-NULL values joined in ascending order. For groups of few distinct values."""
    return F.when(F.count(c) > 0, F.array_join(F.array_sort(F.collect_set(c)), sep))


def _ordering(c: Column) -> list[Column]:
    return [c.isNull(), c]


def descending(c: Column) -> list[Column]:
    """Order for ``least_row``: largest first, NULL before all."""
    return [c.isNotNull(), -c]


def least_row(*order: Column, payload: dict[str, Column], where: Column | None = None) -> Column:
    """Struct of ``payload`` for the row that comes first by ``order`` (ascending, NULLs last).

    Map tasks keep a single row per group, so a group of any size reaches the reducer as one row per map
    task. A struct cannot be updated in place, so Spark sorts for it: keep it out of wide aggregations of
    many rows and use it on tables that are small already.
    """
    keys = [k.alias(f"k{i}") for i, k in enumerate(x for c in order for x in _ordering(c))]
    row = F.struct(*keys, *[c.alias(name) for name, c in payload.items()])
    return F.min(row if where is None else F.when(where, row))
