"""Distinct counts and retention from parts that merge: a batch adds its own part, nothing older is read again.

Distinct counts. Values (customers, stores, products) are numbered once; a set of them has a whole number as bits per
64 numbers, so sets of parts are or-ed into sets of any coarser key, exactly. A set never has more rows than values,
and all rows have one short length, so they are or-ed in place. Numbers follow the order of ``near``, a column that
values of one set tend to share (the home store of a customer), which keeps a store's customers in few rows.

Retention. The months in which a customer bought are the bits of one whole number per five years. Parts are or-ed;
who bought in two months in a row is the number and itself, shifted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions import windows
from tillwise.sources.shared import store

_ERA = 60  # months of one whole number; five years
_RANGE = 33  # a range of numbers given out by one task

# --- sets as bits ----------------------------------------------------------------------------------


def number_values(known: DataFrame | None, rows: DataFrame, value: str, near: str) -> DataFrame:
    """``(value, number)`` of the values of ``rows`` that ``known`` lacks, stored; append it to ``known``.

    Numbers are dealt out by ranges of (near, value): consecutive inside a task, and no two parts share one.
    """
    fresh = rows.filter(F.col(value).isNotNull()).groupBy(value).agg(F.min(near).alias("_near"))
    start = 0
    if known is not None:
        fresh = fresh.join(known.select(value), value, "left_anti")
        last = known.agg(F.max("number")).first()[0]
        start = 0 if last is None else ((last >> _RANGE) + 1) << _RANGE
    ordered = fresh.repartitionByRange("_near", value).sortWithinPartitions("_near", value)
    return store(ordered.select(value, (F.monotonically_increasing_id() + F.lit(start)).alias("number")), "numbers")


def set_parts(rows: DataFrame, keys: Sequence[str], value: str, numbers: DataFrame) -> DataFrame:
    """``(*keys, piece, bits)``: per key the set of the values of its rows. Rows are reduced to pairs first."""
    pairs = rows.filter(F.col(value).isNotNull()).select(*keys, value).distinct().join(numbers, value)
    number = F.col("number")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))
    return pairs.groupBy(*keys, F.shiftright(number, 6).alias("piece")).agg(F.bit_or(one).alias("bits"))


def merge_sets(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets per ``keys``, which may be coarser than those of the parts."""
    return parts.groupBy(*keys, "piece").agg(F.bit_or("bits").alias("bits"))


def count_sets(parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of different values per ``keys``."""
    return merge_sets(parts, keys).groupBy(*keys).agg(F.sum(F.bit_count("bits").cast("bigint")).alias(name))


# --- months as bits --------------------------------------------------------------------------------


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def buyer_months(fact: DataFrame) -> DataFrame:
    """``(customer_id, era, bits)``: the months in which each customer bought. Rows without customer or date have none."""
    month = _month_number(F.col("order_date"))
    rows = fact.filter("customer_id is not null and order_date is not null").select(
        "customer_id", F.floor(month / _ERA).cast("int").alias("era"), F.pmod(month, F.lit(_ERA)).alias("_bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    return rows.groupBy("customer_id", "era").agg(F.bit_or(one).alias("bits"))


def merge_buyer_months(*parts: DataFrame) -> DataFrame:
    """``buyer_months`` of all rows from those of parts of them, dealt out by customer."""
    united = reduce(DataFrame.unionByName, parts).repartition("customer_id")
    return united.groupBy("customer_id", "era").agg(F.bit_or("bits").alias("bits"))


def retention_months(months: DataFrame) -> DataFrame:
    """Buyers per month, from ``merge_buyer_months``: all, new, returning, and those of the month before.

    A customer has one row per five years, compared in one window; each row gives its months on the spot, and only
    counts are shuffled.
    """
    eras = windows.by(["customer_id"], F.col("era"))
    before = F.when(F.lag("era").over(eras) == F.col("era") - 1, F.shiftright(F.lag("bits").over(eras), _ERA - 1)).otherwise(F.lit(0))
    bits = F.col("bits")
    marked = months.select(
        "era", "bits", bits.bitwiseAND(F.shiftleft(bits, 1).bitwiseOR(before)).alias("kept"),
        F.when(F.lag("era").over(eras).isNull(), bits.bitwiseAND(-bits)).otherwise(F.lit(0)).alias("first"),
    )
    is_set = lambda c, i: F.call_function("shiftright", F.col(c), i).bitwiseAND(F.lit(1)) == 1
    places = F.filter(F.sequence(F.lit(0), F.lit(_ERA - 1)), lambda i: is_set("bits", i))
    each = marked.select("era", "kept", "first", F.explode(places).alias("i"))
    number = F.col("era") * _ERA + F.col("i")
    counted = each.groupBy(number.alias("number")).agg(
        F.count(F.lit(1)).alias("total_buyers"), F.count_if(is_set("first", F.col("i"))).alias("new_customers"),
        F.count_if(is_set("kept", F.col("i"))).alias("retained_from_prev_month"),
    )
    year = F.floor(F.col("number") / 12).cast("int")
    day = F.make_date(year, (F.col("number") - year * 12 + 1).cast("int"), F.lit(1))
    returning = F.col("total_buyers") - F.col("new_customers")
    return counted.select(day.alias("_m"), "total_buyers", "new_customers", returning.alias("returning_customers"), "retained_from_prev_month")
