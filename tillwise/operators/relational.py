"""General building blocks: batch scans, filters, joins, grouping, top-k and set operations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import calendar, windows
from tillwise.functions.aggregates import least_row
from tillwise.schemas import OPEN_END
from tillwise.sources.shared import store

# --- batch scans -----------------------------------------------------------------------------------


def _next_day(day: dt.date) -> dt.date:
    return day + dt.timedelta(days=1)


def upto_batch(df: DataFrame, cutoff: dt.date, col: str = "partition_time") -> DataFrame:
    """Rows of batches dated ``cutoff`` or earlier.

    The bare column is compared, never ``to_date(col)``, so the predicate prunes directories and
    row groups for both date and timestamp batch columns.
    """
    return df.filter(F.col(col) < F.lit(_next_day(cutoff)))


def one_batch(df: DataFrame, day: dt.date, col: str = "partition_time") -> DataFrame:
    return df.filter((F.col(col) >= F.lit(day)) & (F.col(col) < F.lit(_next_day(day))))


def all_batches(df: DataFrame) -> DataFrame:
    return df


# --- filters ---------------------------------------------------------------------------------------


def store_by_status(history: DataFrame, status: str, as_of: dt.date | None = None) -> DataFrame:
    """Active or closed code versions; any other status keeps every row."""
    if status == "active":
        history = history.filter(F.col("end_date") == F.lit(OPEN_END))
    elif status == "closed":
        history = history.filter(F.col("end_date") < F.lit(as_of))
    return history.select("initial_store_code", "store_code", "start_date", "end_date")


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("valid_to").isNull())


def history_of(dim: DataFrame, key: str, value) -> DataFrame:
    return dim.filter(F.col(key) == F.lit(value)).orderBy("valid_from")


def top_rows(df: DataFrame, rank_col: str, k: int) -> DataFrame:
    return df.filter(F.col(rank_col) <= k)


def not_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside the list; NULL is not returned."""
    return df.filter(~F.col(col).isin(*values))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


# --- joins -----------------------------------------------------------------------------------------


def asof_version_join(
    fact: DataFrame, versions: DataFrame, key: str, date: str,
    start: str = "start_date", end: str = "end_date", how: str = "left",
) -> DataFrame:
    """Attach the version valid on ``date``: ``start <= date < end``.

    The key equality makes this a hash or sort-merge join with the date range as residual condition,
    so a fact row meets only the versions of its own key. No broadcast is forced: the optimizer
    broadcasts the versions when their measured size allows, and beyond that the sort-merge join
    leaves a hot key to the adaptive skew split of the fact side.
    """
    taken = {*fact.columns, *versions.columns}
    own = {}
    for c in (key, start, end):
        own[c] = f"_{c}"
        while own[c] in taken:
            own[c] = f"_{own[c]}"
        taken.add(own[c])
    renamed = versions.withColumnsRenamed(own)
    on = (F.col(key) == F.col(own[key])) & (F.col(date) >= F.col(own[start])) & (F.col(date) < F.col(own[end]))
    joined = fact.join(renamed, on, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*own.values())


def asof_version_sweep(
    fact: DataFrame, versions: DataFrame, key: str, date: str, start: str = "start_date", end: str = "end_date", *, span: str = "year",
) -> DataFrame:
    """``asof_version_join`` (left) as one pass in time order, for keys with very many versions.

    Versions and rows of a key are put in one line by date, and each row takes the version that started last, if it
    has not ended by then. Nothing is joined, so a row never meets the other versions of its key. A key is cut into
    calendar spans, in each of which the versions that reach into it start the line, so that a hot key is many groups.
    The versions of a key must not overlap, as those of a history don't; rows without key or date have no version.
    """
    others = [c for c in versions.columns if c not in (key, start, end)]
    clash = [c for c in others if c in fact.columns]
    if clash:
        raise ValueError(f"both sides have {clash}")
    first = lambda c: F.date_trunc(span, c).cast("date")
    days = fact.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).first()
    starts, ends = F.col(start).cast("date"), F.date_sub(F.col(end).cast("date"), 1)
    # spans that hold no row need no version
    lo, hi = F.greatest(starts, F.lit(days["lo"]).cast("date")), F.least(ends, F.lit(days["hi"]).cast("date"))
    reaching = versions.filter(F.col(key).isNotNull() & (lo <= hi))
    spans = F.explode(F.sequence(first(lo), first(hi), F.expr(f"interval 1 {span}")))
    told = reaching.select(
        F.col(key).alias("_key"), spans.alias("_span"), F.col(start).alias("_at"),
        F.struct(F.col(end).alias("_until"), *others).alias("_version"), F.lit(None).cast(fact.schema.simpleString()).alias("_row"))
    asked = fact.select(
        F.col(key).alias("_key"), first(F.col(date)).alias("_span"), F.col(date).cast(versions.schema[start].dataType).alias("_at"),
        F.lit(None).cast(told.schema["_version"].dataType).alias("_version"), F.struct(*fact.columns).alias("_row"))
    # rows without key or date meet no version, so they can be dealt out
    loose = F.when(F.col("_key").isNull() | F.col("_span").isNull(), F.pmod(F.xxhash64("_row"), F.lit(1024))).otherwise(0)
    line = told.unionByName(asked).withColumn("_loose", loose)
    w = windows.by(["_key", "_span", "_loose"], F.col("_at"), F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    swept = line.withColumn("_last", F.last("_version", ignorenulls=True).over(w)).filter(F.col("_row").isNotNull())
    valid = F.col("_at") < F.col("_last._until")
    return swept.select("_row.*", *[F.when(valid, F.col(f"_last.{c}")).alias(c) for c in others])


def map_to_identity(stores: DataFrame, identity: DataFrame) -> DataFrame:
    return stores.join(identity, ["latitude", "longitude"])


def not_in_target(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is absent from the target; a NULL key matches nothing and is kept."""
    return source.join(target.select(key), key, "left_anti")


def left_star(base: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    return reduce(lambda left, right: left.join(right, key, "left"), parts, base)


def join_months(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.join(right, "month"), parts)


def full_join_months(parts: Sequence[DataFrame]) -> DataFrame:
    """Full outer chain; each step coalesces the month key."""
    return reduce(lambda left, right: left.join(right, "month", "full_outer"), parts)


# --- grouping --------------------------------------------------------------------------------------


def count_rows(df: DataFrame, keys: Sequence[str], name: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def first_seen(df: DataFrame, keys: Sequence[str], col: str, name: str = "first_seen") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(col).alias(name))


def aggregate_distinct(
    df: DataFrame, keys: Mapping[str, Column], distincts: Mapping[str, str], *aggs: Column
) -> DataFrame:
    """Group by ``keys`` with ``aggs`` and the distinct counts ``{name: column}``.

    Several distinct counts in one aggregation make Spark copy each row once per counted column, and
    every copy carries all columns and buffers through the shuffle. Here each column is reduced on its
    own, as (keys, value) only, and the counts meet as finished groups. One distinct count has no
    copies and stays a single aggregation.
    """
    grouped = [expr.alias(name) for name, expr in keys.items()]
    if len(distincts) < 2:
        counts = [F.countDistinct(col).alias(name) for name, col in distincts.items()]
        return df.groupBy(*grouped).agg(*aggs, *counts)
    parts = [df.groupBy(*grouped).agg(*aggs)]
    for name, col in distincts.items():
        values = df.select(*grouped, col).distinct()
        parts.append(values.groupBy(*keys).agg(F.count(col).alias(name)))
    together = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    # every group is in every part, so each measure has one value per group
    return together.groupBy(*keys).agg(*[F.max(c).alias(c) for c in together.columns if c not in keys])


def global_agg(df: DataFrame, *exprs: Column) -> DataFrame:
    return df.agg(*exprs)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], tiebreak: str) -> DataFrame:
    """First row of each group. Each task keeps one row per group before the shuffle.

    The tiebreak column is mandatory so that equal values give the same row on every run.
    """
    w = windows.by(keys, *order, windows.asc(tiebreak))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def least_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], payload: Mapping[str, Column]) -> DataFrame:
    """``first_per_group`` as a plain aggregation, for when a few payload columns are enough."""
    picked = df.groupBy(*keys).agg(least_row(*order, payload=dict(payload)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{name}").alias(name) for name in payload])


def top_k(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_k_sum(df: DataFrame, group: str, c: str, k: int, name: str) -> DataFrame:
    """Sum of the values ranked 1..k per group; ties at rank k all count."""
    ranked = df.select(group, c).withColumn("_rk", windows.rank_desc([group], c))
    return top_rows(ranked, "_rk", k).groupBy(group).agg(F.sum(c).alias(name))


def _with_slice(df: DataFrame, name: str, value: str, cuts: str, slices: int) -> DataFrame:
    """Adds the slice of ``value`` as ``name``: twice the number of ascending ``cuts`` above it, and one if it is a cut; -1 for NULL."""
    step = 1 << ((slices - 1).bit_length() - 1) if slices > 1 else 0
    df = df.withColumn(name, F.lit(0))  # cuts at or below the value, by halving
    while step:
        df = df.withColumn(name, F.col(name) + F.when(F.get(cuts, F.col(name) + (step - 1)) <= F.col(value), step).otherwise(0))
        step //= 2
    is_cut = F.coalesce(F.get(cuts, F.col(name) - 1) == F.col(value), F.lit(False)).cast("int")
    return df.withColumn(name, F.when(F.col(value).isNull(), -1).otherwise(2 * (slices - 1 - F.col(name)) + is_cut))


def rank_in_slices(df: DataFrame, group: str, ranks: Mapping[str, str], keys: Sequence[str], slices: int = 64) -> DataFrame:
    """``windows.rank_desc`` of the columns ``{name: column}`` in a group of any size.

    Quantiles cut a group's values into slices, of which each is ranked on its own; the rows of the slices above
    are added. A value that is a quantile itself, as any frequent one is, and NULL are slices of one rank, so they
    can be dealt out by ``keys``, which tell rows apart. Ties and NULL order are those of ``rank_desc``. ``df`` is
    written once; per group only the cuts and one offset per slice are kept. Rows meet them before they are shuffled
    and carry two whole numbers per rank from there.
    """
    rows = store(df, "unranked")
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    cuts = rows.groupBy(F.col(group).alias("_of")).agg(*[F.percentile_approx(c, shares).alias(f"_cuts_{name}") for name, c in ranks.items()])
    cuts = store(cuts, "cuts")

    cut_rows = rows.join(cuts, rows[group].eqNullSafe(cuts["_of"]))
    offsets = []
    for name, c in ranks.items():
        sizes = _with_slice(cut_rows, "_slice", c, f"_cuts_{name}", slices).groupBy("_of", "_slice").agg(F.count(F.lit(1)).alias("_n"))
        before = F.sum("_n").over(windows.by(["_of"], F.col("_slice")).rowsBetween(Window.unboundedPreceding, -1))
        before = sizes.withColumn("_before", F.coalesce(before, F.lit(0)).cast("int"))
        offsets.append(before.groupBy("_of").agg(F.map_from_entries(F.collect_list(F.struct("_slice", "_before"))).alias(f"_before_{name}")))
    per_group = reduce(lambda left, right: left.join(right.withColumnRenamed("_of", "_of2"), F.col("_of").eqNullSafe(F.col("_of2"))).drop("_of2"), [cuts, *offsets])
    per_group = store(per_group, "slices")

    out = rows.join(per_group, rows[group].eqNullSafe(per_group["_of"]))
    for name, c in ranks.items():
        dealt = F.when(F.col("_slice") % 2 == 0, 0).otherwise(F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int"))
        out = _with_slice(out, "_slice", c, f"_cuts_{name}", slices).withColumns({
            f"_before_{name}": F.element_at(f"_before_{name}", F.col("_slice")), f"_part_{name}": F.col("_slice") * slices + dealt})
    out = out.select(*df.columns, *[f"_{of}_{name}" for name in ranks for of in ("before", "part")])
    for name, c in ranks.items():
        local = F.rank().over(windows.by([group, f"_part_{name}"], windows.desc(c)))
        out = out.withColumn(name, F.col(f"_before_{name}") + local).drop(f"_before_{name}", f"_part_{name}")
    return out.select(*df.columns, *ranks)


# --- set operations --------------------------------------------------------------------------------


def merge_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the rows of ``changes`` replacing or joining those of the same key."""
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(changes.select(*target.columns))


def union_grains(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    return daily.unionByName(monthly)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table. Each branch counts on its own; only single rows meet in the union."""
    counted: Iterable[DataFrame] = (
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counted)


# --- retention building blocks ---------------------------------------------------------------------


def monthly_buyers(fact: DataFrame) -> DataFrame:
    """One row per (month, customer). Sales are reduced to these pairs before any shuffle."""
    pairs = fact.select(calendar.month_start(F.col("order_date")).alias("_m"), "customer_id").distinct()
    return pairs.select(calendar.month_key(F.col("_m")).alias("month"), "customer_id")


def retained_buyers(buyers: DataFrame) -> DataFrame:
    """Buyers of a month who also bought in the calendar month before it; input one row per both.

    The months of a customer are compared in order, in place of a self-join: one shuffle, and no
    semi-join that the optimizer could push below the reduction to months.
    """
    before = windows.prev("month", "month", ["customer_id"])
    marked = buyers.filter("customer_id is not null").withColumn("_before", before)
    return marked.filter(F.col("_before") == calendar.prev_month_key(F.col("month"))).drop("_before")
