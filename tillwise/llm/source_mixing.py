"""Mixing sources to target weights: tempered token shares realised as budgeted block permutations.

Weights are the sources' token shares to the power of an exponent, normalised. The exponent is bisected
between 0 (all sources equal) and 1 (as they are) until the weights have the wanted entropy, or until no
source is repeated more often than allowed; the largest such exponent-side answer is taken. An entropy below
that of the shares needs an exponent above 1, up to ``_SHARPEST``; one that none of them reaches is an error. One pass over the
source table evaluates the ends of the next ``_HALVINGS`` halvings together, so the table never leaves Spark.

A source's budget is its weight times the total. It is filled block by block: a block is the source's rows in
an order drawn from (seed, block, row), all rows once; the last block is a prefix of its order that fits the
rest of the budget. Running sums inside a block do not sort a source in one task: rows fall into shards by
their place in the order (about the square root of the source's rows each, 256 at least), shards are summed,
and each row adds its place in its shard to the shards before it.

Defined cases: a null source is a source of its own; a null or empty text has no tokens and never uses up
budget, so it is part of every full block; a source without tokens is taken once; rows are told apart by
their content, and rows that are equal in everything may swap places without a visible difference; an empty
table gives an empty result. Columns of the input keep their names; the columns ``block``, ``position`` and
``order_key`` are added under the given prefix, lengthened by ``_`` if the input has those names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.sources.shared import store

_HALVINGS = 5
_ROUNDS = 8
_SHARPEST = 64
_LEAST_SHARD = 256


def count_tokens(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("bigint")


def source_totals(docs: DataFrame, source_col: str, tokens: Column) -> DataFrame:
    """``(source, rows, tokens)`` per source; groups are combined in the map tasks."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("rows"), F.sum(tokens).alias("tokens"))


def temper(totals: DataFrame, *, entropy: float | None = None, max_repeats: float | None = None) -> float:
    """Exponent nearest to 0 that still allows what is asked for.

    ``entropy`` (nats): the flattest mix wanted has this entropy; entropy falls as the exponent grows.
    ``max_repeats``: with the largest source taken once, no source is taken more often than this.
    """
    if (entropy is None) == (max_repeats is None):
        raise ValueError("give either an entropy or a repetition limit")
    if max_repeats is not None and max_repeats < 1:
        raise ValueError("a source is taken once at least")
    filled = totals.filter("tokens > 0").withColumn("s", F.col("tokens").cast("double"))
    ends = filled.agg(F.max("s").alias("most"), F.min("s").alias("least")).first()
    if ends.most is None:
        return 1.0
    share = F.col("s") / ends.most  # the largest stays 1 to any power

    def holds(exponents: list[float]) -> list[bool]:
        if max_repeats is not None:
            return [(ends.most / ends.least) ** (1 - x) <= max_repeats for x in exponents]
        powers = [(F.sum(share ** F.lit(x)), F.sum(share ** F.lit(x) * F.ln(share))) for x in exponents]
        row = filled.agg(*[c.alias(f"c{i}") for i, c in enumerate(c for pair in powers for c in pair)]).first()
        # entropy of p^x / z is ln z - x * sum(p^x ln p) / z
        return [math.log(row[2 * i]) - x * row[2 * i + 1] / row[2 * i] <= entropy for i, x in enumerate(exponents)]

    # the answer lies above low; high is allowed
    ends_tried = [0.0, *(2.0**k for k in range(_SHARPEST.bit_length()))] if entropy is not None else [0.0, 1.0]
    allowed = holds(ends_tried)
    if not any(allowed):
        raise ValueError(f"no exponent up to {_SHARPEST} gives an entropy of {entropy}")
    first = allowed.index(True)
    if first == 0:
        return 0.0
    low, high = ends_tried[first - 1: first + 1]
    for _ in range(_ROUNDS):
        steps = 2**_HALVINGS
        inner = [low + (high - low) * k / steps for k in range(1, steps)]
        allowed = [*holds(inner), True]
        first = allowed.index(True)
        low, high = [low, *inner, high][first: first + 2]
    return round(high, 9)


def plan(totals: DataFrame, exponent: float, budget_tokens: float | None = None) -> DataFrame:
    """``(source, rows, tokens, weight, budget, shards)``; without a total the least repeated source is taken once."""
    s = F.when(F.col("tokens") > 0, F.col("tokens").cast("double"))
    most = totals.agg(F.max("tokens").alias("most")).first().most or 1
    powered = totals.withColumn("powered", (s / F.lit(float(most))) ** F.lit(float(exponent)))
    ends = powered.agg(F.sum("powered").alias("z"), F.max(s / F.col("powered")).alias("widest")).first()
    z = ends.z or 1.0
    total = float(budget_tokens) if budget_tokens is not None else (ends.widest or 0.0) * z
    weight = F.coalesce(F.col("powered") / z, F.lit(0.0))
    return powered.select(
        "source", "rows", "tokens", weight.alias("weight"),
        # a hair above, so that a budget meant to be whole blocks is not one token short
        F.floor(weight * total * (1 + 1e-12) + 1e-6).alias("budget"),
        F.ceil(F.col("rows") / F.greatest(F.lit(float(_LEAST_SHARD)), F.sqrt("rows"))).cast("bigint").alias("shards"),
    )


def _identity(docs: DataFrame, keys: list[str]) -> Column:
    return F.xxhash64(*[docs[k] for k in keys])


def _with_plan(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Each row with its source's plan, its full blocks and the tokens left for the last one."""
    filled = F.col("tokens") > 0
    full = F.when(filled, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(1)).cast("bigint")
    rest = F.when(filled, F.col("budget") - F.col("full") * F.col("tokens")).otherwise(F.lit(0))
    stats = planned.withColumn("full", full).withColumn("rest", rest).drop("rows", "weight").withColumnRenamed("source", "own")
    return rows.join(stats, rows["source"].eqNullSafe(stats["own"])).drop("own")


def _place(seed: int) -> Column:
    """Order of the rows of a block; its upper half, without sign, comes first and also gives the shard."""
    place = F.xxhash64(F.lit(seed), F.col("block").cast("bigint"), F.col("id"))
    return F.struct(F.shiftrightunsigned(place, 32).alias("high"), place.alias("low"), F.col("id").alias("id"))


def _ordered(dealt: DataFrame, seed: int) -> DataFrame:
    """Adds ``place``, tokens up to and with each row, and its position, in the order of its (source, block)."""
    dealt = dealt.withColumn("place", _place(seed))
    dealt = dealt.withColumn("shard", F.floor(F.col("place.high") * F.col("shards") / F.lit(2.0**32)))
    group = ["source", "block", "shard"]
    sums = dealt.groupBy(*group).agg(F.sum("n").alias("shard_n"), F.count(F.lit(1)).alias("shard_rows"))
    before = Window.partitionBy("source", "block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = store(sums.select(
        *[F.col(g).alias(f"s_{g}") for g in group],
        F.coalesce(F.sum("shard_n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("shard_rows").over(before), F.lit(0)).alias("rows_before"),
    ), "offsets")
    order = Window.partitionBy(*group).orderBy("place")
    # rows of equal place are taken together or not at all
    placed = dealt.withColumn("upto", F.sum("n").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("at", F.row_number().over(order))
    same = placed["source"].eqNullSafe(offsets["s_source"]) & (placed["block"] == offsets["s_block"]) & (placed["shard"] == offsets["s_shard"])
    return placed.join(offsets, same).withColumn("upto", F.col("n_before") + F.col("upto")).withColumn("position", F.col("rows_before") + F.col("at"))


def realise(
    docs: DataFrame, planned: DataFrame, *, source_col: str, tokens: Column, keys: list[str], seed: int = 0, prefix: str = "mix_"
) -> DataFrame:
    """Rows of ``docs``, each as often as the budgets take it, with block, position in the block and order key.

    ``keys`` tell rows apart. ``order_key`` in [0, 1] merges all sources: sorted by it, every stretch of the
    result has about the target weights. All columns of ``docs`` are shuffled: give it narrow rows.
    """
    columns = docs.columns
    while any(prefix + name in columns for name in ("block", "position", "order_key")):
        prefix += "_"
    row = F.struct(*[docs[c] for c in columns]).alias("row")
    rows = _with_plan(docs.select(row, docs[source_col].alias("source"), tokens.alias("n"), _identity(docs, keys).alias("id")), planned)
    blocks = F.when(F.col("rest") > 0, F.col("full") + 1).otherwise(F.col("full"))
    dealt = rows.filter(blocks > 0).withColumn("block", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
    ordered = _ordered(dealt, seed)
    kept = ordered.filter((F.col("block") < F.col("full")) | (F.col("upto") <= F.col("rest")))
    used = F.col("block") * F.col("tokens") + F.col("upto") - F.col("n") * 0.5
    return kept.select(
        *[F.col("row")[c].alias(c) for c in columns],
        F.col("block").cast("bigint").alias(f"{prefix}block"), F.col("position").alias(f"{prefix}position"),
        F.when(F.col("budget") > 0, F.least(used / F.col("budget"), F.lit(1.0))).otherwise(F.lit(0.0)).alias(f"{prefix}order_key"),
    )


def narrow(docs: DataFrame, *, source_col: str, tokens: Column, keys: list[str]) -> DataFrame:
    """``(source, id, n)`` of every row, stored: tokens are counted once."""
    return store(docs.select(docs[source_col].alias("source"), _identity(docs, keys).alias("id"), tokens.alias("n")), "counted")


def repeat_rows(docs: DataFrame, counted: DataFrame, planned: DataFrame, *, source_col: str, keys: list[str], seed: int = 0) -> DataFrame:
    """The rows that ``realise`` takes, without places and with all columns, which are not shuffled.

    Only the last block of a source leaves rows out: those beyond the place of the last one that fits. That
    place is found on the ``narrow`` rows; one row per source then decides in the scan of ``docs``.
    """
    own = [docs[source_col].alias("source"), _identity(docs, keys).alias("id")]
    last = _with_plan(counted, planned).filter("rest > 0").withColumn("block", F.col("full"))
    fitting = _ordered(last, seed).filter(F.col("upto") <= F.col("rest"))
    ends = store(fitting.groupBy(F.col("source").alias("end_source")).agg(F.max("place").alias("end")), "ends")
    ended = planned.join(ends, planned["source"].eqNullSafe(ends["end_source"]), "left").drop("end_source")
    rows = _with_plan(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *own), ended).withColumn("block", F.col("full"))
    times = F.col("full") + F.coalesce(_place(seed) <= F.col("end"), F.lit(False)).cast("bigint")
    taken = rows.withColumn("times", times).filter("times > 0").withColumn("time", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))))
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def mix_plan(docs: DataFrame, *, source_col: str, tokens: Column, entropy: float | None = None, max_repeats: float | None = None, budget_tokens: float | None = None) -> DataFrame:
    """Totals, exponent and budgets in one call."""
    totals = store(source_totals(docs, source_col, tokens), "sources")
    return plan(totals, temper(totals, entropy=entropy, max_repeats=max_repeats), budget_tokens)


def mix(
    docs: DataFrame, *, source_col: str = "source", tokens: Column | None = None, keys: list[str], seed: int = 0, prefix: str = "mix_", **goal,
) -> DataFrame:
    """Plan and realise; ``goal`` is for ``mix_plan``. ``docs`` is read several times: it should be a stored table."""
    tokens = count_tokens(F.col("text")) if tokens is None else tokens
    planned = mix_plan(docs, source_col=source_col, tokens=tokens, **goal)
    return realise(docs, planned, source_col=source_col, tokens=tokens, keys=keys, seed=seed, prefix=prefix)


def mix_whole_rows(docs: DataFrame, *, source_col: str = "source", tokens: Column | None = None, keys: list[str], seed: int = 0, **goal) -> DataFrame:
    """As ``mix``, without places: the rows with all their columns, repeated, for tables with long texts."""
    tokens = count_tokens(F.col("text")) if tokens is None else tokens
    counted = narrow(docs, source_col=source_col, tokens=tokens, keys=keys)
    planned = mix_plan(counted, source_col="source", tokens=F.col("n"), **goal)
    return repeat_rows(docs, counted, planned, source_col=source_col, keys=keys, seed=seed)
