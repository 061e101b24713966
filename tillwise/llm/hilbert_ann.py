"""Approximate nearest neighbours by several shifted Hilbert orderings.

The vectors, made unit length, are turned by one random rotation. Curve ``c`` takes ``DIMS`` of the rotated
coordinates, shifts them by an offset of its own, and numbers the cells of a grid along a Hilbert curve. Spark
range-partitions all vectors by (curve, key), and a row's place in its partition plus the rows of the
partitions before gives its rank, without any sort in one task. Ranks are cut into blocks of ``BLOCK`` rows; a query
is sent to every block that its window touches, on each curve, and is compared there with the block's rows by
one matrix product. The best of all blocks are merged and ranked again by exact cosine in double precision.

The window reaches ``share`` of all rows to either side, rounded up to whole blocks. A sample of ``SAMPLE`` components
gives every query first neighbours, and blocks return only what is no worse than the last of those. Blocks hold unit vectors in
single precision; the few best of each are ranked again by the original ones. Equal vectors are one entry that
carries its smallest ids, so that copies, however many, neither fill a window nor decide a tie by chance.

Vectors without structure need a fixed share of the rows for a fixed recall, at every size, so that searching costs
no less than in proportion to exact search (the README has comparisons and recall by size); on clustered vectors a
smaller share does.

Defined cases: rows that repeat id and vector count once; a row that repeats an id with another vector is a row of its
own, query and candidate alike; vectors that are null, empty, zero or hold a null or non-finite component, vectors
of a null id, and vectors of another length than the query's take no part; ties go to the smaller id; a query with
fewer candidates than asked for gets all of them; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.llm.pca_dedup import stack, unit, usable
from tillwise.sources.shared import store

CURVES = 16
DIMS = 8
BITS = 7
SHARE = 0.025
BLOCK = 256
SAMPLE = 1 << 17  # components of a sample that gives every query a first bound
_SPARE = 4  # places kept beyond those asked for, as blocks compare in single precision
_SEED = 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of grid cells (rows of coordinates below 2**bits); bits x columns <= 63.

    From the highest bit down, a cell's corner of its cube is numbered by Gray code and the cube is turned and
    mirrored into the position of the first one: the higher set bits mirror or swap the lower ones.
    """
    x = cells.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        lower = (1 << bit) - 1
        for axis in x:
            is_set = (axis >> bit & 1).astype(bool)
            swap = np.where(is_set, 0, (x[0] ^ axis) & lower)
            x[0] ^= np.where(is_set, lower, swap)
            axis ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | axis >> bit & 1
    return key


def curve_keys(vectors: np.ndarray, curves: int = CURVES, dims: int = DIMS, bits: int = BITS) -> np.ndarray:
    """Key of each vector on each curve. Rotation and shifts depend on nothing but the vectors' length."""
    width = vectors.shape[1]
    random = np.random.default_rng([_SEED, width])
    keys, turned, at = [], None, width
    for _ in range(curves):
        if at + min(dims, width) > width:  # the coordinates are used up: another rotation
            rotation = np.linalg.qr(random.standard_normal((width, width)))[0]
            turned, at = unit(vectors) @ rotation * np.sqrt(width), 0
        own = turned[:, at: at + dims]
        at += own.shape[1]
        shifted = (own + random.uniform(-0.5, 0.5, own.shape[1]) + 4) / 8  # coordinates of about one standard deviation
        cells = np.clip(np.floor(shifted * (1 << bits)), 0, (1 << bits) - 1)
        keys.append(hilbert_keys(cells, bits))
    return np.stack(keys, axis=1)


def _with_keys(curves: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array(batch.column(1).value_lengths())
            for dim in sorted(set(lengths.tolist())):
                own = batch.filter(pa.array(lengths == dim))
                keys = curve_keys(stack(own.column(1)), curves, min(DIMS, dim))
                n = own.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(own.column(0).to_numpy(), curves)), pa.array(np.full(n * curves, dim), pa.int32()),
                    pa.array(np.tile(np.arange(curves), n), pa.int32()), pa.array(keys.ravel()),
                ], ["rep", "dim", "curve", "key"])

    return run


def _entries(vectors: DataFrame, k: int) -> DataFrame:
    """``(rep, vector, ids)``: each different vector with its ``k`` + 1 smallest ids; rep is the smallest."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = vectors.withColumn("place", place).filter(F.col("place") <= k + 1)  # cut in the map tasks already
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "vector", "ids")


def _ranked(entries: DataFrame, curves: int) -> DataFrame:
    """``(rep, dim, curve, rank)``: rank from 0 by key on each curve. Ranges are sorted, never a whole curve."""
    keyed = entries.select("rep", "vector").mapInArrow(_with_keys(curves), "rep bigint, dim int, curve int, key bigint")
    ordered = keyed.repartitionByRange("dim", "curve", "key", "rep").sortWithinPartitions("dim", "curve", "key", "rep")
    placed = store(ordered.withColumn("at", F.monotonically_increasing_id()), "placed")  # rises along the order
    group = ["dim", "curve"]
    part = F.shiftright("at", 33).alias("part")
    sizes = placed.groupBy(*group, part).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*group, "part", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.withColumn("part", F.shiftright("at", 33)).join(starts, [*group, "part"]).select(
        "rep", *group, (F.col("before") + F.col("at") - F.col("first")).alias("rank")
    )


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = np.array(batch.column(1).value_lengths())
        for dim in sorted(set(lengths.tolist())):
            own = batch.filter(pa.array(lengths == dim))
            flat = unit(stack(own.column(1))).astype(np.float32).ravel()
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dim), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([own.column(0), vectors], ["rep", "unit"])


def _first_bounds(sample: DataFrame, queries: DataFrame, most: int) -> DataFrame:
    """``(query, rep, score)``: the best of a bounded sample for each query, candidates like any other."""
    by_dim: dict[int, list] = {}
    for r in sample.collect():
        by_dim.setdefault(len(r.unit), []).append((r.rep, r.unit))
    held = {dim: (np.array([i for i, _ in rows]), np.array([u for _, u in rows], np.float32)) for dim, rows in by_dim.items()}
    shipped = queries.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array(batch.column(1).value_lengths())
            for dim in sorted(set(lengths.tolist()) & set(shipped.value)):
                reps, matrix = shipped.value[dim]
                own = batch.filter(pa.array(lengths == dim))
                scores = stack(own.column(1)) @ matrix.T
                n = min(most, len(reps))
                best = np.argsort(-scores, axis=1, kind="stable")[:, :n]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(own.column(0).to_numpy(), n)), pa.array(reps[best].ravel()), pa.array(np.take_along_axis(scores, best, 1).ravel()),
                ], ["query", "rep", "score"])

    return queries.mapInArrow(run, "query bigint, rep bigint, score float")


def search(
    vectors: DataFrame, is_query: Column, *, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    curves: int = CURVES, share: float = SHARE,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row with ``is_query``, its ``k`` nearest other rows found.

    ``is_query`` is a condition on ``vec_id``.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    valid = store(rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct(), "vectors")
    entries = store(_entries(valid, k), "entries")
    ranks = store(_ranked(entries, curves), "ranks")
    total = entries.count()
    reach = math.ceil(share * total)
    block = F.floor(F.col("rank") / BLOCK)

    asked = valid.filter(is_query).select("vec_id", "vector")
    query_of = store(asked.join(entries.select("rep", "vector"), "vector").select("vec_id", "rep"), "queries")
    different = query_of.select("rep").distinct()
    units = store(entries.select("rep", "vector").mapInArrow(_units, "rep bigint, unit array<float>"), "units")
    most = k + 1 + _SPARE  # the query itself may be among them
    few = units.orderBy(F.xxhash64("rep"), "rep").limit(max(SAMPLE // max(units.agg(F.max(F.size("unit"))).first()[0] or 1, 1), most))
    early = store(_first_bounds(few, units.join(different, "rep", "left_semi").select(F.col("rep").alias("query"), "unit"), most), "early")
    reached = early.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).filter(F.col("n") == most)
    rows = ranks.join(units, "rep")
    last = F.floor(F.lit(max(total - 1, 0)) / BLOCK)
    touched = F.sequence(F.greatest(F.floor((F.col("rank") - reach) / BLOCK), F.lit(0).cast("bigint")), F.least(F.floor((F.col("rank") + reach) / BLOCK), last))
    sent = rows.join(different, "rep", "left_semi").select("rep", "unit", "dim", "curve", F.explode(touched).alias("block"), F.lit(True).alias("asks"))
    sent = sent.join(reached.select(F.col("query").alias("rep"), "floor"), "rep", "left")
    held = rows.select("rep", "unit", "dim", "curve", block.alias("block"), F.lit(False).alias("asks"), F.lit(None).cast("float").alias("floor"))

    def compare(key, table):
        queries, block_rows = table.filter(table["asks"]), table.filter(pc.invert(table["asks"]))
        if not queries.num_rows or not block_rows.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float32())})
        ids, reps = queries["rep"].to_numpy(), block_rows["rep"].to_numpy()
        floors = queries["floor"].fill_null(-2.0).to_numpy()
        order = np.argsort(reps, kind="stable")
        reps, matrix = reps[order], stack(block_rows["unit"])[order]
        n = min(most, len(reps))
        found = []
        for at in range(0, len(ids), 256):
            scores = stack(queries["unit"].slice(at, 256)) @ matrix.T
            best = np.argsort(-scores, axis=1, kind="stable")[:, :n]  # ties stay in id order
            top = np.take_along_axis(scores, best, 1)
            enough = top >= floors[at: at + 256, None]  # worse ones cannot be among the best
            found.append((np.repeat(ids[at: at + 256], n)[enough.ravel()], reps[best][enough], top[enough]))
        return pa.table(dict(zip(("query", "rep", "score"), map(np.concatenate, zip(*found)))))

    group = ["dim", "curve", "block"]
    hits = sent.unionByName(held).groupBy(*group).applyInArrow(compare, "query bigint, rep bigint, score float")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    merged = hits.union(early).groupBy("query", "rep").agg(F.max("score").alias("score"))
    merged = merged.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= most)

    # original vectors of the few that are left: exact score, then every id that shares the vector
    left, right = entries.select(F.col("rep").alias("query"), F.col("vector").alias("q")), entries.select("rep", "vector", "ids")
    exact = merged.join(left, "query").join(right, "rep").withColumn("score", exact_cosine(F.col("q"), F.col("vector")))
    spread = exact.select("query", F.col("rep").alias("found"), "score", F.explode("ids").alias("vec_id"))
    answered = query_of.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query")).join(spread, "query")
    answered = answered.filter((F.col("query_id") != F.col("vec_id")) | (F.col("query") != F.col("found")))  # not itself
    final = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return answered.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles, terms added in order."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
