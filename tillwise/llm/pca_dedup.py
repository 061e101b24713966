"""Near-duplicate vectors by tiles of vectors in principal-component order.

All vectors are made unit length and turned by one orthogonal matrix: the principal directions of the vectors
about the means of their labels, widest first. A rotation changes no cosine. Inside a label the first rotated
coordinate orders the vectors; a histogram of it cuts blocks of about ``BLOCK`` vectors, and bins that hold
more are split by id. Two blocks can hold a link only if their ranges of that coordinate come within the
distance that the threshold allows, so other tiles are not made.

In a tile the products of the leading coordinates are added up first. What the remaining ones can still add
is bounded by the product of the two suffix norms; pairs whose bound falls below the threshold are dropped,
and a tile without pairs left stops. The pairs that reach the last coordinate are decided on the original
vectors in double precision. A tile gives, per vector, the number of its links and one edge towards a vector
it is linked with: enough for counts and components, and never the pairs of a large group.

Defined cases: every row is a vector of its own, also one that repeats another or its id; rows are numbered in the
order of their ids, nulls last, so that the smallest row of a component has its smallest id; a component of null ids
only has a null id and all its rows are kept. Vectors that are null, empty, zero or hold a null or non-finite component, and vectors of a null label, link
with nothing. Vectors of different lengths are never linked; each length has its own rotation. An empty
table gives an empty result; other columns are ignored. ``vec_id``, ``label`` and ``embedding`` are parameters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillwise.llm.components import components
from tillwise.sources.shared import store

THRESHOLD = 0.98
BLOCK = 1024
_BINS = 1 << 10
_STEPS = (8, 16, 32, 48)
_SLACK = 1e-9
_PAIRS_AT_ONCE = 1 << 16


def usable(vector: Column) -> Column:
    """True for vectors with a direction: not null, only finite components, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def numbered_vectors(vectors: DataFrame, id_col: str, vector_col: str, *others: str) -> DataFrame:
    """``(row, vec_id, vector, *others)`` of every row, components as doubles, rows numbered by id; stored."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), *others)
    order = [F.col("vec_id").asc_nulls_last(), F.xxhash64("vector")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(ordered.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "vector", *others), "vectors")


def stack(column: pa.Array) -> np.ndarray:
    """Matrix of a column of equally long lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that very large or small components do no harm."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per vector length: n and the sums and products of unit vectors of a task, as one long vector."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        lengths = np.array(batch.column(0).value_lengths())
        for dim in set(lengths.tolist()):
            x = unit(stack(batch.column(0).filter(pa.array(lengths == dim))))
            x = np.hstack([np.ones((len(x), 1)), x])
            sums[dim] = sums.get(dim, 0) + x.T @ x
    for dim, total in sums.items():
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(flat), dim), pa.int32()), pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["dim", "cell", "v"]
        )


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Orthogonal matrix per vector length, columns by falling variance. Sums of outer products, made in the tasks."""
    sums = vectors.select("vector").mapInArrow(_moments, "dim int, cell int, v double").groupBy("dim", "cell").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    turned = {}
    for dim, cells in sums.groupby("dim"):
        moments = np.zeros((dim + 1) ** 2)
        moments[cells["cell"]] = cells["v"]
        moments = moments.reshape(dim + 1, dim + 1)
        n, mean = moments[0, 0], moments[0, 1:] / moments[0, 0]
        covariance = np.round(moments[1:, 1:] / n - np.outer(mean, mean), 10)
        turned[int(dim)] = np.linalg.eigh(covariance)[1][:, ::-1].copy()
    return turned


def _found(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of links between rotated unit vectors ``a`` and ``b`` (each pair once if they are the same block)."""
    dim = a.shape[1]
    ends = [*[s for s in _STEPS if s < dim], dim]
    square = lambda m: np.cumsum((m**2)[:, ::-1], axis=1)[:, ::-1]
    rest_a, rest_b = (np.sqrt(np.hstack([square(m), np.zeros((len(m), 1))])) for m in (a, b))
    products, start, left = np.zeros((len(a), len(b))), 0, None
    for end in ends:
        if left is None:
            products += a[:, start:end] @ b[:, start:end].T
            alive = products + rest_a[:, end, None] * rest_b[None, :, end] >= threshold - _SLACK
            if same:
                alive &= np.tri(len(a), k=-1, dtype=bool).T
            if not alive.any():
                return np.empty(0, int), np.empty(0, int)
            if alive.mean() < 0.02:  # few pairs: follow them one by one
                left = alive.nonzero()
                partial = products[left]
        else:
            i, j = left
            for at in range(0, len(i), _PAIRS_AT_ONCE):
                part = slice(at, at + _PAIRS_AT_ONCE)
                partial[part] += np.einsum("nd,nd->n", a[i[part], start:end], b[j[part], start:end])
            keep = partial + rest_a[i, end] * rest_b[j, end] >= threshold - _SLACK
            left, partial = (i[keep], j[keep]), partial[keep]
            if not len(left[0]):
                return left
        start = end
    i, j = left if left is not None else alive.nonzero()
    linked = np.empty(len(i), bool)
    for at in range(0, len(i), _PAIRS_AT_ONCE):
        part = slice(at, at + _PAIRS_AT_ONCE)
        x, y = raw_a[i[part]], raw_b[j[part]]
        linked[part] = np.einsum("nd,nd->n", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)) >= threshold
    return i[linked], j[linked]


def _scaled(matrix: np.ndarray) -> np.ndarray:
    """As given, unless squares would overflow or vanish."""
    most = np.abs(matrix).max(axis=1, keepdims=True)
    return np.where((most > 1e100) | (most < 1e-100), matrix / most, matrix)


def tile_links(ids: np.ndarray, vectors: np.ndarray, left: np.ndarray, same: bool, rotation: np.ndarray, threshold: float) -> tuple:
    """(id, links, neighbour) of every vector of a tile with a link; neighbours connect all that links connect."""
    raw = _scaled(vectors)
    turned = unit(raw) @ rotation
    first = np.arange(len(ids)) if same else left.nonzero()[0]
    second = first if same else (~left).nonzero()[0]
    i, j = _found(turned[first], turned[second], raw[first], raw[second], same, threshold)
    i, j = first[i], second[j]
    links = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
    root = np.arange(len(ids))
    while True:  # smallest place reachable inside the tile
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            break
    touched = links.nonzero()[0]
    return ids[touched], links[touched], ids[root[touched]]


_SCHEMA = T.StructType().add("row", "long").add("links", "long").add("neighbour", "long")


def near_duplicates(
    vectors: DataFrame, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", threshold: float = THRESHOLD,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row; links need equal labels and cosine >= threshold."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    spark = vectors.sparkSession
    label = "label"
    every = numbered_vectors(vectors.select(id_col, vector_col, F.col(label_col).alias(label)), id_col, vector_col, label)
    valid = every.filter(F.col(label).isNotNull() & usable(F.col("vector")))
    turned = rotations(valid)
    shipped = spark.sparkContext.broadcast(turned)

    def lead(batches):
        for batch in batches:
            lengths = np.array(batch.column(1).value_lengths())
            first = np.zeros(len(lengths))
            for dim in set(lengths.tolist()):
                own = lengths == dim
                first[own] = unit(stack(batch.column(1).filter(pa.array(own)))) @ shipped.value[dim][:, 0]
            bins = np.clip(np.floor((first + 1) * (_BINS / 2)), 0, _BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(lengths, pa.int32()), pa.array(bins)], ["row", "vector", "label", "dim", "bin"])

    schema = T.StructType([valid.schema["row"], valid.schema["vector"], valid.schema[label]]).add("dim", "integer").add("bin", "integer")
    placed = store(valid.select("row", "vector", label).mapInArrow(lead, schema), "placed")

    # histogram of the first coordinate -> blocks; at most _BINS rows per label
    group = [label, "dim"]
    sizes = placed.groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = sizes.withColumn("cut", F.floor(F.coalesce(so_far, F.lit(0)) / BLOCK)).withColumn("parts", F.ceil(F.col("n") / BLOCK))
    # a bin that fills blocks by itself is a cut of its own, divided into parts
    bins = store(bins.withColumn("own_bin", F.when(F.col("parts") > 1, F.col("bin")).otherwise(F.lit(-1))), "bins")
    cuts = bins.groupBy(*group, "cut", "own_bin").agg(F.min("bin").alias("lo"), F.max("bin").alias("hi"), F.max("parts").alias("parts"))
    cuts = cuts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    block = F.struct("cut", "own_bin", "part")
    blocks = store(cuts.select(*group, block.alias("block"), "lo", "hi"), "blocks")
    # unit vectors with this cosine are at most so far apart, in any coordinate
    reach = math.ceil(math.sqrt(max(2 - 2 * threshold, 0)) * _BINS / 2) + 1
    a, b = blocks.alias("a"), blocks.alias("b")
    meet = [F.col(f"a.{g}") == F.col(f"b.{g}") for g in group]
    near = (F.col("a.block") <= F.col("b.block")) & (F.col("a.lo") - F.col("b.hi") <= reach) & (F.col("b.lo") - F.col("a.hi") <= reach)
    tiles = a.join(b, [*meet, near]).select(
        *[F.col(f"a.{g}").alias(g) for g in group], F.col("a.block").alias("first"), F.col("b.block").alias("second"),
    )
    sides = F.when(F.col("first") == F.col("second"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    halves = tiles.withColumn("side", F.explode(sides)).withColumn("block", F.when(F.col("side") == 0, F.col("first")).otherwise(F.col("second")))

    cells = bins.select(*group, "bin", "cut", "own_bin", "parts")
    members = placed.join(cells, [*group, "bin"]).withColumn(
        "block", F.struct("cut", "own_bin", F.pmod(F.xxhash64("row"), F.col("parts")).alias("part"))
    )
    dealt = members.select(*group, "block", "row", "vector").join(halves, [*group, "block"])

    def compare(key, table):
        ids = table["row"].to_numpy()
        order = np.argsort(ids, kind="stable")
        left = table["side"].to_numpy()[order] == 0
        matrix = stack(table["vector"])[order]
        first, second = key[2].as_py(), key[3].as_py()
        found = tile_links(ids[order], matrix, left, first == second, shipped.value[key[1].as_py()], threshold)
        return pa.table({"row": found[0], "links": found[1].astype(np.int64), "neighbour": found[2]})

    links = store(dealt.groupBy(*group, "first", "second").applyInArrow(compare, _SCHEMA), "links")
    counts = links.groupBy("row").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("row").alias("a"), F.col("neighbour").alias("b")))
    linked = counts.join(roots, F.col("row") == F.col("node"), "left").select("row", "links", "root")
    names = every.select(F.col("row").alias("root"), F.col("vec_id").alias("component_id"))
    linked = linked.join(names, "root").select("row", "links", "component_id", F.lit(True).alias("found"))
    out = every.select("row", "vec_id").join(linked, "row", "left")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )
