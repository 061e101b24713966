"""Hard negatives by best-first search of an R-tree packed by sort-tile-recursive (STR).

Vectors become integers, ``floor(scale * x)``, and a score is the integer inner product. An anchor's positives are
its ``k`` best other rows of the same label; per positive the negatives are the ``k`` best rows of other labels
whose score lies between two percentages of the positive's.

Packing, in Spark: rows are cut into slabs by quantiles of the label, each slab by quantiles of the coordinate
of largest variance, those by the next one, until tiles hold about ``TILE_BYTES`` of cells. A tile that equal
rows overfill is dealt out by row number, so no tile grows with the number of copies. Inside a tile the rows are
packed the same way into leaves, and leaves into nodes. Tiles are rows of a stored table; every node has its
bounding box over label and coordinates.

Search: a box bounds every inner product with an anchor, coordinate by coordinate: the larger (smaller) of the
anchor's component times the two sides, added up. The tile of the highest bound is searched first and gives a
score for the ``k``-th place; after it only tiles that can still reach that place inside the window. In a tile a
queue opens the node of the highest bound; nodes outside the windows, of labels that don't matter, or strictly
below the ``k``-th score are dropped. All anchors meet all tile boxes in blocks of ``BLOCK`` by ``BLOCK``.

Results are exact: products are float64 only while every partial sum is a whole number below 2**53, else int64.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part, nor do
vectors whose squared integer components add up to more than 2**55, as scores times 100 would not fit a long;
an empty vector scores 0 with another empty one; vectors of different lengths are not compared; repeated rows
are rows of their own, and another row with the anchor's id is an "other row"; a null id is no anchor, and comes
last among ties; an anchor without positives, or a positive without negatives, returns nothing; an empty table
gives an empty result; other columns are ignored, and clashing names do no harm.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.sources.shared import store

TILE_BYTES = 1 << 20
TILE_ROWS = 2048
AXES = 3
LEAF = 64
FANOUT = 8
BLOCK = 1024
_MOST = float(1 << 55)
_FAR = 1 << 60
_LAST = (1 << 63) - 1


def integer_rows(vectors: DataFrame, label: Column, *, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``(row, vec_id, label, cells, dim)`` of the rows that take part; ``row`` numbers them, stored."""
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), vector.alias("vector"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    cells = F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))))
    rows = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite).select("vec_id", "label", cells.alias("cells"))
    length = F.aggregate("cells", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.filter(length <= F.lit(_MOST)).withColumn("dim", F.size("cells"))
    return store(rows.withColumn("row", F.monotonically_increasing_id()), "rows")


# --- packing ---------------------------------------------------------------------------------------


def _axes(rows: DataFrame) -> DataFrame:
    """``(dim, axes)``: positions of the coordinates of largest variance, for each length of vectors."""
    spread = rows.select("dim", F.posexplode("cells").alias("pos", "x")).groupBy("dim", "pos").agg(F.var_pop("x").alias("v"))
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("v"), "pos"))
    few = spread.withColumn("place", place).filter(F.col("place") < AXES)
    return few.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("place", "pos")))["pos"].alias("axes"))


def _room() -> Column:
    """Rows of a tile."""
    return F.least(F.lit(TILE_ROWS), F.greatest(F.lit(LEAF), F.floor(F.lit(TILE_BYTES) / (8 * F.greatest("dim", F.lit(1)))))).cast("bigint")


def tiled(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of their tile: quantile cuts along label and widest coordinates, then by row number."""
    wanted = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.ceil(F.col("n") / _room()))).first()[0] or 1
    slabs = math.ceil(wanted ** (1 / AXES))
    out = rows.join(store(_axes(rows), "axes"), "dim", "left").withColumn("tile", F.lit(0).cast("bigint"))
    for axis in range(AXES if slabs > 1 else 0):
        x = F.col("label") if axis == 0 else F.coalesce(F.try_element_at("cells", F.try_element_at("axes", F.lit(axis)) + 1), F.lit(0))
        shares = F.array(*[F.lit(i / slabs) for i in range(1, slabs)])
        cuts = store(out.groupBy("dim", "tile").agg(F.percentile_approx(x, shares).alias("cuts")), "cuts")
        along = F.size(F.filter("cuts", lambda c: x > c))
        out = out.join(cuts, ["dim", "tile"]).withColumn("tile", F.col("tile") * slabs + along).drop("cuts")
    sizes = store(out.groupBy("dim", "tile").agg(F.ceil(F.count(F.lit(1)) / F.max(_room())).alias("parts")), "sizes")
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    return out.join(sizes, ["dim", "tile"]).withColumn("tile", F.col("tile") * (1 << 24) + part).drop("parts", "axes")


def str_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Order of points in which every ``leaf`` consecutive ones are a leaf: sorted and cut along axis after axis.

    The first column is the first axis, then those of largest variance.
    """
    if not len(points):
        return np.arange(0)
    wide = np.argsort(-points[:, 1:].var(axis=0), kind="stable")[: AXES - 1] + 1

    def cut(at: np.ndarray, axes: list[int]) -> list[np.ndarray]:
        if len(at) <= leaf or not axes:
            return [at]
        slabs = math.ceil((len(at) / leaf) ** (1 / len(axes)))
        size = math.ceil(len(at) / slabs / leaf) * leaf
        at = at[np.argsort(points[at, axes[0]], kind="stable")]
        return [part for start in range(0, len(at), size) for part in cut(at[start: start + size], axes[1:])]

    return np.concatenate(cut(np.arange(len(points)), [0, *wide.tolist()]))


_TILE = (
    "dim int, tile bigint, lo array<bigint>, hi array<bigint>, rows array<bigint>, ids array<bigint>, labels array<bigint>, cells array<bigint>"
)


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    flat = table.column("cells").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(table.num_rows, dim)


def _pack_tile(key, table):
    """A tile as one row: box over (label, coordinates), and its rows in leaf order."""
    dim, tile = (k.as_py() for k in key)
    points = np.column_stack([table.column("label").to_numpy(), _matrix(table, dim)])
    order = str_order(points, LEAF)
    points = points[order]
    one = lambda a: pa.array([a], pa.list_(pa.int64()))
    ids = table.column("vec_id").combine_chunks().take(pa.array(order)).to_pylist()
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "tile": pa.array([tile], pa.int64()), "lo": one(points.min(axis=0)), "hi": one(points.max(axis=0)),
        "rows": one(table.column("row").to_numpy()[order]), "ids": one(ids), "labels": one(points[:, 0]), "cells": one(points[:, 1:].ravel()),
    })


def pack(rows: DataFrame) -> DataFrame:
    """The tiles of ``integer_rows``, stored: one row each, with box and rows in leaf order."""
    members = tiled(rows).select("dim", "tile", "row", "vec_id", "label", "cells")
    return store(members.groupBy("dim", "tile").applyInArrow(_pack_tile, _TILE), "tiles")


# --- search ----------------------------------------------------------------------------------------


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with any point of each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _product(up, lo) + _product(down, hi), _product(up, hi) + _product(down, lo)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of whole numbers."""
    most = lambda m: float(np.abs(m).max(initial=0))
    if most(a) * most(b) * max(a.shape[1], 1) < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


class Tree:
    """Nodes of one tile, root first in ``levels``; leaves are ``LEAF`` consecutive rows."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray):
        self.rows, self.ids, self.labels, self.cells = rows, ids, labels, cells
        points = np.column_stack([labels, cells])
        lo = hi = points
        self.levels = []
        width = LEAF
        while not self.levels or len(lo) > 1:
            starts = np.arange(0, len(lo), width)
            lo, hi = np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts)
            self.levels.insert(0, (lo, hi))
            width = FANOUT

    def search(self, queries: pa.Table, anchors: np.ndarray, k: int, same: bool) -> list[tuple]:
        """``(query, win, vec_id, row, score)`` of the ``k`` best of each window of each query."""
        below = [bounds(anchors, lo[:, 1:], hi[:, 1:]) for lo, hi in self.levels]
        out = []
        own, wins = queries.column("query").to_pylist(), queries.column("wins").to_pylist()
        for q, label in enumerate(queries.column("label").to_pylist()):
            out += self._best_first(own[q], label, anchors[q], wins[q], [(a[q], b[q]) for a, b in below], k, same)
        return out

    def _best_first(self, own: int, label: int, anchor: np.ndarray, wins: list[dict], bound: list, k: int, same: bool) -> list[tuple]:
        found: list[list] = [[] for _ in wins]  # heaps, the worst first
        low, high = [max(w["lo"], w["least"]) for w in wins], [w["hi"] for w in wins]

        def useful(level: int, node: int) -> bool:
            lo, hi = self.levels[level][0][node, 0], self.levels[level][1][node, 0]
            if not lo <= label <= hi if same else lo == label == hi:
                return False
            least, most = bound[level][0][node], bound[level][1][node]
            return any(most >= a and least <= b for a, b in zip(low, high))

        queue = [(-int(bound[0][1][0]), 0, 0)]
        while queue:
            _, level, node = heapq.heappop(queue)
            if not useful(level, node):  # the k-th score may have risen since it was queued
                continue
            if level + 1 < len(self.levels):
                for child in range(node * FANOUT, min((node + 1) * FANOUT, len(bound[level + 1][1]))):
                    if useful(level + 1, child):
                        heapq.heappush(queue, (-int(bound[level + 1][1][child]), level + 1, child))
                continue
            at = slice(node * LEAF, (node + 1) * LEAF)
            scores = _product(anchor[None, :], self.cells[at])[0]
            fits = (self.labels[at] == label) == same
            fits &= self.rows[at] != own
            for w, heap in enumerate(found):
                for i in ((scores >= low[w]) & (scores <= high[w]) & fits).nonzero()[0].tolist():
                    entry = (int(scores[i]), -int(self.ids[at][i]), int(self.rows[at][i]))
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                if len(heap) == k:
                    low[w] = max(low[w], heap[0][0])
        return [(own, win["win"], -minus, row, score) for win, heap in zip(wins, found) for score, minus, row in heap]


_HIT = "query bigint, win int, vec_id bigint, row bigint, score bigint"
_WINS = "array<struct<win:int,lo:bigint,hi:bigint,least:bigint>>"


def _search_tile(k: int, same: bool):
    def run(key, queries, tiles):
        dim, found = key[0].as_py(), []
        for i in range(tiles.num_rows if queries.num_rows else 0):
            flat = {c: tiles.column(c).slice(i, 1).combine_chunks().flatten() for c in ("rows", "ids", "labels", "cells")}
            ids = flat.pop("ids").fill_null(_LAST).to_numpy()
            part = {c: v.to_numpy(zero_copy_only=False).astype(np.int64) for c, v in flat.items()}
            tree = Tree(part["rows"], ids, part["labels"], part["cells"].reshape(len(ids), dim))
            found += tree.search(queries, _matrix(queries, dim), k, same)
        names = ["query", "win", "vec_id", "row", "score"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, zip(*found) if found else [[]] * 5, types)})

    return run


def _route(same: bool, best_only: bool):
    """Tiles of a chunk that a query of a block has to see, or the one of the highest bound among them."""

    def run(key, queries, boxes):
        dim = key[0].as_py()
        query, tile, most = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if queries.num_rows and boxes.num_rows:
            side = lambda c: boxes.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim + 1)
            lo, hi, names = side("lo"), side("hi"), boxes.column("tile").to_numpy()
            least, best = bounds(_matrix(queries, dim), lo[:, 1:], hi[:, 1:])
            labels, own, wins = queries.column("label").to_numpy(), queries.column("query").to_numpy(), queries.column("wins").to_pylist()
            for q in range(len(own)):
                inside = (lo[:, 0] <= labels[q]) & (labels[q] <= hi[:, 0])
                open_ = inside if same else ~(inside & (lo[:, 0] == hi[:, 0]))
                reach = np.zeros(len(names), bool)
                for w in wins[q]:
                    reach |= (best[q] >= max(w["lo"], w["least"])) & (least[q] <= w["hi"])
                at = (open_ & reach).nonzero()[0]
                if best_only and len(at):
                    at = at[[best[q][at].argmax()]]
                query.append(np.full(len(at), own[q]))
                tile.append(names[at])
                most.append(best[q][at])
        return pa.table({"query": np.concatenate(query), "tile": np.concatenate(tile), "most": np.concatenate(most)})

    return run


def search(tiles: DataFrame, queries: DataFrame, *, k: int, same: bool) -> DataFrame:
    """``(query, win, rank, vec_id, row, score)``: the ``k`` best rows per window of each query.

    ``tiles`` is what ``pack`` gives. ``queries`` has ``query`` (a row number), ``dim``, ``label``, ``cells`` and
    ``wins``, an array of (win, lo, hi, least) with inclusive score limits; ``least`` is a score that need not be
    undercut. Rows of the query's label are looked at if ``same``, else those of all other labels.
    """
    blocks, chunks = (max(1, math.ceil(df.count() / BLOCK)) for df in (queries, tiles))
    queries = store(queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")), "queries")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    boxes = tiles.select("dim", "tile", "lo", "hi", F.pmod(F.xxhash64("tile"), F.lit(chunks)).cast("int").alias("chunk"))

    def routes(asking: DataFrame, best_only: bool) -> DataFrame:
        group = ["dim", "block", "chunk"]
        left = asking.withColumn("chunk", every(chunks)).groupBy(*group)
        right = boxes.withColumn("block", every(blocks)).groupBy(*group)
        return left.cogroup(right).applyInArrow(_route(same, best_only), "query bigint, tile bigint, most bigint")

    def look(asking: DataFrame, pairs: DataFrame) -> DataFrame:
        group = ["dim", "tile", "block"]
        sent = pairs.select("query", "tile").join(asking, "query")
        held = sent.select(*group).distinct().join(tiles.drop("lo", "hi"), ["dim", "tile"])
        held = held.select(*[F.col(c).alias(f"of_{c}") if c in group else c for c in held.columns])
        return sent.groupBy(*group).cogroup(held.groupBy(*[f"of_{c}" for c in group])).applyInArrow(_search_tile(k, same), _HIT)

    first = store(routes(queries, True).groupBy("query").agg(F.max_by("tile", F.struct("most", "tile")).alias("tile")), "first")
    early = store(look(queries, first), "early")
    kth = early.groupBy("query", "win").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score")).filter(F.col("n") == k)
    wins = queries.select("query", F.explode("wins").alias("w")).select("query", "w.*").join(kth, ["query", "win"], "left")
    risen = wins.select("query", F.struct("win", "lo", "hi", F.greatest("least", "score").alias("least")).alias("w")).groupBy("query").agg(F.collect_list("w").alias("wins"))
    asking = store(queries.drop("wins").join(risen, "query"), "asking")
    rest = store(routes(asking, False).join(first.select("query", "tile"), ["query", "tile"], "left_anti"), "routes")
    order = Window.partitionBy("query", "win").orderBy(F.desc("score"), "vec_id", "row")
    hits = early.union(look(asking, rest)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return hits.select("query", "win", "rank", F.nullif("vec_id", F.lit(_LAST)).alias("vec_id"), "row", "score")


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, *, k: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on ``vec_id``, ``label`` an expression on the columns of ``vectors``. Negatives
    score from ``low`` to ``high`` percent of the positive, limits included.
    """
    rows = integer_rows(vectors, label, scale=scale, id_col=id_col, vector_col=vector_col)
    tiles = pack(rows)
    anchors = store(rows.filter(F.coalesce(is_anchor, F.lit(False))).withColumnRenamed("row", "query"), "anchors")
    whole = F.array(F.struct(F.lit(0).alias("win"), F.lit(-_FAR).alias("lo"), F.lit(_FAR).alias("hi"), F.lit(-_FAR).alias("least")))
    asked = anchors.select("query", "dim", "label", "cells", whole.cast(_WINS).alias("wins"))
    found = search(tiles, asked, k=k, same=True)
    positives = store(found.select("query", F.col("rank").alias("win"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    score = F.col("positive_score")
    down = lambda x: (x - F.pmod(x, F.lit(100))) / 100
    limits = positives.select("query", "win", (-down(-score * low)).cast("bigint").alias("lo"), down(score * high).cast("bigint").alias("hi"))
    limits = limits.filter("lo <= hi").withColumn("least", F.col("lo"))
    wins = limits.groupBy("query").agg(F.collect_list(F.struct("win", "lo", "hi", "least")).alias("wins"))
    asked = anchors.join(wins, "query").select("query", "dim", "label", "cells", "wins")
    negatives = search(tiles, asked, k=k, same=False)
    return (
        negatives.join(positives, ["query", "win"]).join(anchors.select("query", F.col("vec_id").alias("anchor_id")), "query")
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
