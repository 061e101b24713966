"""Bounds, packing and search against brute force over whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, query string, tile string"


def brute(rows, every=10, k=5):
    """The contract in plain integers; rows that repeat an id are rows of their own."""
    good = []
    for i, v, label, *_ in rows:
        if label is not None and v is not None and None not in v and np.isfinite(v).all():
            good.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    key = lambda s, i: (-s, i is None, i or 0)
    out = []
    for a, (aid, av, al) in enumerate(good):
        if aid is None or aid % every:
            continue
        scored = sorted(((sum(x * y for x, y in zip(av, v)), i, label) for j, (i, v, label) in enumerate(good) if j != a and len(v) == len(av)), key=lambda t: key(*t[:2]))
        for ps, pid, _ in [t for t in scored if t[2] == al][:k]:
            fit = [t for t in scored if t[2] != al and 80 * ps <= 100 * t[0] <= 100 * ps][:k]
            out += [(aid, pid, r, i, ps, s) for r, (s, i, _) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, every=10):
    out = hn.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0, F.col("label"))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.fixture
def small(monkeypatch):
    for name, value in {"TILE_ROWS": 24, "LEAF": 4, "FANOUT": 3, "BLOCK": 16}.items():
        monkeypatch.setattr(hn, name, value)


def test_boxes_bound_every_inner_product():
    rng = np.random.default_rng(1)
    points = rng.integers(-300, 300, (40, 7))
    anchors = rng.integers(-300, 300, (30, 7))
    least, most = hn.bounds(anchors, points.min(axis=0)[None], points.max(axis=0)[None])
    scores = anchors @ points.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()
    one, same = hn.bounds(anchors, points[:1], points[:1])
    assert (one == scores[:, :1]).all() and (same == one).all()


def test_products_beyond_doubles_are_exact():
    a, b = np.array([[2**26 + 1, 3]]), np.array([[2**27 - 1, 1]])
    assert hn._product(a, b)[0, 0] == (2**26 + 1) * (2**27 - 1) + 3


def test_str_order_fills_whole_leaves():
    rng = np.random.default_rng(2)
    points = rng.integers(0, 50, (101, 5))
    order = hn.str_order(points, 8)
    assert sorted(order.tolist()) == list(range(101))
    volume = lambda at: sum(np.ptp(points[at[i: i + 8], :2], axis=0).sum() for i in range(0, 101, 8))
    assert volume(order) < volume(np.arange(101)) / 1.5  # leaves are tighter than rows as they come
    assert hn.str_order(points[:0], 8).tolist() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_many_tiles_equal_brute_force(spark, small, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 5))
    rows = [(i, (centres[i % 6] + 0.3 * rng.standard_normal(5)).tolist(), int(rng.integers(0, 4)), "r", "q", "t") for i in range(400)]
    tiles = hn.pack(hn.integer_rows(spark.createDataFrame(rows, SCHEMA), F.col("label"), scale=256, id_col="vec_id", vector_col="embedding"))
    sizes = [len(r.rows) for r in tiles.select("rows").collect()]
    assert sum(sizes) == 400 and len(sizes) > 10 and max(sizes) <= 60
    assert mined(spark, rows) == brute(rows)


def test_a_box_at_the_kth_score_is_opened(spark, small):
    """Equal scores everywhere: only ids decide, so nothing may be dropped at equality."""
    rows = [(i, [1.0, 0.0], i % 2, "r", "q", "t") for i in range(200)]
    assert mined(spark, rows, 40) == brute(rows, 40)


def test_odd_rows(spark, small):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(4).tolist(), i % 3, None, None, None) for i in range(60)]
    rows += [(0, [1.0, 2.0, 3.0, 4.0], 1, "r", "q", "t"), (0, [1.0, 2.0, 3.0, 4.0], 1, "r", "q", "t"), (0, [1.0, 2.0, 3.0, 4.0], 2, "r", "q", "t")]
    rows += [(None, [1.0, 2.0, 3.0, 4.0], 1, "", "", ""), (None, [1.0, 2.0, 3.0, 4.0], 2, "", "", "")]
    rows += [(70, None, 1, "", "", ""), (80, [1.0, None, 1.0, 1.0], 1, "", "", ""), (90, [1.0, 2.0, 3.0, 4.0], None, "", "", "")]
    rows += [(100, [float("nan"), 0.0, 0.0, 0.0], 1, "", "", ""), (110, [float("inf"), 0.0, 0.0, 0.0], 1, "", "", "")]
    rows += [(120, [1.0, 1.0], 1, "", "", ""), (121, [1.0, 1.0], 1, "", "", ""), (122, [1.0, 0.9], 2, "", "", "")]  # another length
    rows += [(130, [], 1, "", "", ""), (131, [], 1, "", "", ""), (132, [], 2, "", "", ""), (140, [0.0] * 4, 1, "", "", "")]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows[:0]) == []
    assert mined(spark, rows[60:61]) == []
    huge = rows[:60] + [(200, [1e30, 0.0, 0.0, 0.0], 1, "", "", "")]  # does not fit a long: takes no part
    assert mined(spark, huge) == brute(rows[:60])
