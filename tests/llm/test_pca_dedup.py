"""Links, counts and components against all pairs."""

import math

import numpy as np
import pytest

from tillwise.llm import pca_dedup as dedup

SCHEMA = "vec_id bigint, label int, embedding array<float>, links string"


def plain(rows, threshold):
    """All pairs of rows; ids may repeat or be missing."""
    vectors = {}
    for k, (_, label, v, _) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            vectors[k] = (label, np.asarray(v, np.float32).astype(float))
    links = {k: set() for k in range(len(rows))}
    for i, (la, a) in vectors.items():
        for j, (lb, b) in vectors.items():
            if i < j and la == lb and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i].add(j)
                links[j].add(i)
    root = dict.fromkeys(links)
    for k in links:
        if root[k] is None:
            group, more = {k}, [k]
            while more:
                more = [j for i in more for j in links[i] if j not in group and not group.add(j)]
            root |= dict.fromkeys(group, (min((rows[i][0] for i in group if rows[i][0] is not None), default=None),))
    out = [(rows[k][0], len(links[k]), root[k][0], rows[k][0] == root[k][0]) for k in links]
    return sorted(out, key=str)


def sample():
    rng = np.random.default_rng(9)
    rows = []
    centres = rng.standard_normal((6, 24))
    for i in range(400):
        centre, noise = centres[i % 6], rng.choice([0.02, 0.12, 0.6])
        rows.append((i, int(rng.integers(0, 2)), (centre + noise * rng.standard_normal(24)).tolist(), "x"))
    for i in range(400, 460):  # a dense cloud under one label
        rows.append((i, 3, (centres[0] + 0.01 * rng.standard_normal(24)).tolist(), None))
    rows += [(500 + i, 3, (np.array(rows[410][2]) * 3.0).tolist(), "x") for i in range(5)]
    rows += [
        (600, None, rows[0][2], "x"), (601, 1, None, "x"), (602, 1, [0.0] * 24, "x"), (603, 1, [float("nan")] * 24, "x"), (604, 1, [], "x"),
        (605, 1, [None] + [1.0] * 23, "x"), (606, 1, [float("inf")] + [1.0] * 23, "x"), (607, 1, [1.0, 0.0, 0.0], "x"), (608, 1, [2.0, 0.0, 0.0], "x"),
        rows[7], rows[7], (rows[8][0], rows[8][1], rows[20][2], "y"), (rows[9][0], 1 - rows[9][1], rows[9][2], "y"), (None, *rows[7][1:]), (None, *rows[7][1:]),
    ]
    return rows


@pytest.mark.parametrize("threshold, block, bins", [(0.98, 1024, 1 << 10), (0.98, 16, 1 << 10), (0.9, 8, 4), (0.5, 32, 64)])
def test_equals_all_pairs(spark, monkeypatch, threshold, block, bins):
    monkeypatch.setattr(dedup, "BLOCK", block)
    monkeypatch.setattr(dedup, "_BINS", bins)
    monkeypatch.setattr(dedup, "_STEPS", (2, 5, 11))
    rows = sample()
    found = dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), threshold=threshold).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows, threshold)


def test_repeated_and_missing_ids(spark):
    rows = [(1, 1, [1.0, 0.0], "x"), (1, 1, [0.0, 1.0], "x"), (2, 1, [0.0, 1.0], "x"), (3, 1, [1.0, 0.0], "x"), (None, 1, [1.0, 0.0], "x"), (None, 2, [1.0, 0.0], "x")]
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, dedup.near_duplicates(vectors).collect()), key=str) == plain(rows, 0.98) == [
        (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (None, 0, None, True), (None, 2, 1, False)]
    assert dedup.near_duplicates(vectors.limit(0)).count() == 0


def test_bound_never_drops_a_pair():
    rng = np.random.default_rng(10)
    raw = rng.standard_normal((80, 20))
    raw[40:] = raw[:40] + 0.1 * rng.standard_normal((40, 20))
    turned = dedup.unit(raw) @ np.linalg.qr(rng.standard_normal((20, 20)))[0]
    cosines = dedup.unit(raw) @ dedup.unit(raw).T
    for threshold in (0.3, 0.9, 0.99):
        i, j = dedup._found(turned, turned, raw, raw, True, threshold)
        want = {(a, b) for a in range(80) for b in range(a + 1, 80) if cosines[a, b] >= threshold}
        assert set(zip(i.tolist(), j.tolist())) == want
