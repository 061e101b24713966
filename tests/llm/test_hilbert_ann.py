"""The curve itself, recall and exact scores against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import hilbert_ann as ann

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string"


@pytest.mark.parametrize("dims, bits", [(1, 5), (2, 4), (3, 3), (5, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = ann.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def brute(rows, k=5):
    good = {i: np.asarray(v, np.float32).astype(float) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in good:
        if q % 50 == 0:
            cosine = lambda i: good[q] @ good[i] / (np.linalg.norm(good[q]) * np.linalg.norm(good[i]))
            scored = sorted(((-round(cosine(i), 12), i) for i in good if i != q and len(good[i]) == len(good[q])))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def answers(spark, rows, **options):
    out = {}
    for r in ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 12)))
    assert all([rank for rank, *_ in rows] == list(range(1, len(rows) + 1)) for rows in out.values())
    return {q: [(i, s) for _, i, s in rows] for q, rows in out.items()}


def test_wide_windows_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(11)
    rows = [(i, rng.standard_normal(16).tolist(), 0, "x") for i in range(600)]
    assert answers(spark, rows, share=1.0) == brute(rows)


def test_recall_at_default_settings(spark):
    """Windows are about a tenth of the rows on each curve."""
    rng = np.random.default_rng(12)
    rows = [(i, rng.standard_normal(64).tolist(), 0, "x") for i in range(5000)]
    assert 2 * (ann.SHARE * 5000 + ann.BLOCK) < 5000 / 5
    found, want = answers(spark, rows), brute(rows)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.93


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(50, [1.0, 0.0], 0, "x"), (50, [0.9, 0.1], 0, "x"), (50, [0.9, 0.1], 0, "x"), (7, [1.0, 0.0], 0, "x"), (8, [0.0, 1.0], 0, "x")]
    out = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0)
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 3)) for r in out.collect())
    assert got == [(50, 1, 7, 0.994), (50, 1, 7, 1.0), (50, 2, 50, 0.994), (50, 2, 50, 0.994), (50, 3, 8, 0.0), (50, 3, 8, 0.11)]


def test_copies_ties_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(13)
    same = rng.standard_normal(8).tolist()
    rows = [(i, same if i % 3 == 0 else rng.standard_normal(8).tolist(), 0, "x") for i in range(300)]  # a third are copies
    rows += [(1000, None, 0, "x"), (1050, [0.0] * 8, 0, "x"), (1100, [float("nan")] * 8, 0, "x"), (1150, [None] * 8, 0, "x"), (1200, [], 0, "x"),
             (None, same, 0, "x"), (1250, [1.0, 2.0], 0, "x"), (1251, [2.0, 4.0], 0, "x"), rows[50], rows[50]]
    found, want = answers(spark, rows, share=1.0), brute(rows)
    assert found.keys() == want.keys() and found[1250] == [(1251, 1.0)]
    for q in want:
        assert [i for i, _ in found[q]] == [i for i, _ in want[q]]


def test_few_rows(spark):
    rows = [(0, [1.0, 0.0], 0, "x"), (1, [0.0, 1.0], 0, "x"), (2, [1.0, 1.0], 0, "x")]
    assert [i for i, _ in answers(spark, rows)[0]] == [2, 1]
    assert answers(spark, rows[:1]) == {} and answers(spark, rows[1:]) == {}
    assert ann.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
