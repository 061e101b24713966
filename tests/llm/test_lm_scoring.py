"""Scores against a plain bigram model that leaves the scored document out."""

import math
import os
import random
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillwise.llm import lm_scoring as lm

SCHEMA = "doc_id bigint, text string, target boolean, score string, pairs string"
ROWS = [
    (1, "the cat sat on the mat", True, "x", "p"), (2, "The dog sat on the log", True, "x", "p"), (3, "buy now buy now", False, None, "p"),
    (4, None, True, "x", "p"), (5, "", False, "x", "p"), (6, "cat", None, "x", "p"), (None, "the cat", False, "x", "p"), (7, "Ünï the\x0bcat \t", False, "x", "p"),
]


def words_of(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def plain_scores(rows, shard_words=lm.SHARD_WORDS):
    pairs = [list(zip(["<s>", *words_of(r[1])], words_of(r[1]))) for r in rows]
    vocabulary = len({w for p in pairs for pair in p for w in pair})
    models = []
    for chosen in (lambda r: True, lambda r: r[2]):
        seen = [p for r, own in zip(rows, pairs) if chosen(r) for p in own]
        models.append((Counter(seen), Counter(v for v, _ in seen), len(seen)))
    (bp, bw, bn), (tp, tw, tn) = models
    scale = tn / bn if tn else 1.0
    hot = {v for v, n in bw.items() if n > shard_words // 4}
    out = []
    for r, own in zip(rows, pairs):
        mine, first, total = Counter(own), Counter(v for v, _ in own if v not in hot), 0.0
        for v, w in own:
            def loss(joint, words, scale, seen):
                return -math.log((scale * (joint[v, w] - seen * mine[v, w]) + lm.ALPHA) / (scale * (words[v] - seen * first[v]) + lm.ALPHA * vocabulary))
            total += loss(tp, tw, 1, bool(r[2])) - loss(bp, bw, scale, True)
        out.append((str(r[0]), len(own), total / len(own) if own else None))
    return sorted(out, key=str)


def scored(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = lm.cross_entropy_difference(docs, docs.filter("target"), **options)
    assert out.columns == ["doc_id", "n_words", "score"]
    return sorted(((str(r.doc_id), r.n_words, r.score) for r in out.collect()), key=str)


def same(found, want):
    assert [r[:2] for r in found] == [r[:2] for r in want]
    for f, w in zip(found, want):
        assert f[2] == w[2] if w[2] is None else f[2] == pytest.approx(w[2], abs=1e-5)


def some_rows(seed=6, n=60):
    draw = random.Random(seed)
    return ROWS + [(100 + i, " ".join(draw.choice("aabcdefghij") for _ in range(draw.randrange(40))), i % 3 == 0, "x", "p") for i in range(n)]


@pytest.mark.parametrize("piece, flush, docs", [(2, 50, 4), (1 << 22, 1 << 20, 1 << 15)])
@pytest.mark.parametrize("shard_words", [lm.SHARD_WORDS, 64])
def test_equals_plain_model(spark, monkeypatch, piece, flush, docs, shard_words):
    for name, value in {"_PIECE": piece, "_FLUSH": flush, "_DOCS": docs}.items():
        monkeypatch.setattr(lm, name, value)
    same(scored(spark, some_rows(), shard_words=shard_words), plain_scores(some_rows(), shard_words))


def test_joined_ids_give_the_same(spark):
    rows = some_rows()
    same(scored(spark, rows, most_buckets=0), plain_scores(rows))


def twice_each(draw):
    return " ".join(f"{w} {w}" for w in (draw.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(10)))


@pytest.mark.parametrize("text", [twice_each, lambda draw: "x y " * 10, lambda draw: "z " * 20, lambda draw: " ".join(str(draw.random()) for _ in range(19)) + " end"])
def test_no_pair_fills_a_shard(spark, text):
    """Words said twice, pairs and last words that are a large part of a corpus of 24 shards."""
    draw = random.Random(3)
    rows = [(i, text(draw), i % 3 == 0, "x", "p") for i in range(300)]
    same(scored(spark, rows, shard_words=256), plain_scores(rows, 256))
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = lm.Corpus(docs, 256)
    blocks = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("binary").alias("text"), "target").mapInArrow(lm._pack(spark.sparkContext.broadcast(plan)), lm._BLOCKS)
    pairs = dict(blocks.groupBy("shard").agg(F.sum(F.length("pairs") / 8)).na.drop().collect())
    assert plan.shards == 24 and sum(pairs.values()) == 6000 and max(pairs.values()) < 3 * 256


def a_shard(n=1 << 20, blocks=3, seed=2):
    draw = np.random.default_rng(seed)
    pair = (np.uint64(2654435761) * draw.zipf(1.3, n).astype(np.uint64) << np.uint64(32)) | draw.integers(0, 50, n).astype(np.uint64)
    doc = np.sort(draw.integers(0, 4000, n).astype(np.uint16))
    cut = np.linspace(0, n, blocks + 1).astype(int)
    rows = [lm._rows([0], [b], [None], [None], [pair[i:j].tobytes()], [doc[i:j].tobytes()]) for b, i, j in zip(range(blocks), cut, cut[1:])]
    hot, pairs = np.unique(pair >> np.uint64(32))[:2], np.unique(pair)[:3]
    counts = [np.arange(1.0, 1 + 2 * len(x)).reshape(-1, 2)[:, ::-1] + 2 * n for x in (hot, pairs)]
    plan = SimpleNamespace(scale=0.4, pseudo=9.0, hot_lower=hot, hot_counts=counts[0], pairs=pairs, pair_counts=counts[1])
    return plan, pair, doc.astype(np.int64), pa.Table.from_batches(rows)


def test_chunks_give_the_same(monkeypatch):
    plan, pair, doc, _ = a_shard(20_000)
    whole = lm.differences(plan, pair, doc)
    monkeypatch.setattr(lm, "_CHUNK", 300)
    assert all(np.array_equal(a, b) for a, b in zip(whole, lm._in_chunks(plan, pair, doc)))


def test_memory_of_a_shard():
    """A whole shard is scored in less than 120 bytes a pair."""
    plan, _, _, table = a_shard()
    tracemalloc.start()
    try:
        scored = lm._score_shard(SimpleNamespace(value=plan))((0,), table)
        assert tracemalloc.get_traced_memory()[1] < 120 << 20
    finally:
        tracemalloc.stop()
    assert scored.num_rows == 3


def test_own_label_does_not_count(spark):
    rows = some_rows()
    for i in (100, 103, 104):
        flipped = [(*r[:2], not r[2], *r[3:]) if r[0] == i else r for r in rows]
        a, b = ({k: s for k, _, s in scored(spark, x)}[str(i)] for x in (rows, flipped))
        assert a == pytest.approx(b, abs=0.02)  # only the scale, a share of all words, differs


def test_targets_by_bitmap(spark):
    ids = [-70_000, -1, 0, 5, 32_767, 32_768, 2**40]
    docs = spark.createDataFrame([(i, "a") for i in [*ids, 6, 2**40 + 1, -2, None]], "doc_id bigint, text string")
    target = spark.createDataFrame([(i,) for i in [*ids, None, 5]], "doc_id bigint")
    for most in (lm.MOST_BUCKETS, 2):
        marked = lm.mark_targets(docs, target, id_col="doc_id", text_col="text", most_buckets=most)
        assert {r.id for r in marked.filter("target").collect()} == {str(i) for i in ids} and marked.count() == 11
    names = docs.select(F.concat(F.lit("d"), F.col("doc_id")).alias("doc_id"), "text")
    marked = lm.mark_targets(names, names.limit(1).select("doc_id"), id_col="doc_id", text_col="text")
    assert [r.target for r in marked.collect()].count(True) == 1


def test_no_target_and_no_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    nothing = docs.limit(0)
    assert lm.cross_entropy_difference(docs, nothing.select("doc_id")).filter("score is not null").count() == 6
    assert lm.cross_entropy_difference(nothing, nothing.select("doc_id")).count() == 0


def test_pieces_cut_between_words(monkeypatch):
    text = " ".join(str(i) * (i % 7) for i in range(60)).encode() + b"\n\t tail "
    whole = np.concatenate(list(lm.pieces(text)))
    monkeypatch.setattr(lm, "_PIECE", 9)
    parts = list(lm.pieces(text))
    assert len(parts) > 5 and np.concatenate([parts[0], *[p[1:] for p in parts[1:]]]).tolist() == whole.tolist()
    assert all(a[-1] == b[0] for a, b in zip(parts, parts[1:])) and list(lm.pieces(None)) == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the test tables")
def test_unlabelled_target_texts_score_lower(spark):
    """Half of the French documents are target; the other half, which no model knows as such, is told apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = docs.filter("lang = 'fr' and doc_id % 2 = 0")
    rest = docs.filter("not (lang <=> 'fr' and doc_id % 2 = 0)").select("doc_id", (F.col("lang") == "fr").alias("french"))
    means = dict(lm.cross_entropy_difference(docs, known).join(rest, "doc_id").groupBy("french").agg(F.avg("score")).collect())
    assert means[True] < means[False]
