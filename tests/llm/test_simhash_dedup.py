"""Fingerprints bit by bit, links against all pairs, and the covering property."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tillwise.llm import simhash_dedup as sim
from tillwise.llm.components import components


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("text", [None, "", " \t\x0b\n", "One", "one TWO", "a b c", "É a é b   c d", "x y z x y z x y z", "\x1c\x1d a\x85b c"])
def test_fingerprint(text):
    assert sim.fingerprint(text) == plain_fingerprint(text)


def test_long_text_in_parts(monkeypatch):
    draw = random.Random(1)
    text = " ".join(draw.choice("abcdefgh") * draw.randrange(1, 3) for _ in range(500))
    monkeypatch.setattr(sim, "_AT_ONCE", 7)
    assert sim.fingerprint(text) == plain_fingerprint(text)


def test_masks_cover_every_pair_of_positions():
    masks = [m % 2**64 for m in sim.covering_masks()]
    assert len(masks) == 7
    for i in range(64):
        for j in range(i, 64):
            differing = 1 << i | 1 << j
            assert any(not m & differing for m in masks)


def cloud(draw, centre, n, most):
    out = set()
    while len(out) < n:
        x = centre
        for _ in range(draw.randrange(most + 1)):
            x ^= 1 << draw.randrange(64)
        out.add(x)
    return out


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("pairwise", [0, 32, 10**6])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, pairwise):
    monkeypatch.setattr(sim, "PAIRWISE", pairwise)
    draw = random.Random(2)
    prints = set().union(*(cloud(draw, draw.getrandbits(64), n, most) for n, most in ((300, 4), (60, 2), (40, 8), (1, 0), (200, 1 << 5))), {0, 1, 3, 1 << 63})
    prints = sorted(signed(p) for p in prints)
    wanted = plain_components(prints, [(a, b) for a in prints for b in prints if a < b and ((a ^ b) % 2**64).bit_count() <= 2])
    edges = [(r.a, r.b) for r in sim.links(spark.createDataFrame([(p,) for p in prints], "fp bigint")).collect()]
    assert all(((a ^ b) % 2**64).bit_count() <= 2 for a, b in edges)
    assert plain_components(prints, edges) == wanted


def test_components_of_paths_stars_and_loops(spark):
    path = list(range(100, 160))
    random.Random(3).shuffle(path)
    pairs = [*zip(path, path[1:]), *[(7, n) for n in range(1000, 1300)], (5, 5), (-3, 7), (900, 901), (901, 900), (None, 4)]
    nodes = {n for pair in pairs if None not in pair and pair[0] != pair[1] for n in pair}
    wanted = plain_components(nodes, [p for p in pairs if None not in p and p[0] != p[1]])
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == wanted
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


ROWS = [
    (9, "a b c d e f g h", "x"), (4, "A B C D E F G H", "x"), (4, "A B C D E F G H", "x"), (1, None, "x"), (2, "", None), (3, " \n", "x"),
    (20, "some quite other words stand here", "x"), (None, "some quite other words stand here", "x"), (None, "all by itself and nameless", "x"),
    (30, "one", "x"), (31, "w " * 30_000, "x"), (32, "w " * 30_001, "x"),
]
SCHEMA = "doc_id bigint, text string, fp string"  # fp: a name used inside


def test_find_and_keep(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    prints = {i: plain_fingerprint(text) for i, (_, text, _) in enumerate(ROWS)}
    root = plain_components(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    ids = lambda i: [ROWS[j][0] for j in prints if root[j] == root[i] and ROWS[j][0] is not None]
    wanted = sorted((str(row[0]), f"{prints[i]:016x}", str(min(ids(i), default=None))) for i, row in enumerate(ROWS))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in sim.find(docs).collect()) == wanted
    kept = sim.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(min(ids(i), default=None)) for i in set(root.values()))
    assert sim.find(docs.limit(0)).count() == 0 and sim.keep_one(docs.limit(0)).count() == 0


def test_column_equals_spark_hash(spark):
    row = spark.createDataFrame([("été the end",)], "t string").select(F.xxhash64("t"), sim.fingerprint_column(F.col("t"))).first()
    assert row[0] == row[1]  # one shingle: the majority of its bits is itself
