"""Exponent, weights and blocks against plain code."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tillwise.llm import source_mixing as mixing

SCHEMA = "doc_id bigint, source string, text string, mix_block string"


def sample(n=700):
    draw = random.Random(8)
    rows = [(i, draw.choice(["big"] * 12 + ["mid"] * 4 + ["small", None]), "w " * draw.randrange(0, 30), "x") for i in range(n)]
    return rows + [(None, "mid", None, "x"), (5000, "silent", "", "x"), (5001, "silent", None, None), (1, rows[1][1], rows[1][2], "x")]


def plain_totals(rows):
    out = {}
    for _, source, text, _ in rows:
        n, t = out.get(source, (0, 0))
        out[source] = (n + 1, t + len((text or "").split()))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample(), SCHEMA)


@pytest.fixture(scope="module")
def totals(docs):
    return mixing.source_totals(docs, "source", mixing.count_tokens(F.col("text")))


def test_totals(totals):
    assert {r.source: (r.rows, r.tokens) for r in totals.collect()} == plain_totals(sample())


def test_exponent_for_repeats(totals):
    sizes = [t for _, t in plain_totals(sample()).values() if t]
    exact = 1 - math.log(3) / math.log(max(sizes) / min(sizes))
    found = mixing.temper(totals, max_repeats=3.0)
    assert found == pytest.approx(exact, abs=1e-8)
    assert mixing.temper(totals, max_repeats=1.0) == 1.0 and mixing.temper(totals, max_repeats=1e9) == 0.0


def entropy(sizes, x):
    powers = [s**x for s in sizes]
    return -sum(p / sum(powers) * math.log(p / sum(powers)) for p in powers)


def test_exponent_for_entropy(totals):
    sizes = [t for _, t in plain_totals(sample()).values() if t]
    wanted = (entropy(sizes, 0) + entropy(sizes, 1)) / 2
    found = mixing.temper(totals, entropy=wanted)
    assert entropy(sizes, found) == pytest.approx(wanted, abs=1e-6)
    with pytest.raises(ValueError, match="no exponent"):
        mixing.temper(totals, entropy=0.0)
    assert mixing.temper(totals.filter("source = 'big'"), entropy=0.0) == 0.0
    assert mixing.temper(totals, entropy=9.0) == 0.0


def test_entropy_below_that_of_the_shares(docs, totals):
    sizes = [t for _, t in plain_totals(sample()).values() if t]
    wanted = entropy(sizes, 1) / 2
    found = mixing.temper(totals, entropy=wanted)
    assert found > 1 and entropy(sizes, found) == pytest.approx(wanted, abs=1e-6)
    weights = {r.source: r.weight for r in mixing.plan(totals, found, 5000).collect() if r.weight}
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(wanted, abs=1e-6)
    rows = mixing.mix(docs, keys=["doc_id", "text"], entropy=wanted, budget_tokens=5000).collect()
    used = sum(len((r.text or "").split()) for r in rows)
    assert 5000 - 30 * len(weights) < used <= 5000


def test_rows_of_one_id_are_taken_one_by_one(spark):
    """Rows without an id, or with the same, differ by their content and fill a budget one by one."""
    rows = [(None if i % 2 else 7, "a", f"{i} " + "w " * 9) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    for mixed in (mixing.mix, mixing.mix_whole_rows):
        assert mixed(docs, keys=["doc_id", "text"], max_repeats=1.0, budget_tokens=500).count() == 50


@pytest.mark.parametrize("arguments", [{}, {"entropy": 1.0, "max_repeats": 2.0}, {"max_repeats": 0.5}])
def test_one_goal_is_needed(totals, arguments):
    with pytest.raises(ValueError):
        mixing.temper(totals, **arguments)


@pytest.mark.parametrize("least_shard", [4, 256])
@pytest.mark.parametrize("budget", [None, 900])
def test_blocks(spark, docs, monkeypatch, least_shard, budget):
    monkeypatch.setattr(mixing, "_LEAST_SHARD", least_shard)
    out = mixing.mix(docs, keys=["doc_id", "text"], max_repeats=2.5, budget_tokens=budget)
    assert out.columns == [*docs.columns, "mix__block", "mix__position", "mix__order_key"]  # mix_block was taken
    rows = out.collect()
    totals = plain_totals(sample())
    sizes = {s: t for s, (_, t) in totals.items() if t}
    x = 1 - math.log(2.5) / math.log(max(sizes.values()) / min(sizes.values()))
    powers = {s: t ** round(x, 9) for s, t in sizes.items()}
    total = budget or max(sizes.values()) / max(powers.values()) * sum(powers.values())
    for source, (n, t) in totals.items():
        own = [r for r in rows if r.source == source]
        blocks = {}
        for r in own:
            blocks.setdefault(r["mix__block"], []).append(r)
        if not t:
            assert set(blocks) == {0} and len(own) == n
            continue
        room = total * powers[source] / sum(powers.values())
        full = math.floor(room / t + 1e-9)
        tokens = lambda block: sum(len((r.text or "").split()) for r in block)
        assert all(len(blocks[b]) == n for b in range(full))
        assert set(blocks) <= set(range(full + 1))
        rest = room - full * t
        if full in blocks:
            assert tokens(blocks[full]) <= rest + 1e-6
            assert len(blocks[full]) == n or tokens(blocks[full]) > rest - 30  # the next row did not fit
        for block in blocks.values():
            assert sorted(r["mix__position"] for r in block) == list(range(1, len(block) + 1))
            by_place = sorted(block, key=lambda r: r["mix__position"])
            keys = [r["mix__order_key"] for r in by_place]
            assert keys == sorted(keys) and 0 <= keys[0] and keys[-1] <= 1
        orders = [[r.doc_id for r in sorted(blocks[b], key=lambda r: r["mix__position"])] for b in range(full)]
        assert len({tuple(map(str, o)) for o in orders}) == len(orders)  # each block has an order of its own


@pytest.mark.parametrize("budget", [None, 900])
def test_whole_rows_are_the_same_rows(docs, monkeypatch, budget):
    monkeypatch.setattr(mixing, "_LEAST_SHARD", 16)
    goal = {"keys": ["doc_id", "text"], "max_repeats": 2.5, "budget_tokens": budget}
    whole = mixing.mix_whole_rows(docs, **goal)
    assert whole.columns == docs.columns
    assert sorted(map(str, whole.collect())) == sorted(map(str, mixing.mix(docs, **goal).select(*docs.columns).collect()))


def test_empty(docs):
    for mixed in (mixing.mix, mixing.mix_whole_rows):
        assert mixed(docs.limit(0), keys=["doc_id"], max_repeats=2.0).count() == 0
        assert mixed(docs.filter("source = 'silent'"), keys=["doc_id"], max_repeats=2.0).count() == 2
