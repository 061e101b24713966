"""Counts, tries, neighbours, forms and roots against plain code."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tillwise.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain_counts(docs):
    counts = Counter()
    for doc, text, *_ in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    beside = {w: sorted((x for x in counts if near(w, x)), key=lambda x: (-counts[x], x)) for w in counts}
    form = {w: c[0] for w, c in beside.items() if c and counts[c[0]] >= 10 * counts[w]}
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(beside[w]), form.get(w), counts.get(form.get(w)), root))
    return sorted(out)


def found(df):
    assert df.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(40):  # runs of equal letters and short alphabets make many ways to the same word
        word = "".join(rng.choice("aabé") for _ in range(rng.randint(7, 10)))
        for _ in range(12):
            counts[word] = 2 * 10 ** rng.randint(0, 5)
            at, kind = rng.randrange(len(word)), rng.randrange(3)
            word = word[:at] + ("" if kind == 0 else rng.choice("abé")) + word[at + (kind < 2):]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # borders between ranges
    try:
        out = found(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = brute(counts)
    assert out == want
    assert any(r[3] for r in want) and any(r[5] not in (r[0], r[3]) for r in want) and max(r[2] for r in want) > 5


def test_nodes_mean_prefixes_across_ranges(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(400)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        trie = spelling.numbered(spark.createDataFrame([(w, 0) for w in words], "word string, v bigint"))
        keys, values = spelling.border_nodes(trie).value
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows, same = trie.collect(), dict(zip(keys.tolist(), values.tolist()))
    assert [r.word for r in sorted(rows)] == sorted(words) and len({r.place >> 33 for r in rows}) > 2 and same
    node_of, prefix_of = {}, {}
    for r in rows:
        assert len(r.nodes) == len(r.word) + 1
        for i, node in enumerate(r.nodes):
            node = same.get(node, node)
            assert node_of.setdefault(r.word[:i], node) == node and prefix_of.setdefault(node, r.word[:i]) == r.word[:i]


def test_documents_equal_brute_force(spark):
    rng = random.Random(5)
    stems = ["organise", "organize", "Behaviour", "behavior", "über×länge", "aaaaaaaa", "shorter", "tiny"]
    docs = [(i, " ".join(rng.choice(stems) for _ in range(rng.choice([0, 3, 80]))) + rng.choice([".", "ŝ", "7"]), "w") for i in range(120)]
    docs += [(None, "organise organise organise", "x"), (7, None, "x"), (8, "", "x"), (9, "organise", "x"), (9, "organise", "x"), (10, "é" * 5000 + " " + "é" * 5000, "y")]
    out = found(spelling.group_variants(spark.createDataFrame(docs, "doc_id bigint, text string, word string")))
    assert out == brute(plain_counts(docs))
    assert any(r[3] for r in out)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "once only here"), (2, None)], "doc_id bigint, text string")
    assert found(spelling.group_variants(docs)) == [] == found(spelling.group_variants(docs.limit(0)))
