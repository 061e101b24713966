"""Windows, pieces and hits against plain code."""

import hashlib
import random
import re

import pytest

from tillwise.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain_words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items):
    out = []
    windows = {}
    for item, text, *_ in items:
        w = plain_words(text)
        k = min(len(w), 10)
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i: i + k]), set()).add("" if item is None else str(item))
    for doc, text, *_ in docs:
        w, hit, found = plain_words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if names := windows.get(tuple(w[i: i + k])):
                    hit |= set(range(i, i + k))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def scanned(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, row string, token string, win string")
    out = dc.scan(docs, spark.createDataFrame(items, "item_id bigint, text string, words string, item string"))
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted(map(tuple, out.collect()), key=repr)


def test_words():
    text = "Ünder ÀB1_c\x00d-e\x7ff É"
    assert [w.decode() for w in dc.words_of(text.encode())] == plain_words(text) == ["Ünder", "Àb1", "c", "d", "e", "f", "É"]
    assert dc.words_of(None) == []


@pytest.mark.parametrize("size", [8, 50, 300])
def test_pieces_give_each_place_once(monkeypatch, size):
    monkeypatch.setattr(dc, "_PIECE", size)
    rng = random.Random(size)
    for length in (0, 1, 5, 9, 10, 11, 40, 200):
        text = " ".join("".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 30]))) for _ in range(length))
        whole, seen = dc.words_of(text.encode()), []
        for base, words, first, last in dc.pieces(text.encode()):
            assert words == whole[base: base + len(words)]
            for at in range(first, last):
                assert at >= min(dc.WINDOW, base + at) and len(words) - at >= min(dc.WINDOW, len(whole) - base - at)
            seen += range(base + first, base + last)
        assert seen == list(range(length))


@pytest.mark.parametrize("seed, piece", [(1, 1 << 22), (2, 60)])
def test_equals_brute_force(spark, monkeypatch, seed, piece):
    monkeypatch.setattr(dc, "_PIECE", piece)
    rng = random.Random(seed)
    some = lambda n, words: [rng.choice(words) for _ in range(n)]
    vocabulary = ["the", "of", "Über", "x1", "naïve", "ten", "A"]
    items = [(i, " ".join(some(rng.choice([0, 1, 2, 3, 7, 10, 11, 25]), vocabulary[: rng.choice([2, 7])])), "w", "i") for i in range(30)]
    items += [(3, " ".join(some(15, vocabulary)), "w", "i"), (99, items[5][1], "w", "i")]
    docs = []
    for i in range(60):
        w = some(rng.choice([0, 2, 9, 10, 60]), vocabulary)
        for _ in range(rng.choice([0, 1, 3])):
            copied = plain_words(rng.choice(items)[1])
            at = rng.randint(0, len(w))
            w[at:at] = copied[: rng.choice([9, 10, 30])]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w), "r", "t", "w"))
    assert scanned(spark, docs, items) == brute(docs, items)


def test_ends_and_overlaps(spark):
    passage = [f"w{i}" for i in range(30)]
    items = [(1, " ".join(passage[:12]), "", ""), (2, " ".join(passage[8:20]), "", ""), (10, "w3 w4", "", "")]
    docs = [
        (1, " ".join(passage), "", "", ""), (2, " ".join(passage[:9]), "", "", ""), (3, " ".join(passage[2:12]), "", "", ""),
        (4, " ".join(passage[3:12]), "", "", ""), (5, " ".join(passage[:10] * 3), "", "", ""), (6, "w3  W4", "", "", ""), (7, "w4 w3", "", "", ""),
    ]
    got = scanned(spark, docs, items)
    assert got == brute(docs, items)
    assert [r[2] for r in got] == [20, 2, 10, 2, 30, 2, 0]


def test_odd_rows(spark):
    items = [(1, None, "", ""), (2, "", "", ""), (3, "...", "", ""), (None, "alpha beta gamma", "", ""), (None, "delta", "", ""), (4, "alpha beta gamma", "", "")]
    docs = [(1, None, "", "", ""), (2, "", "", "", ""), (3, "-- !", "", "", ""), (None, "so alpha beta gamma", "", "", ""), (5, "delta", "", "", ""),
            (5, "delta", "", "", ""), (5, "other", "", "", ""), (6, "alpha beta gamma " * 30_000, "", "", "")]
    got = scanned(spark, docs, items)
    assert got == brute(docs, items)
    assert scanned(spark, docs, items[:0]) == brute(docs, []) and scanned(spark, docs[:0], items) == []
