"""Against the rank-based encoder itself, and an exact round trip."""

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tillwise.llm import byte_bpe
from tillwise.llm.registry import byte_codec

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "\n \n", "a" * 70_000, " " * 3000, "'s 'S don't", "\0<unk>▁x", "Ünïcödé ١٢٣ 漢字", "\x1c\x85　x", "🙂🙂", "՘a \U00010940b 1\U00011de5"]


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def other(ranks):
    return tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe(ranks):
    pattern = public_tokenizers.PATTERN
    return byte_bpe.ByteBpe(byte_bpe.sentencepiece_model(ranks), pattern, byte_bpe.newer_characters(pattern))


def test_texts_equal_the_rank_encoder(bpe, other):
    draw = random.Random(5)
    chars = ["a", "é", " ", "\n", "1", "'s", " ", "ß", "!", "\U0001f600", "한"]
    texts = ODD + ["".join(draw.choice([*chars, chr(draw.randrange(0xD800))]) for _ in range(draw.randrange(60))) for _ in range(2000)]
    for text, ids in zip(texts, bpe.encode_many(texts)):
        assert ids.tolist() == other.encode_ordinary(text), text[:40]
        assert bpe.decode(ids) == text.encode()


def test_every_vocabulary_entry_is_one_id(bpe, ranks):
    table = byte_bpe.byte_characters()
    entries = sorted(ranks, key=ranks.get)
    found = bpe._processor.encode(["".join(table[b] for b in entry) for entry in entries])
    assert found == [[r] for r in range(len(entries))]


def test_a_full_cache_starts_anew(bpe, other, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_CACHE", 3)
    monkeypatch.setattr(byte_bpe, "_TOGETHER", 20)
    texts = ["one two three four", "five six one", "seven eight nine ten two"]
    assert [x.tolist() for x in bpe.encode_many(texts)] == [other.encode_ordinary(t) for t in texts]


def test_vocabulary_must_be_whole(ranks):
    with pytest.raises(ValueError):
        byte_bpe.sentencepiece_model({b"a": 1})
    with pytest.raises(ValueError):
        byte_bpe.sentencepiece_model({b"a": 0, b"b": 1})


def test_columns(spark, other):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, "y"), (3, "twice", "z"), (3, "twice", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")  # a column named like the result
    codec = byte_codec(spark)
    encoded = byte_bpe.encode_documents(docs, codec)
    want = sorted((str(i), other.encode_ordinary(t or "")) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == want
    decoded = byte_bpe.decode_documents(encoded, codec).collect()
    assert sorted((str(r.doc_id), r.text) for r in decoded) == sorted((str(i), t or "") for i, t, _ in rows)
    assert codec and docs.limit(0).select(codec.round_trip(F.col("text")).alias("r")).count() == 0
