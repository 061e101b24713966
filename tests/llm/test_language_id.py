"""Held-out accuracy, and counts against plain code."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import language_id as lid

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, score string"
ROWS = [
    (1, "the house and the garden", "en", "x"), (2, "das haus und der garten", "de", "x"), (3, "the cat and the dog", "en", None),
    (4, None, "en", "x"), (5, "", "de", "x"), (6, "12 345 !!", "de", "x"), (7, "of the and", None, "x"), (None, "und der die das", "de", "x"),
    (1, "the house and the garden", "en", "x"),
]


def test_pieces_hold_every_ngram_once(monkeypatch):
    text = "Où est l'été? 42 Straßen " * 50
    whole = np.sort(np.concatenate(list(lid.ngram_buckets(text))))
    monkeypatch.setattr(lid, "_PIECE", 37)
    parts = list(lid.ngram_buckets(text))
    assert len(parts) > 10 and (np.sort(np.concatenate(parts)) == whole).all()


def test_model_equals_plain_counts(spark):
    model = lid.train(spark.createDataFrame(ROWS, SCHEMA))
    assert model.languages == ["de", "en"]
    counts = {lang: np.zeros(lid.BUCKETS) for lang in ("de", "en")}
    docs = {"de": 0, "en": 0}
    for _, text, lang, _ in ROWS:
        found = list(lid.ngram_buckets(text))
        if lang and found:
            docs[lang] += 1
            for buckets in found:
                np.add.at(counts[lang], buckets, 1)
    for i, lang in enumerate(model.languages):
        smooth = counts[lang] + 0.5
        assert np.allclose(model.log_prob[:, i], np.log(smooth / smooth.sum()))
    assert np.allclose(np.exp(model.log_prior), [docs["de"] / 5, docs["en"] / 5])


@pytest.mark.parametrize("piece, rows", [(7, 2), (1 << 18, 64)])
def test_posterior_equals_plain_sums(spark, monkeypatch, piece, rows):
    model = lid.train(spark.createDataFrame(ROWS, SCHEMA))
    texts = [r[1] for r in ROWS] + ["Der Garten und the house", "xyz " * 40, "é", None]

    def plain(text):
        found = list(lid.ngram_buckets(text))
        if not found:
            return lid.UNDETERMINED, 0.0
        logs = [model.log_prior[i] + sum(model.log_prob[b, i] for b in np.concatenate(found)) for i in range(2)]
        chances = [1 / sum(np.exp(other - own) for other in logs) for own in logs]
        return model.languages[int(np.argmax(logs))], max(chances)

    want = [plain(text) for text in texts]
    monkeypatch.setattr(lid, "_PIECE", piece)
    monkeypatch.setattr(lid, "_ROWS", rows)
    languages, chances = model.score_all(texts)
    assert languages == [lang for lang, _ in want] and np.allclose(chances, [p for _, p in want])
    assert [model.score(text) for text in texts] == list(zip(languages, chances.tolist()))
    assert model.score_all([])[0] == []


def test_defined_cases(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    out = {(r.doc_id, r.lang_pred): r.score for r in lid.identify(docs, docs).collect()}
    assert out[4, "und"] == out[5, "und"] == out[6, "und"] == 0.0
    assert out[7, "en"] > 0.5 and out[None, "de"] > 0.5
    assert lid.identify(docs, docs).count() == len(ROWS)
    untaught = lid.identify(docs, docs.limit(0)).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    assert lid.identify(docs.limit(0), docs).count() == 0


def test_more_languages_than_the_matrix_holds(spark, monkeypatch):
    monkeypatch.setattr(lid, "MAX_MATRIX_MB", 0)
    with pytest.raises(ValueError):
        lid.train(spark.createDataFrame(ROWS, SCHEMA))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held_out = lid.held_out(F.col("doc_id"))
    found = lid.identify(docs.filter(held_out), docs.filter(~held_out)).join(docs.select("doc_id", "lang"), "doc_id")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 200 and right >= 0.99
