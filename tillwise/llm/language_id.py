"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every run of other characters becomes one blank, and the n-grams of one to three
characters are hashed into ``BUCKETS`` counters. Training counts all given rows: each task adds up its texts
and Spark sums the counters by language. The matrix of log probabilities (languages x buckets) is broadcast;
its size is checked and does not depend on the number of documents. Scoring gathers matrix rows in numpy.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and teaches nothing; rows without
language teach nothing; repeated rows count as often as they occur; equal scores go to the language that sorts
first; with nothing to learn from every text is ``und``. Texts are cut into pieces of ``_PIECE`` characters
(overlapping by two, so no n-gram is lost), so a very long one needs no more memory than its piece.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

UNDETERMINED = "und"
BUCKETS = 1 << 15
ORDERS = 3
MAX_MATRIX_MB = 256
_PIECE = 1 << 18
_ROWS = 64


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text: letters as they are, one blank for everything between."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    if text.isascii():
        letter = (points >= 97) & (points <= 122)
    else:
        letter = _is_letter()[points]
    if not letter.any():
        return points[:0]
    points = np.where(letter, points, 32)
    keep = np.ones(len(points), bool)
    keep[1:] = letter[1:] | letter[:-1]  # the first of each run of blanks
    return np.concatenate(([32], points[keep], [32])).astype(np.uint32)


_TABLE: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _TABLE[0]


def ngram_buckets(text: str | None) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of a text, in pieces of bounded length."""
    points = _letters(text) if text else np.empty(0, np.uint32)
    for start in range(0, max(len(points) - 1, 0), _PIECE):
        own = points[max(start - ORDERS + 1, 0): start + _PIECE]
        new = min(start, ORDERS - 1)  # characters seen before
        found, code = [], np.zeros(len(own), np.uint32)
        for order in range(1, ORDERS + 1):
            code = (code[: len(own) - order + 1] * np.uint32(0x01000193) ^ own[order - 1:]) * np.uint32(0x9E3779B1)
            mixed = (code ^ (code >> np.uint32(15))) + np.uint32(order)
            found.append(mixed[max(new - order + 1, 0):] % np.uint32(BUCKETS))
        yield np.concatenate(found).astype(np.int32)


class Model:
    """Languages in order and, per bucket, the log probability in each of them."""

    def __init__(self, languages: list[str], log_prob: np.ndarray, log_prior: np.ndarray):
        self.languages, self.log_prob, self.log_prior = languages, log_prob, log_prior

    def score_all(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Most probable language and its posterior probability of each text.

        Texts are scored ``_ROWS`` at a time: the buckets that occur in them are a sparse matrix of counts, of which
        the product with the log probabilities is added up language by language. A long text is added piece by piece,
        so that its score does not depend on the texts beside it.
        """
        total, seen = np.tile(self.log_prior, (len(texts), 1)), np.zeros(len(texts), bool)
        held: list[tuple[int, np.ndarray]] = []
        for row, text in enumerate(texts):
            for piece, buckets in enumerate(ngram_buckets(text)):
                seen[row] = True
                if piece or len(held) == _ROWS:
                    self._add(total, held)
                    held = []
                held.append((row, buckets))
        self._add(total, held)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        best = total.argmax(axis=1)
        chance = 1 / np.exp(total - total[np.arange(len(texts)), best][:, None]).sum(axis=1)
        return [self.languages[i] if s else UNDETERMINED for i, s in zip(best, seen)], np.where(seen, chance, 0.0)

    def _add(self, total: np.ndarray, held: list[tuple[int, np.ndarray]]) -> None:
        """Add the log probabilities of the held buckets to the totals of their rows."""
        if not held:
            return
        keys = np.concatenate([buckets + np.int64(i * BUCKETS) for i, (_, buckets) in enumerate(held)])
        counts = np.bincount(keys, minlength=len(held) * BUCKETS)
        at = counts.nonzero()[0]
        row, bucket, times = at // BUCKETS, at % BUCKETS, counts[at]
        for i in range(len(self.languages)):
            total[[r for r, _ in held], i] += np.bincount(row, times * self.log_prob[bucket, i], len(held))

    def score(self, text: str | None) -> tuple[str, float]:
        languages, chances = self.score_all([text])
        return languages[0], float(chances[0])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            taught = False
            for buckets in ngram_buckets(text.as_py()):
                own[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                taught = True
            own[BUCKETS] += taught
    for lang, own in counts.items():
        which = own.nonzero()[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(which), pa.string()), pa.array(which, pa.int32()), pa.array(own[which], pa.int64())],
            ["lang", "bucket", "n"],
        )


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Learn from all rows that have a language and a text with a letter."""
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    summed = known.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # languages come first, so that the size of the matrix is known before anything large reaches the driver
    languages = sorted(r.lang for r in known.select("lang").distinct().limit(MAX_MATRIX_MB * 2**20 // (BUCKETS * 8) + 1).collect())
    if len(languages) * BUCKETS * 8 > MAX_MATRIX_MB * 2**20:
        raise ValueError(f"{lang_col} has more languages than a matrix of {MAX_MATRIX_MB} MB holds")
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((BUCKETS + 1, len(languages)))
    found = summed.toArrow().to_pandas()
    counts[found["bucket"], found["lang"].map(place).astype(int)] = found["n"]
    taught = counts[BUCKETS] > 0
    counts, languages = counts[:, taught], [lang for lang, kept in zip(languages, taught) if kept]
    smooth = counts[:BUCKETS] + smoothing
    prior = counts[BUCKETS]
    return Model(languages, np.log(smooth / smooth.sum(axis=0)), np.log(prior / max(prior.sum(), 1)))


def predictor(spark: SparkSession, model: Model):
    """Function of a text column: struct of ``lang_pred`` and ``score``."""
    shipped = spark.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            languages, chances = shipped.value.score_all(texts.tolist())
            yield pd.DataFrame({"lang_pred": languages, "score": chances})

    return predict


def held_out(id_col: Column) -> Column:
    """True for the quarter of ids that is kept for testing."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


def identify(
    docs: DataFrame, training: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``(id, lang_pred, score)`` of every row of ``docs``, learnt from ``training``."""
    predict = predictor(docs.sparkSession, train(training, text_col=text_col, lang_col=lang_col))
    return docs.select(F.col(id_col), predict(F.col(text_col)).alias("p")).select(id_col, "p.*")
