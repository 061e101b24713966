"""Cross-entropy difference: how much better a target-domain n-gram model predicts a text than a background one.

Words lie between ASCII white space, A-Z lower-cased, and stand for themselves by a 64-bit hash. Both models are
bigram models over one vocabulary, the V words of all given texts: a word w after v has the probability
``(c(v, w) + ALPHA) / (c(v) + ALPHA * V)``. The background counts all texts, the target the labelled ones, and the
background's counts are scaled to the target's number of words, so that neither model is sharper for having seen
more. A document's score is the mean over its words of target loss minus background loss, in nats: below 0 the
document is closer to the target.

No document is scored by counts it has made itself: its own pairs are taken out of both models first. So the score
of a labelled document does not depend on its own label.

Counts are exact and grow with the corpus, and no model is ever gathered or broadcast. Each task cuts its words into
shards by the first word of a pair and sends one packed block per shard (8 bytes of hash and 2 of document per word). A
shard has all pairs of its words, so it counts and scores in one go and returns a sum per document and shard. The
number of shards follows the number of words. Words more frequent than a quarter of a shard are counted beforehand
and their pairs dealt out by both words, so that no word, however frequent, fills a shard. Pairs more frequent than
half a shard are counted beforehand as well, among words that are, and dealt out by document. A shard is scored in
pieces of about ``_CHUNK`` pairs, cut between words.

The labelled ids become a bitmap of at most ``MOST_BUCKETS`` pieces of 4 KB, which is broadcast; ids that are too many
or too scattered for that, or no whole numbers, are joined. Texts are not shuffled, and read twice, or three times if
there are words for such pairs.

Defined cases: a null text, or one without words, has 0 words and a null score; a null id is no target; repeated rows
are documents of their own and count as often as they occur; the first word follows a start mark; without target
words the target model is uniform and the background counts as they are; an empty table gives an empty result;
other columns are ignored, whatever their names. Long texts are handled in pieces of ``_PIECE`` bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALPHA = 0.1
SHARD_WORDS = 1 << 20
MOST_BUCKETS = 1 << 14
_PIECE = 1 << 22
_FLUSH = 1 << 20
_DOCS = 1 << 15
_CHUNK = 1 << 17
_BLANKS = (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
_START = np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def pieces(text: bytes | None) -> Iterator[np.ndarray]:
    """Hashes of the words of a text, each piece after the word before it; the first after the start mark."""
    from xxhash import xxh3_64_intdigest

    text, at, before = text or b"", 0, _START
    while at < len(text):
        end = at + _PIECE
        if end < len(text):  # cut at white space; a word longer than a piece stays whole
            before_end = max(text.rfind(c, at, end) for c in _BLANKS)
            end = before_end + 1 if before_end >= 0 else min((i for c in _BLANKS if (i := text.find(c, end)) >= 0), default=len(text))
        words = text[at:end].lower().split()
        at = end
        if words:
            hashes = np.empty(len(words) + 1, np.uint64)
            hashes[0] = before
            hashes[1:] = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
            before = hashes[-1]
            yield hashes


# --- which documents are target --------------------------------------------------------------------


def mark_targets(docs: DataFrame, target_ids: DataFrame, *, id_col: str, text_col: str, most_buckets: int = MOST_BUCKETS) -> DataFrame:
    """``(id, text, target)`` of every row of ``docs``; texts as bytes, ids as text."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    ids = target_ids.select(F.col(id_col).cast(texts.schema["id"].dataType).alias("target_id")).na.drop()
    if isinstance(texts.schema["id"].dataType, T.IntegralType):
        number = F.col("target_id").cast("bigint")
        parts = ids.groupBy(F.shiftright(number, 15).alias("bucket")).agg(F.bitmap_construct_agg(number.bitwiseAND(F.lit(32767))).alias("bits"))
        if parts.limit(most_buckets + 1).count() <= most_buckets:
            # in the JVM: another Python worker for each core would hold its memory until the query ends
            own = F.col("id").cast("bigint")
            at = own.bitwiseAND(F.lit(32767)).cast("int")
            byte = F.conv(F.hex(F.substring("bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
            bit = F.getbit(byte, at.bitwiseAND(F.lit(7)))
            marked = texts.join(F.broadcast(parts), F.shiftright(own, 15) == F.col("bucket"), "left")
            return marked.select(F.col("id").cast("string").alias("id"), "text", F.coalesce(bit == 1, F.lit(False)).alias("target"))
    marked = texts.join(ids.distinct(), F.col("id") == F.col("target_id"), "left")
    return marked.select(F.col("id").cast("string").alias("id"), "text", F.col("target_id").isNotNull().alias("target"))


# --- counting --------------------------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word comes first in a pair, in all texts and in the target, and how much more often it comes second."""
    held: list[np.ndarray] = []
    first: list[np.ndarray] = []
    size = 0

    def settle() -> pa.RecordBatch:
        words, at = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_inverse=True)
        weight = np.concatenate(first) if first else np.zeros(0)
        n, n_target = (np.bincount(at, w, minlength=len(words)).astype(np.int64) for w in ((weight > 0), (weight > 1)))
        second = np.ones(len(weight))
        second[np.cumsum([0, *map(len, held)])[:-1]] = 0  # the piece before has it, or it is the start mark
        n_last = np.bincount(at, second, minlength=len(words)).astype(np.int64) - n
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), *map(pa.array, (n, n_target, n_last))], ["word", "n", "n_target", "n_last"])

    for batch in batches:
        for text, target in zip(batch.column(0), batch.column(1).to_pylist()):
            for hashes in pieces(text.as_py()):
                held.append(hashes)
                first.append(np.full(len(hashes), 2.0 if target else 1.0))
                first[-1][-1] = 0  # the next piece, or nothing, follows it
                size += len(hashes)
                if size > _FLUSH:
                    yield settle()
                    held, first, size = [], [], 0
    yield settle()


def _find(among: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values among sorted ones, of which there are some, and which values are there."""
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return at, among[at] == values


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first << np.uint64(32)) | (second & _LOW)


def _count_pairs(firsts: np.ndarray, seconds: np.ndarray):
    """How often each pair of these words comes, in all texts and in the target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, size, kept = [], [], 0, 0

        def choose() -> int:
            first, second = np.concatenate([h[:-1] for h, _ in held]), np.concatenate([h[1:] for h, _ in held])
            target = np.repeat([t for _, t in held], [len(h) - 1 for h, _ in held])
            held.clear()
            own = np.flatnonzero(_find(firsts, first)[1])
            own = own[_find(seconds, second[own])[1]]
            found.append((_pair(first[own], second[own]), target[own]))
            return len(own)

        def settle() -> pa.RecordBatch:
            pairs, at = np.unique(np.concatenate([p for p, _ in found]), return_inverse=True)
            n_target = np.bincount(at, np.concatenate([t for _, t in found]), minlength=len(pairs)).astype(np.int64)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(np.bincount(at, minlength=len(pairs))), pa.array(n_target)], ["pair", "n", "n_target"])

        for batch in batches:
            for text, target in zip(batch.column(0), batch.column(1).to_pylist()):
                for hashes in pieces(text.as_py()):
                    held.append((hashes, bool(target)))
                    size += len(hashes)
                    if size > _FLUSH:
                        kept, size = kept + choose(), 0
                        if kept > _FLUSH:
                            yield settle()
                            kept = 0
        if held:
            choose()
        if found:
            yield settle()

    return run


class Corpus:
    """Totals of the corpus, and the counts of words and pairs that are too frequent for one shard."""

    def __init__(self, marked: DataFrame, shard_words: int):
        most = shard_words // 2
        texts = marked.select("text", "target")
        counted = texts.mapInArrow(_count_words, "word bigint, n bigint, n_target bigint, n_last bigint")
        words = counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "n_target", "n_last")])
        frequent = F.collect_list(F.when(F.col("n") > shard_words // 4, F.struct("word", "n", "n_target")))
        second = F.collect_list(F.when(F.col("n") + F.col("n_last") > most, F.col("word")))
        row = words.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.sum("n_target").alias("n_target"), frequent.alias("hot"), second.alias("second")).first()
        self.pseudo = ALPHA * max(row["words"], 1)
        total, target = row["n"] or 0, row["n_target"] or 0
        self.scale = target / total if target else 1.0
        self.shards = max(1, math.ceil(total / shard_words))
        hot = sorted((r["word"] % 2**64, r["n"], r["n_target"]) for r in row["hot"])
        self.hot = np.array([w for w, *_ in hot], np.uint64)
        # in a shard a word goes by its lower half
        lower = sorted((w & 0xFFFFFFFF, n, t) for w, n, t in hot)
        self.hot_lower = np.array([w for w, *_ in lower], np.uint64)
        self.hot_counts = np.array([c for _, *c in lower], np.float64).reshape(-1, 2)
        # a pair is at most as frequent as either word
        firsts, seconds = np.array([w for w, n, _ in hot if n > most], np.uint64), np.array(sorted(w % 2**64 for w in row["second"]), np.uint64)
        pairs = []
        if len(firsts) and len(seconds):
            counted = texts.mapInArrow(_count_pairs(firsts, seconds), "pair bigint, n bigint, n_target bigint").groupBy("pair")
            pairs = sorted((r["pair"] % 2**64, r["n"], r["n_target"]) for r in counted.agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")).filter(F.col("n") > most).collect())
        self.pairs = np.array([p for p, *_ in pairs], np.uint64)
        self.pair_counts = np.array([c for _, *c in pairs], np.float64).reshape(-1, 2)

    def shard_of(self, first: np.ndarray, second: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Shards of pairs; doc tells the documents of the whole table apart."""
        key = first
        if len(self.hot):
            hot = _find(self.hot, first)[1]
            key = np.where(hot, ((first * _GOLDEN) ^ second) * _GOLDEN, first)  # unlike first ^ second, not the same for all repeated words
            if len(self.pairs):
                own = np.flatnonzero(hot)
                own = own[_find(self.pairs, _pair(first[own], second[own]))[1]]
                key[own] = doc[own] * _GOLDEN
        return ((key >> np.uint64(32)) % np.uint64(self.shards)).astype(np.int64)


_BLOCKS = "shard int, block bigint, ids array<string>, words array<bigint>, pairs binary, docs binary"


def _pack(corpus):
    """Blocks of up to ``_DOCS`` documents: a row with their ids, and rows of packed pairs per shard.

    A document is its place in the block, times two, plus one if it is target.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = corpus.value
        block = TaskContext.get().partitionId() << 32
        ids, words, held, size = [], [], [], 0

        def pairs() -> pa.RecordBatch:
            first = np.concatenate([h[:-1] for h, _ in held])
            second = np.concatenate([h[1:] for h, _ in held])
            docs = np.concatenate([np.full(len(h) - 1, d, np.uint16) for h, d in held])
            held.clear()
            shard = plan.shard_of(first, second, np.uint64((block << 15) % 2**64) + (docs >> 1))
            order = np.argsort(shard, kind="stable")
            pair = _pair(first, second)[order]
            docs, shard = docs[order], shard[order]
            starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            ends = np.r_[starts[1:], len(shard)]
            names = shard[starts].tolist()
            return _rows(names, [block] * len(names), [None] * len(names), [None] * len(names),
                         [pair[a:b].tobytes() for a, b in zip(starts, ends)], [docs[a:b].tobytes() for a, b in zip(starts, ends)])

        def close() -> pa.RecordBatch:
            return _rows([(block & 0xFFFFFFFF) % plan.shards], [block], [ids], [words], [None], [None])

        for batch in batches:
            for doc, text, target in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                n = 0
                for hashes in pieces(text.as_py()):
                    held.append((hashes, 2 * len(ids) + bool(target)))
                    n += len(hashes) - 1
                    size += len(hashes)
                    if size > _FLUSH:
                        yield pairs()
                        size = 0
                ids.append(doc)
                words.append(n)
                if len(ids) == _DOCS:
                    if held:
                        yield pairs()
                        size = 0
                    yield close()
                    block, ids, words = block + 1, [], []
        if held:
            yield pairs()
        if ids:
            yield close()

    return run


def _rows(*columns) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in _BLOCKS.split(", ")])


# --- scoring ---------------------------------------------------------------------------------------


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Group number of each element of sorted keys, and the sums of values per group."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(key)]))
    return group, [np.add.reduceat(v, starts) for v in values]


def differences(plan, pair: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, loss differences) of the pairs of a whole shard, or of some of its words; an odd document is target."""
    order = np.lexsort((doc, pair))
    pair, doc = pair[order], doc[order]
    one, target = np.ones(len(pair)), (doc & 1).astype(float)
    which, (n, n_target) = _sums(pair, one, target)
    n, n_target = n[which], n_target[which]
    if len(plan.pairs):  # counted over all shards; a document has all of its own in one
        at, hot = _find(plan.pairs, pair)
        n, n_target = np.where(hot, plan.pair_counts[at, 0], n), np.where(hot, plan.pair_counts[at, 1], n_target)
    own_key = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])])
    own = np.repeat(np.diff(np.r_[own_key, len(pair)]), np.diff(np.r_[own_key, len(pair)])).astype(float)

    word = pair >> np.uint64(32)
    of_word, (m, m_target) = _sums(word, one, target)
    m, m_target = m[of_word], m_target[of_word]
    by_doc = np.lexsort((doc, word))
    word_doc = np.flatnonzero(np.r_[True, (word[by_doc][1:] != word[by_doc][:-1]) | (doc[by_doc][1:] != doc[by_doc][:-1])])
    runs = np.diff(np.r_[word_doc, len(pair)])
    own_word = np.empty(len(pair))
    own_word[by_doc] = np.repeat(runs, runs)
    if len(plan.hot_lower):  # counted over all shards; a document's own share of them is too small to matter
        at, hot = _find(plan.hot_lower, word)
        m, m_target = np.where(hot, plan.hot_counts[at, 0], m), np.where(hot, plan.hot_counts[at, 1], m_target)
        own_word[hot] = 0

    background = plan.scale * (n - own) + ALPHA
    wanted = n_target - own * target + ALPHA
    of_background = plan.scale * (m - own_word) + plan.pseudo
    of_wanted = m_target - own_word * target + plan.pseudo
    return doc, np.log(background * of_wanted / (wanted * of_background))


def _in_chunks(plan, pair: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``differences`` of a whole shard, of some words after the other."""
    chunks = min(math.ceil(len(pair) / _CHUNK), 1 << 16)
    chunk = (((pair >> np.uint64(32)) * np.uint64(chunks)) >> np.uint64(32)).astype(np.uint16)
    order, ends = np.argsort(chunk, kind="stable"), np.cumsum(np.bincount(chunk, minlength=chunks))
    docs, losses = np.empty_like(doc), np.empty(len(pair))
    for a, b in zip([0, *ends[:-1]], ends):
        if a < b:
            docs[a:b], losses[a:b] = differences(plan, pair[order[a:b]], doc[order[a:b]])
    return docs, losses


_PARTS = "block bigint, ids array<string>, words array<bigint>, docs binary, sums binary"


def _score_shard(corpus):
    def run(key, table):
        blocks = table.column("block").to_pylist()
        number = {b: i for i, b in enumerate(sorted(set(blocks)))}
        out = [(b, ids.as_py(), words.as_py(), None, None) for b, ids, words in zip(blocks, table.column("ids"), table.column("words")) if ids.is_valid]
        filled = [(b, p.as_buffer(), d.as_buffer()) for b, p, d in zip(blocks, table.column("pairs"), table.column("docs")) if p.is_valid]
        if filled:
            pair = np.concatenate([np.frombuffer(p, np.uint64) for _, p, _ in filled])
            doc, at = np.empty(len(pair), np.int64), 0
            for b, _, d in filled:
                own = np.frombuffer(d, np.uint16)
                doc[at : at + len(own)] = own
                doc[at : at + len(own)] += number[b] * 2 * _DOCS
                at += len(own)
            doc, loss = _in_chunks(corpus.value, pair, doc)
            del pair
            doc >>= 1
            order = np.argsort(doc, kind="stable")
            doc = doc[order]
            _, (sums,) = _sums(doc, loss[order])
            doc = doc[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])]
            at = np.searchsorted(doc // _DOCS, np.arange(len(number) + 1))
            for b, i in number.items():
                if at[i] < at[i + 1]:
                    part = slice(at[i], at[i + 1])
                    out.append((b, None, None, (doc[part] % _DOCS).astype(np.uint16).tobytes(), sums[part].astype(np.float32).tobytes()))
        types = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.table({f.split()[0]: pa.array(list(c), t) for f, c, t in zip(_PARTS.split(", "), zip(*out) if out else [[]] * 5, types)})

    return run


def _add_up(key, table):
    """Documents of a block with the mean of their differences."""
    ids, words, total = [], [], np.zeros(_DOCS)
    for own, n, docs, sums in zip(*[table.column(c).to_pylist() for c in ("ids", "words", "docs", "sums")]):
        if own is not None:
            ids, words = own, n
        else:
            total[np.frombuffer(docs, np.uint16)] += np.frombuffer(sums, np.float32)
    words = np.array(words, np.int64)
    mean = total[: len(words)] / np.maximum(words, 1)
    return pa.table({"id": pa.array(ids, pa.string()), "n_words": pa.array(words), "score": pa.array(mean, mask=words == 0)})


def cross_entropy_difference(
    docs: DataFrame, target_ids: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS,
    most_buckets: int = MOST_BUCKETS,
) -> DataFrame:
    """``(id, n_words, score)`` of every row of ``docs``; the target is all documents whose id ``target_ids`` names."""
    marked = mark_targets(docs, target_ids, id_col=id_col, text_col=text_col, most_buckets=most_buckets)
    plan = docs.sparkSession.sparkContext.broadcast(Corpus(marked, shard_words))
    blocks = marked.mapInArrow(_pack(plan), _BLOCKS)
    parts = blocks.groupBy("shard").applyInArrow(_score_shard(plan), _PARTS)
    scored = parts.groupBy("block").applyInArrow(_add_up, "id string, n_words bigint, score double")
    key = docs.select(id_col).schema[0].dataType
    return scored.select(F.col("id").cast(key).alias(id_col), "n_words", "score")
