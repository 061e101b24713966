"""Benchmark decontamination by a prefix-filtered join of word shingles.

Words are maximal runs of ASCII letters and digits and of everything beyond ASCII, with A-Z lower-cased. A window is
``WINDOW`` consecutive words of an item, or all of them if there are fewer. A window is a set of shingles of
``SHINGLE`` words (fewer in a shorter window) with their places. All shingles of the windows are counted over all
documents and ordered by rarity. To hold a window whole, a text has to hold its rarest shingle: the necessary prefix
of a containment of 1 is one token. So documents list the places of prefix tokens only, Spark joins them with the
windows by token, and a pair is dropped if the window would start before the text (position) or end after it
(length). What is left is verified word by word on the ``WINDOW`` words in question.

Both passes over the texts look shingles up in a bitmap of 2**24 bits made by Spark (2 MB whatever the benchmark);
what it lets through wrongly only costs rows in the join. A place carries the few words around it, never the text.
Texts are handled in pieces of ``_PIECE`` bytes.

Defined cases: a null or empty text, or one without words, has 0 words and no hits; a null item text, or one
without words, has no window; items are told apart by id, and a null id counts as one item with an empty name;
rows that repeat a doc_id are rows of their own; equal windows of several items are one window with several
items; an empty table on either side gives no hits; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.sources.shared import store

WINDOW = 10
SHINGLE = 3
_BITS = 24
_PIECE = 1 << 22
# ASCII: letters and digits stay, A-Z as a-z, all else is a blank; bytes beyond ASCII stay
_FORM = bytes(
    b if b >= 0x80 or chr(b).isalnum() else ord(" ") for b in (b + 32 if 65 <= b <= 90 else b for b in range(256))
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FORM).split()


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words, as signed longs."""
    each = np.fromiter(map(crc32, words), np.uint64, len(words))
    size = max(len(words) - n + 1, 0)
    out = np.full(size, n * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
    for i in range(n):
        out = (out ^ each[i: i + size]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def _shingles(length: int) -> int:
    return min(SHINGLE, length)


# --- benchmark side --------------------------------------------------------------------------------


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(text)
            length = min(len(words), WINDOW)
            texts = [b" ".join(words[i: i + length]).decode() for i in range(len(words) - length + 1)] if words else []
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(texts), pa.string()), pa.array(texts, pa.string())], ["item", "words"])


def _list_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        window, token, place = [], [], []
        for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = text.encode().split(b" ")
            found = shingle_hashes(words, _shingles(len(words))).tolist()
            window += [number] * len(found)
            token += found
            place += range(len(found))
        yield pa.RecordBatch.from_arrays([pa.array(window, pa.int64()), pa.array(token, pa.int64()), pa.array(place, pa.int32())], ["win", "token", "place"])


def item_windows(items: DataFrame, *, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Different windows as ``(win, words, length)``, and ``(win, item)``; both stored."""
    own = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("binary").alias("text"))
    cut = store(own.mapInArrow(_cut, "item string, words string").distinct(), "cut")
    numbered = cut.select("words").distinct().withColumn("win", F.monotonically_increasing_id())
    windows = store(numbered.select("win", "words", F.size(F.split("words", " ")).alias("length")), "windows")
    return windows, store(cut.join(windows, "words").select("win", "item"), "members")


# --- document side ---------------------------------------------------------------------------------


def _slot(token):
    return F.shiftrightunsigned(token, 64 - _BITS)


def bitmap(tokens: DataFrame) -> Broadcast:
    """Bit per slot of the column ``token``; 512 pieces of 4 KB, however many tokens there are."""
    slot = _slot(F.col("token")) + 1
    parts = tokens.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    whole = np.zeros(1 << (_BITS - 3), np.uint8)
    for row in parts.toArrow().to_pylist():
        whole[(row["part"] - 1) << 12: row["part"] << 12] = np.frombuffer(row["bits"], np.uint8)
    return tokens.sparkSession.sparkContext.broadcast(whole)


def _listed(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Places of the tokens whose bit is set."""
    slot = tokens.view(np.uint64) >> np.uint64(64 - _BITS)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).nonzero()[0]


def pieces(text: bytes | None) -> Iterator[tuple[int, list[bytes], int, int]]:
    """``(base, words, first, last)``: words from place ``base`` of the text on, of which ``first`` to ``last`` are due.

    Each place is due once, with up to ``WINDOW`` words before and after it.
    """
    text = (text or b"").translate(_FORM)
    base, first, words, at = 0, 0, [], 0
    while True:
        end = len(text) if at + _PIECE >= len(text) else text.rfind(b" ", at, at + _PIECE) + 1
        if end <= at:  # one word fills the piece
            end = text.find(b" ", at) + 1 or len(text)
        words = words + text[at:end].split()
        at = end
        last = len(words) if at == len(text) else max(len(words) - WINDOW, first)
        yield base, words, first, last
        if at == len(text):
            return
        gone = max(last - WINDOW, 0)
        base, first, words = base + gone, last - gone, words[gone:]


def _count(bits: Broadcast, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0):
                for _, words, first, last in pieces(text.as_py()):
                    for n in sizes:
                        tokens = shingle_hashes(words[first: last + n - 1], n)
                        found.append(tokens[_listed(bits.value, tokens)])
            token, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(n, pa.int64())], ["token", "n"])

    return run


_SEEN = "row bigint, doc_id string, n_words bigint, token bigint, at bigint, near string, left int"


def _locate(bits: Broadcast, sizes: list[int]):
    """A row ``(row, doc_id, n_words)`` per document, and one per place of a listed token, with the words around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n_words, places = 0, len(out)
                for base, words, first, last in pieces(text.as_py()):
                    n_words = base + len(words)
                    for n in sizes:
                        tokens = shingle_hashes(words[first: last + n - 1], n)
                        for i in _listed(bits.value, tokens).tolist():
                            at, left = first + i, min(first + i, WINDOW - n)
                            near = b" ".join(words[at - left: at + WINDOW]).decode()
                            out.append((number, None, None, int(tokens[i]), base + at, near, left))
                out = out[:places] + [(*r[:2], n_words, *r[3:]) for r in out[places:]] + [(number, doc, n_words, None, None, None, None)]
                number += 1
                if len(out) > 1 << 14:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in _SEEN.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)], names)


def prefixes(windows: DataFrame, texts: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows with ``(token, place)`` of their rarest shingle in ``texts``; windows of which one is nowhere are left out."""
    listed = store(windows.select("win", "words").mapInArrow(_list_shingles, "win bigint, token bigint, place int"), "shingles")
    counts = texts.mapInArrow(_count(bitmap(listed.select("token")), sizes), "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    # the bitmap lets other shingles through; only those of windows are kept
    counts = store(counts.join(listed.select("token").distinct(), "token", "left_semi"), "counts")
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place")
    rarest = listed.join(counts, "token", "left").groupBy("win").agg(F.min(rarity).alias("r")).filter("r.n > 0")
    return store(windows.join(rarest.select("win", "r.token", "r.place"), "win"), "prefixes")


def decontaminate(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What of ``items`` occurs in ``docs``, as three tables.

    ``documents`` (row, doc_id, n_words) has every document, ``found`` (row, start, length, win) every occurrence
    of a window, ``members`` (win, item) the items of each window. ``row`` numbers the rows of ``docs``.
    """
    windows, members = item_windows(items, id_col=item_col, text_col=item_text_col)
    sizes = sorted(r[0] for r in windows.select(F.least("length", F.lit(SHINGLE))).distinct().collect())  # 1 to SHINGLE
    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    known = prefixes(windows, texts.select("text"), sizes)
    seen = store(texts.mapInArrow(_locate(bitmap(known), sizes), _SEEN), "seen")

    places = seen.filter("token is not null").select("row", "n_words", "token", "at", "near", "left")
    start = F.col("at") - F.col("place")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    same = F.array_join(F.slice(F.split("near", " "), F.col("left") - F.col("place") + 1, F.col("length")), " ") == F.col("words")
    pairs = places.join(known, "token").filter(fits).filter(same)
    found = store(pairs.select("row", start.alias("start"), "length", "win"), "found")
    key = docs.select(id_col).schema[0].dataType
    return seen.filter("token is null").select("row", F.col("doc_id").cast(key).alias(id_col), "n_words"), found, members


def hits(documents: DataFrame, found: DataFrame, members: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``(id, n_words, n_hit, n_items, items, contaminated)`` of every document; ``items`` is sorted as text."""
    ends = found.groupBy("row", "start").agg(F.max("length").alias("length")).withColumn("end", F.col("start") + F.col("length"))
    before = F.max("end").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0))
    covered = ends.withColumn("new", new).groupBy("row").agg(F.sum("new").alias("n_hit"))
    named = found.select("row", "win").distinct().join(members, "win").select("row", "item").distinct()
    listed = named.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = documents.join(covered, "row", "left").join(listed, "row", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return out.select(id_col, "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), items.alias("items"), (n_hit > 0).alias("contaminated"))


def scan(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``hits`` with the digest of the items in place of their list."""
    found = hits(*decontaminate(docs, items))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")
