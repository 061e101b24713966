"""Spelling variants: words one edit apart, found by pairs of trie nodes.

Words are sorted, and in that order the nodes of their trie are numbered: a word shares the nodes of its common
prefix with the word before and gets new numbers from there on. Sorting is by ranges in Spark; a task numbers its
range with its own numbers, and prefixes that go on across the border of two ranges get one number afterwards from
the first and last word of each range. Reversed words give the nodes of suffixes in the same way.

A word of L code points has the pairs (node before, node after) of its L skipped positions and of its L + 1 splits.
Two words differ by a replaced code point exactly if they share a skip pair, and one is the other with a code point
inserted exactly if a skip pair of the longer is a split pair of the shorter. As nodes are strings of their own, a
shared pair needs no further check. Deleting any code point of a run of equal ones gives one word; only the first of
the run stands for that. Words that share a pair differ in one code point, so they are as many as the alphabet has
letters at most, and of each pair only counts and the best two are passed on, never its pairs of words.

The form of a word is its near word of largest count if that is ``RATIO`` times its own at least; forms of forms lead
to the root, by pointer doubling (counts grow by the ratio each time, so chains are short).

Defined cases: a null or empty text has no words; a null doc_id deletes no code point; repeated rows count as often
as they occur; equal counts are ordered by code points; an empty table, or one without words that occur often
enough, gives an empty result; a run is whole however long it is; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.sources.shared import store

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, *, drop_one_in: int | None = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of the words of at least ``LEAST_LENGTH`` code points that occur ``LEAST_COUNT`` times.

    With ``drop_one_in`` a run loses a code point if that number divides the crc32 of ``<id>:<run>``, at the crc32's
    remainder by the run's length.
    """
    runs = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"({LETTERS}{{{LEAST_LENGTH},}})"), F.lit(1)))
    found = docs.select(F.col(id_col).cast("string").alias("id"), runs.alias("run")).select("id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    word = F.col("run")
    if drop_one_in:
        found = found.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
        less = F.concat(F.substring("run", F.lit(1), F.col("at")), F.substring("run", F.col("at") + 2, F.length("run")))
        word = F.when(F.coalesce(F.col("h") % drop_one_in == 0, F.lit(False)), less).otherwise(word)
    counts = found.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return store(counts.filter(F.col("n") >= LEAST_COUNT), "words")


# --- tries -----------------------------------------------------------------------------------------


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each word's prefixes, the empty one (0) first; words come in order."""
    part = TaskContext.get().partitionId()
    row, fresh = part << 33, (part << 40) + 1
    before, path = "", [0]
    for batch in batches:
        paths, offsets = [], [0]
        words = batch.column(0).to_pylist()
        for word in words:
            shared = _common(before, word)
            path = path[: shared + 1] + list(range(fresh, fresh + len(word) - shared))
            fresh += len(word) - shared
            before = word
            paths += path
            offsets.append(len(paths))
        nodes = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(paths, pa.int64())).cast(pa.list_(pa.int64()))
        place = pa.array(np.arange(row, row + len(words)), pa.int64())
        row += len(words)
        yield pa.RecordBatch.from_arrays([place, batch.column(0), batch.column(1), nodes], ["place", "word", "v", "nodes"])


def numbered(words: DataFrame) -> DataFrame:
    """``(place, word, v, nodes)`` of ``(word, v)``: place in the order of words, and the trie nodes of its prefixes.

    Nodes are numbered by range; ``border_nodes`` tells which numbers mean the same.
    """
    ordered = words.repartitionByRange("word").sortWithinPartitions("word")
    return store(ordered.mapInArrow(_number, "place bigint, word string, v bigint, nodes array<bigint>"), "trie")


def border_nodes(trie: DataFrame) -> Broadcast:
    """Numbers given twice, and the number of the first range for each, as two sorted arrays.

    Read from the first and last word of each range: two rows per task.
    """
    row = F.struct("word", "nodes")
    ends = trie.groupBy(F.shiftright("place", 33).alias("part")).agg(F.min_by(row, "place").alias("first"), F.max_by(row, "place").alias("last"))
    same: dict[int, int] = {}
    word, path = "", [0]
    for r in ends.orderBy("part").toLocalIterator():
        shared = _common(word, r["first"]["word"])
        same |= zip(r["first"]["nodes"][1: shared + 1], path[1: shared + 1])
        word, path = r["last"]["word"], [same.get(x, x) for x in r["last"]["nodes"]]
    keys = np.array(sorted(same), np.int64)
    return trie.sparkSession.sparkContext.broadcast((keys, np.array([same[x] for x in keys.tolist()], np.int64)))


def _settled(nodes: np.ndarray, same: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    keys, values = same
    if not len(keys):
        return nodes
    at = np.minimum(np.searchsorted(keys, nodes), len(keys) - 1)
    return np.where(keys[at] == nodes, values[at], nodes)


def _list_pairs(forward: Broadcast, backward: Broadcast):
    """Skip and split pairs of (no, n, word, before, after); ``gone``: this skip stands for the word without the code point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            no, n, words, before, after = batch.columns
            before_at, after_at = (np.asarray(c.offsets)[:-1].astype(np.int64) - c.offsets[0].as_py() for c in (before, after))
            before = _settled(before.flatten().to_numpy(), forward.value)
            after = _settled(after.flatten().to_numpy(), backward.value)
            text = words.to_pylist()
            length = np.fromiter(map(len, text), np.int64, len(text))
            letters = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
            for split in (0, 1):
                size = length + split
                word = np.repeat(np.arange(len(text)), size)
                i = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                gone = np.zeros(len(i), bool) if split else (i == 0) | (letters != np.roll(letters, 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(before[before_at[word] + i]), pa.array(after[after_at[word] + length[word] - i - 1 + split]),
                    no.take(pa.array(word)), n.take(pa.array(word)), pa.array(np.full(len(i), split), pa.int32()), pa.array(gone),
                ], ["before", "after", "no", "n", "split", "gone"])

    return run


def near_words(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(no, word, n)`` of ``(word, n)`` in code-point order, and ``(no, n_near, best_n, best)`` of words with a near one.

    ``best`` is the number of the near word of largest count, the first in order among equals.
    """
    trie = numbered(words.select("word", F.col("n").alias("v")))
    back = numbered(trie.select(F.reverse("word").alias("word"), F.col("place").alias("v")))
    joined = trie.withColumnsRenamed({"place": "no", "v": "n", "nodes": "before"}).join(
        back.select(F.col("v").alias("no"), F.col("nodes").alias("after")), "no")
    listed = joined.select("no", "n", "word", "before", "after").mapInArrow(
        _list_pairs(border_nodes(trie), border_nodes(back)), "before bigint, after bigint, no bigint, n bigint, split int, gone boolean")

    is_skip, gone = F.col("split") == 0, F.col("gone")
    own = F.struct("n", (-F.col("no")).alias("minus"))  # the larger, the better
    pair = Window.partitionBy("before", "after").orderBy("split", F.desc("n"), "no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = listed.select(
        "no", "split", "gone",
        F.sum(F.lit(1) - F.col("split")).over(pair).alias("skips"), F.sum((is_skip & gone).cast("int")).over(pair).alias("shorter"),
        own.alias("own"), F.first(own).over(pair).alias("first"),
        F.nth_value(F.when(is_skip, own), 2).over(pair).alias("second"),
        F.max(F.when(is_skip & gone, own)).over(pair).alias("longer"), F.max(F.when(~is_skip, own)).over(pair).alias("whole"),
    )
    other = F.when(F.col("first") == F.col("own"), F.col("second")).otherwise(F.col("first"))
    best = F.when(is_skip, F.greatest(other, F.when(gone, F.col("whole")))).otherwise(F.col("longer"))
    count = F.when(is_skip, F.col("skips") - 1 + (gone & F.col("whole").isNotNull()).cast("int")).otherwise(F.col("shorter"))
    some = seen.select("no", count.alias("n_near"), best.alias("best")).filter("n_near > 0")
    near = some.groupBy("no").agg(F.sum("n_near").cast("bigint").alias("n_near"), F.max("best").alias("best"))
    near = store(near.select("no", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.minus")).alias("best")), "near")
    return trie.select(F.col("place").alias("no"), "word", F.col("v").alias("n")), near


def roots(forms: DataFrame) -> DataFrame:
    """``(no, root)`` of ``(no, form)``: the last word that forms lead to. Each round doubles the steps taken."""
    state = store(forms.select("no", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("no").alias("root"), F.col("root").alias("next"))
        after = store(state.join(further, "root", "left").select("no", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if after.filter("moved").isEmpty():
            return after.drop("moved")
        state = after.drop("moved")


def variants(words: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every row of ``(word, n)``; words are distinct."""
    listed, near = near_words(words)
    enough = F.col("best_n") >= F.col("n") * ratio
    state = listed.join(near, "no", "left").select(
        "no", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n"))
    state = store(state, "state")
    known = roots(state.filter("form is not null").select("no", "form"))
    name: Column = F.col("word")
    chosen = state.filter("form is not null").join(known, "no")
    for key, text in (("form", "form_word"), ("root", "root_word")):
        chosen = chosen.join(listed.select(F.col("no").alias(key), name.alias(text)), key)
    chosen = chosen.select("word", "n", "n_near", F.col("form_word").alias("form"), "form_n", F.col("root_word").alias("root"))
    alone = state.filter("form is null").select("word", "n", "n_near", F.lit(None).cast("string").alias("form"), "form_n", name.alias("root"))
    return alone.union(chosen)


def group_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Variants of all words of the texts."""
    return variants(word_counts(docs, id_col=id_col, text_col=text_col))
