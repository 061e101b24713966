"""SimHash near-duplicates found by covering locality-sensitive hashing.

Fingerprint: the text with A-Z lower-cased, words between ASCII white space, shingles of ``WORDS`` words
(repeats included); a bit is 1 if it is set in more than half of the shingles' 64-bit hashes.

Covering: every bit position carries one of the 2**(r+1) - 1 non-zero vectors of r + 1 bits. For each
non-zero vector v, mask v keeps the positions whose vector has an odd product with v. The at most r positions
in which two fingerprints differ span a space of dimension r, some v is orthogonal to all of them, and under
mask v the two are equal. So every pair within the radius meets in at least one of 2**(r+1) - 1 tables, and
each table keeps 4 of 7 positions for r = 2. Different fingerprints only are put into the tables, so that
copies cost nothing. A bucket with up to ``PAIRWISE`` fingerprints compares its pairs; a larger one (a dense
cloud of near copies) lists each fingerprint under itself and its one-bit neighbours outside the mask: two
fingerprints differ in at most two bits exactly if they share an entry. Neither drops a link.

Defined cases: a null or empty text, or one without words, has fingerprint 0 and links like any other; fewer
than ``WORDS`` words are one shingle; repeated rows keep a row each; a null id never becomes a component id
unless nothing else is in the component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tillwise.llm.components import components
from tillwise.sources.shared import store

WORDS = 3
RADIUS = 2
PAIRWISE = 32
_SEED = 42
_AT_ONCE = 1 << 16


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    n = max(1, len(words) - WORDS + 1)
    set_bits = np.zeros(64, np.int64)
    for start in range(0, n, _AT_ONCE):
        part = words[start: min(start + _AT_ONCE, n) + WORDS - 1]
        shingles = zip(*[part[i:] for i in range(WORDS)]) if len(words) >= WORDS else [words]
        hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, shingles), repeat(_SEED)), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


@pandas_udf(T.LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64))


def fingerprint_column(text: Column) -> Column:
    """Fingerprint as a signed long of the same 64 bits."""
    return _fingerprints(text)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One mask per table, as signed longs; position i carries vector 1 + i mod (2**(r+1) - 1)."""
    vectors = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(64) if ((1 + i % vectors) & v).bit_count() % 2)
        masks.append(mask - 2**64 if mask >= 2**63 else mask)
    return masks


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` between different fingerprints of column ``fp`` that connect all within the radius.

    Small buckets give every link; in large ones, the members of a shared one-bit neighbour give a star.
    """
    if radius != 2:
        raise ValueError("large buckets are split by one-bit neighbours, which fits a radius of 2 bits")
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(mask).alias("mask")) for t, mask in enumerate(covering_masks(radius))])
    rows = prints.select("fp", F.explode(tables).alias("x")).select(
        F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"), "fp", F.col("x.mask").alias("mask")
    )
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = store(rows.join(store(sizes, "buckets"), ["t", "key"]), "covered")

    small = rows.filter(F.col("n") <= PAIRWISE).select("t", "key", "fp")
    near = (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius)
    same = (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key"))
    pairs = small.alias("a").join(small.alias("b"), same & near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(-(2**63) if i == 63 else 1 << i).cast("bigint") for i in range(64)])
    dense = rows.filter(F.col("n") > PAIRWISE).select("t", "key", "fp", "mask", F.explode(flips).alias("flip"))
    dense = dense.filter(F.col("flip").bitwiseAND(F.col("mask")) == 0)  # bits under the mask are equal in a bucket
    spots = dense.groupBy("t", "key", F.col("fp").bitwiseXOR(F.col("flip")).alias("spot"))
    members = spots.agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)  # at most 65: the neighbours of one spot
    stars = members.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return pairs.union(stars).distinct()


def near_duplicates(fingerprints: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``(id, fp, root, component_id)`` of every row of ``(id, fp)``; the smallest id reachable by links.

    ``root`` is the component's smallest fingerprint.

    ``fingerprints`` is read several times: it should be a stored table.
    """
    different = store(fingerprints.groupBy("fp").agg(F.min(id_col).alias("first")), "different")
    roots = components(links(different))
    joined = different.join(roots, F.col("fp") == F.col("node"), "left")
    rooted = store(joined.select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    smallest = store(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = store(rooted.join(smallest, "root").select("fp", "root", "component_id"), "named")
    # both sides are stored: rows of a hot fingerprint can be split between tasks
    return fingerprints.join(named, "fp").select(id_col, "fp", "root", "component_id")


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint, component_id)`` of every row; the fingerprint as 16 hexadecimal digits."""
    prints = store(docs.select(F.col(id_col), fingerprint_column(F.col(text_col)).alias("fp")), "fingerprints")
    found = near_duplicates(prints, id_col=id_col)
    return found.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each component: the one of smallest id.

    Rows that repeat an id with the same fingerprint are copies, and one of them stays.
    """
    mark = "fp"
    while mark in docs.columns:
        mark += "_"
    stored = store(docs.withColumn(mark, fingerprint_column(F.col(text_col))), "marked")
    found = near_duplicates(stored.select(F.col(id_col), F.col(mark).alias("fp")), id_col=id_col)
    chosen = found.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy("root", "component_id").agg(F.min("fp").alias("fp"))
    same = stored[id_col].eqNullSafe(chosen["component_id"]) & (stored[mark] == chosen["fp"])
    return stored.join(chosen, same, "left_semi").dropDuplicates([id_col, mark]).drop(mark)
