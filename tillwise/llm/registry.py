"""Queries over the given tables, one per operator of this package, and their SQL where SQL can say it."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    byte_bpe, chat_format, decontamination, hard_negatives, hilbert_ann, language_id, licences, lm_scoring, pca_dedup, secret_scan, simhash_dedup,
    source_mixing, spelling,
)
from tillwise.sources.shared import store

MAX_REPEATS = 2.0
SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
ROWS_PER_BATCH = 256
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Settings and code that the queries of this package need in a session.

    Texts can be long, so fewer rows go to Python at once. The package is sent to the executors once per
    application; they need not have it on their path.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tillwise-code-")
    code = shutil.ignore_patterns("__pycache__")
    shutil.copytree(package, f"{folder}/code/tillwise", ignore=code)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/tillwise", "zip", f"{folder}/code"))
    _SHIPPED.add(app)


def entry(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        SPARK[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@entry("op1_cross_entropy_difference")
def _(spark, table):
    return lm_scoring.cross_entropy_difference(table("documents"), table("labels").filter("quality = 1"))


@entry("op2_source_mixing")
def _(spark, table):
    text = F.col("text")
    docs = store(table("documents").select("doc_id", "source", source_mixing.count_tokens(text).alias("n_tokens"), F.xxhash64(text).alias("content")), "counted")
    mixed = source_mixing.mix(docs, tokens=F.col("n_tokens"), keys=["doc_id", "content"], max_repeats=MAX_REPEATS, prefix="")
    return mixed.drop("content")


@entry("op3_pca_tiled_dedup")
def _(spark, table):
    return pca_dedup.near_duplicates(table("embeddings"))


@entry("op4_chat_formatting")
def _(spark, table):
    said = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    added = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    every = table("conversations").select("conv_id", "turn", "role", "text").union(added)
    return chat_format.digest(chat_format.format_conversations(every))


@entry("op5_hilbert_neighbours")
def _(spark, table):
    return hilbert_ann.search(table("embeddings"), F.col("vec_id") % 50 == 0)


def byte_codec(spark: SparkSession) -> byte_bpe.Codec:
    import public_tokenizers

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.Codec(spark, ranks, public_tokenizers.PATTERN)


@entry("op6_byte_bpe")
def _(spark, table):
    codec = byte_codec(spark)
    return table("documents").select("doc_id", codec.round_trip(F.col("text")).alias("r")).select("doc_id", "r.*")


@entry("op7_language_id")
def _(spark, table):
    docs = table("documents")
    held_out = language_id.held_out(F.col("doc_id"))
    found = language_id.identify(docs, docs.filter(~F.coalesce(held_out, F.lit(False))))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@entry("op8_secret_scan")
def _(spark, table):
    return secret_scan.digest(secret_scan.scan(table("documents")))


@entry("op9_simhash_dedup")
def _(spark, table):
    return simhash_dedup.find(table("documents"))


def _licence_sql() -> str:
    """The lookup in SQL: the same normal form, and the known texts as rows."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"

    def form(column: str) -> str:
        out = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        out = f"regexp_replace({out}, {quoted(licences.STATED_COPYRIGHT.replace('(?md)', '(?m)'))}, ' ', 'g')"
        out = f"regexp_replace({out}, {quoted(licences.NOT_WORD)}, ' ', 'g')"
        for spelling, same in licences.SPELLINGS:
            out = f"replace({out}, '{spelling}', '{same}')"
        return f"trim({out}, ' ')"

    rows, digests = (", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known.items()) for known in (licences.KNOWN, licences.DIGESTS))
    return f"""
        WITH known AS (
            SELECT digest, min(license) AS license FROM (
                SELECT license, sha256({form('text')}) AS digest FROM (VALUES {rows}) t(license, text)
                UNION ALL SELECT * FROM (VALUES {digests}) t(license, digest)
            ) GROUP BY 1
        ), own AS (SELECT doc_id, sha256({form('text')}) AS digest FROM documents)
        SELECT doc_id, digest, license FROM own LEFT JOIN known USING (digest)"""


@entry("op10_licence_lookup", _licence_sql())
def _(spark, table):
    return licences.scan(table("documents"), licences.known_digests(spark))


_HARD_NEGATIVES = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS cells
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
               CAST(list_inner_product(a.cells, b.cells) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5"""


@entry("op11_hard_negatives", _HARD_NEGATIVES)
def _(spark, table):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table("embeddings"), F.col("vec_id") % 100 == 0, label)


@entry("op12_spelling_variants")
def _(spark, table):
    return spelling.group_variants(table("documents"))


_DECONTAMINATION = r"""
    WITH form AS (
        SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
    ), words AS (
        SELECT kind, id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM form
    ), items AS (SELECT id, w, least(len(w), 10) AS k FROM words WHERE kind = 'b' AND len(w) > 0),
    wins AS (
        SELECT DISTINCT id AS item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
        FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM items)
    ), places AS (
        SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS t
        FROM (SELECT id AS doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
              FROM words, (SELECT DISTINCT k FROM wins) WHERE kind = 'd')
    ), found AS (SELECT doc_id, i, k, item_id FROM places JOIN wins USING (k, t)),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY 1),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1
    )
    SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM words LEFT JOIN covered ON id = covered.doc_id LEFT JOIN named ON id = named.doc_id WHERE kind = 'd'"""


@entry("op13_benchmark_decontamination", _DECONTAMINATION)
def _(spark, table):
    return decontamination.scan(table("documents"), table("benchmark"))
