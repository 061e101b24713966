"""Corpus pipeline: language, near copies, secrets, source mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last keep the columns of
``documents``. ``run`` writes each stage's result as Parquet in the shared folder and reads it back as the
next one's input. What the stages decide: documents whose language cannot be told go; one document of each
group of near copies stays; secrets in a text are replaced by their kind; sources are repeated towards an even
mix, none more than twice and none below once; texts become token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import language_id, secret_scan, simhash_dedup, source_mixing
from tillwise.llm.registry import MAX_REPEATS, byte_codec, prepare
from tillwise.sources.shared import store

LEAST_SCORE = 0.5


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; ``und`` and predictions below ``LEAST_SCORE`` go."""
    prepare(spark)
    held_out = F.coalesce(language_id.held_out(F.col("doc_id")), F.lit(False))
    predict = language_id.predictor(spark, language_id.train(docs.filter(~held_out)))
    found = _free(docs, "found")
    marked = docs.withColumn(found, predict(F.col("text")))
    kept = (F.col(found)["lang_pred"] != language_id.UNDETERMINED) & (F.col(found)["score"] >= LEAST_SCORE)
    return marked.filter(kept).drop(found)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect."""
    prepare(spark)
    return simhash_dedup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; ``n_chars`` counts the new text."""
    prepare(spark)
    found = _free(docs, "found")
    columns = {"text": F.col(found)["clean_text"], "n_chars": F.length(F.col(found)["clean_text"]).cast("bigint")}
    scanned = docs.withColumn(found, secret_scan.scan_column(F.col("text")))
    return scanned.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of smaller sources up to ``MAX_REPEATS`` times."""
    return source_mixing.mix_whole_rows(docs, keys=["doc_id", "text"], max_repeats=MAX_REPEATS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, source, ids, n_tokens)`` of every document that came through."""
    prepare(spark)
    ids = byte_codec(spark).encode(F.col("text"))
    return docs.select("doc_id", "source", ids.alias("ids")).withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]

# trained models, hashes and tokenisers: SQL cannot express the stages; tests compare them with plain code
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
