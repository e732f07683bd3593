"""From raw documents to token ids: language, near duplicates, privacy, mixture, encoding.

Each stage reads what the one before it has written, as Parquet in the shared folder. All but
the last return the columns of ``documents``.

- language: rejects documents without a letter, and those of whose text no language explains
  a quarter. Everything else stays, documents in several languages among it.
- near_duplicates: one document of each class of n-gram Jaccard links stays, the least doc_id.
- privacy: personal data and secrets become surrogates; no document goes.
- mixture: documents stay, go or repeat as their source's target asks.
- encoding: token ids per document.

Columns that are not known to a stage pass through unchanged, whatever their names. Null texts and texts without
a letter end at the first stage.

The surrogates' secret key comes from the session setting ``spark.milepost.surrogate.secret``. Without
it a random key is drawn once per session: its surrogates agree within the session only.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.llm import bpe, language, mixing, ngram_join, surrogates
from milepost.llm.queries import SURROGATE_KEY, VOCABULARY
from milepost.llm.tables import small_batches, store_texts, table, with_clear_names

LEAST_SCORE = 0.25
MIX_NAMES = ("_id", "_mark", "_own", "_place", "_rows", "_source", "_text_mark", "_times", "_turn")
SECRET = "spark.milepost.surrogate.secret"

# SQL cannot express the first stage.
ORACLE_SQL = None


def surrogate_key(spark: SparkSession) -> bytes:
    """The session's secret key; the public one of the tests is refused."""
    key = spark.conf.get(SECRET, None)
    if key is None:
        key = secrets.token_hex(32)
        spark.conf.set(SECRET, key)
    if key.encode() == SURROGATE_KEY:
        raise ValueError(f"set {SECRET} to a secret of your own")
    return key.encode()


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and a main language; null and blank texts go."""
    small_batches(spark)

    def work(rows: DataFrame) -> DataFrame:
        found = language.identify_languages(rows, language.learn_languages(rows))
        known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
        return found.where(known).select(*rows.columns)

    return with_clear_names(docs, ("lang_pred", "score", "mixture", "_lower", "_letter"), work)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class; those without doc_id, and different texts under one, all stay."""
    small_batches(spark)
    return with_clear_names(docs, ("class_id", "n_links"), ngram_join.keep_one_of_each)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in their texts and ``n_chars`` as long as these; null texts stay null."""
    key = surrogate_key(spark)
    small_batches(spark)

    def work(rows: DataFrame) -> DataFrame:
        done = surrogates.replace_private(rows, key)
        if "n_chars" in rows.columns:
            done = done.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
        return done.select(*rows.columns)

    return with_clear_names(docs, ("n_entities", "_changed", "_later", "_text_key"), work)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a text without words is never taken."""
    return with_clear_names(docs, MIX_NAMES, mixing.apply_mix)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document; a null text has none."""
    small_batches(spark)
    done = bpe.encode_texts(docs.select("doc_id", "source", "text"), bpe.Vocabulary(VOCABULARY))
    return done.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("privacy", hide_private),
    ("mixture", mix),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store_texts(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
