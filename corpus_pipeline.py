"""The corpus pipeline: language, quality, near-duplicates, secrets, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``; further columns are passed on. Stages work on what their predecessor kept.

Defined results: a stage handles null and empty texts as its operator does; of repeated
rows near-duplicates keep one; an empty table gives an empty result.

The stages share executors, so they bound the session's Arrow batches (``small_batches``).
"""

from __future__ import annotations

import functools
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citegraph.llm import lang_id, near_dups, packing, quality, secrets
from citegraph.llm.common import materialize, prefixed, small_batches, table
from citegraph.llm.queries import VOCABULARY
from citegraph.plans.materialize import broadcast_if_small, checkpoint_dir

#: A language below this probability is not told from the others.
MIN_LANGUAGE = 0.4
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def shielded(stage):
    """The stage with columns beyond those of documents under names that it does not use."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        names = {c: c if c in COLUMNS else f"extra_{n}" for n, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*(docs[c].alias(name) for c, name in names.items())), sf_dir)
        return out.select(*(out[name].alias(c) for c, name in names.items()))

    return run_stage


@shielded
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those whose language cannot be told."""
    model = spark.sparkContext.broadcast(lang_id.train(docs, F.lit(True), F.col("doc_id")))
    said = docs.withColumn("_p", lang_id.predict(F.col("text"), model))
    kept = (F.col("_p.lang_pred") != lang_id.UNKNOWN) & (F.col("_p.score") >= MIN_LANGUAGE)
    return said.where(kept).drop("_p")


@shielded
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail the base rule or are more probably bad than good."""
    return quality.quality_scores(docs).where("kept").select(*docs.columns)


@shielded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group, one row of it.

    What is joined to the documents is one row per group, not the groups.
    """
    found = near_dups.near_duplicates(prefixed(docs, "doc_id", "text")).where("kept")
    picked = found.groupBy("component", "doc_id").agg(F.min("text_key").alias("text_key"), F.count("*").alias("rows"))
    picked = materialize(picked.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), "rows"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_text"))
    kept = docs.join(broadcast_if_small(picked), same)
    if picked.where("rows > 1").isEmpty():
        return kept.select(*docs.columns)
    alone, repeated = kept.where("rows = 1"), kept.where("rows > 1").dropDuplicates(["_id", "_text"])
    return alone.unionByName(repeated).select(*docs.columns)


@shielded
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by its kind; ``n_chars`` follows."""
    return secrets.redact_secrets(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of 1024 ids."""
    small_batches(spark)
    return packing.pack(prefixed(docs, "doc_id", "text"), public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language", language),
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scans),
    ("packing", pack),
]

#: The model fits and the library's tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
