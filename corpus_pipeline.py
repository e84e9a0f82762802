"""Corpus cleaning, from raw documents to packed training sequences.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir), works on all
rows that the one before it kept, and returns the columns of ``documents``, but
for the last, which returns packed pieces. ``run`` writes each stage's result
below ``spark.checkpoint.dir`` and reads it again for the next.

Null ids and texts, repeated rows, empty tables and further columns are
handled as the operators state; further columns of ``documents`` are kept.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox.llm import packing, quality, secret_ledger, simhash, superkmers
from farebox.llm.runtime import stored, table


def with_text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with a new text and, where there is such a column, its length."""
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns(changed)


def on_documents(stage):
    """Further columns of ``docs`` pass through under names of their own, so
    none can clash with what a stage adds."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        own = [c if c in ("doc_id", "text", "n_chars") else f"other_{i}" for i, c in enumerate(names)]
        return stage(spark, docs.toDF(*own), sf_dir).select(*own).toDF(*names)
    return run


@on_documents
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from those of
    ``docs`` that are labelled."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter(F.col("score") >= quality.CUT)


@on_documents
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest
    id (null ids come last), and of rows that share it, the one with the
    smallest text hash."""
    null_id = F.lit(-(1 << 63))
    groups = simhash.near_duplicates(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "version")
    chosen = (groups.groupBy("component").agg(F.min(order).alias("row"))
              .select(F.coalesce("row.doc_id", null_id).alias("key"), F.col("row.version").alias("version")))
    rows = docs.withColumns({"key": F.coalesce(F.col("doc_id").cast("long"), null_id),
                             "version": F.xxhash64(F.coalesce("text", F.lit("")))})
    kept = rows.join(chosen.distinct(), ["key", "version"], "left_semi")
    one = Window.partitionBy("key", "version").orderBy(F.lit(0))
    return kept.withColumn("place", F.row_number().over(one)).filter("place = 1")


@on_documents
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that also start earlier.
    Documents that lose nothing keep their text as it is; a document that
    loses all its words goes."""
    out = superkmers.remove_repeated_words(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    left = out.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return with_text(left, text)


@on_documents
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by its kind."""
    return with_text(secret_ledger.redact(docs), F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, with their ids."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates),
          ("repeated_passages", drop_repeated_passages), ("secrets", redact_secrets), ("packing", pack)]

# Fingerprints, learnt scores and retrieval cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
