"""Registered queries of the operators and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, digest_index, lattice, lexical, merkle, packing, quality, secret_ledger, simhash, suffixes,
               superkmers, topk, toxicity)
from .oracle import SQL  # noqa: F401
from .runtime import table


def op1_lattice_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of each document, and the SHA-256 of the text they spell."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lattice.sample_pieces(docs, model, back=True)
    return out.select("doc_id", "n_pieces", "ids", F.sha2("text", 256).alias("text_sha256"))


def op2_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def op3_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    out = quality.score(docs, model, keep=["doc_id"])
    return out.select("doc_id", quality.held_out().alias("held_out"), "score",
                      (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def op4_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents come in two commits by source, so the second one meets a
    ledger that is not empty."""
    out = secret_ledger.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text", "source"),
                                     commit=F.pmod(F.xxhash64("source"), F.lit(2)), commits=2)
    counts = [F.size(F.filter("spans", lambda x: x["kind"] == F.lit(k))).cast("long").alias(f"n_{k}")
              for k in ("assign", "access", "hex")]
    base = F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    return out.select("doc_id", *counts,
                      F.sha2(secret_ledger.joined(base), 256).alias("base_sha256"),
                      secret_ledger.joined("spans").alias("spans"))


def op5_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id")


def op6_adaptive_dimension_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op7_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model, keep=["doc_id"])
    return out.select("doc_id", quality.held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_sparse_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = superkmers.remove_repeated_words(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_tiled_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op11_blocked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document's text is tampered with; its proof then fails. A
    null id is never tampered with."""
    docs = table(spark, sf_dir, "documents")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cells = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = F.when(chosen, merkle.leaf(*cells, F.translate("text", upper, lower)))
    rows = docs.select("doc_id", "source", merkle.leaf(*cells, F.col("text")).alias("leaf"), other.alias("tampered"))
    out, root = merkle.dataset_manifest(rows, "source", "doc_id")
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    return out.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"),
                      F.sha2(merkle.siblings(F.col("steps")), 256).alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_digest_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents come in two loads by source, so the second one meets an
    index that is not empty."""
    docs = table(spark, sf_dir, "documents")
    out = digest_index.deduplicate(docs, batch=F.pmod(F.xxhash64("source"), F.lit(2)), batches=2)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {
    "op1_lattice_sampling": op1_lattice_sampling,
    "op2_retrieval_packing": op2_retrieval_packing,
    "op3_bradley_terry_quality": op3_bradley_terry_quality,
    "op4_blob_ledger_secrets": op4_blob_ledger_secrets,
    "op5_simhash_pigeonring": op5_simhash_pigeonring,
    "op6_adaptive_dimension_ann": op6_adaptive_dimension_ann,
    "op7_boosted_toxicity": op7_boosted_toxicity,
    "op8_sparse_suffix_arrays": op8_sparse_suffix_arrays,
    "op9_super_kmer_dedup": op9_super_kmer_dedup,
    "op10_tiled_top_k": op10_tiled_top_k,
    "op11_blocked_lexical_search": op11_blocked_lexical_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_digest_index_dedup": op13_digest_index_dedup,
}


