"""Registered queries of this subpackage: thin projections of the operators' outputs.

``QUERIES`` maps a name to ``fn(spark, sf_dir) -> DataFrame``; ``ORACLE`` has DuckDB
SQL for those that SQL can express over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm import (bpe, chat, exactdedup, merkle, mixing, neardup, quality, secrets, simhash, spelling, topk, toxicity,
                          urlfilter)
from cinerank.llm.common import table
from cinerank.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))
EXTRA_CONVERSATION = -7
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def op1_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    """Secrets of every document; owners are the sources, repositories a source's languages."""
    found = secrets.scan_secrets(table(spark, d, "documents"))
    return found.select(
        "doc_id", *[secrets.count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.col("all_spans")).alias("spans"),
        F.coalesce(F.size(F.filter("verdicts", lambda v: v["live"])), F.lit(0)).cast("long").alias("n_live"),
        F.coalesce(F.size(F.filter("verdicts", lambda v: ~v["live"])), F.lit(0)).cast("long").alias("n_copied"))


def op2_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    """All documents mixed to target weights 1, 2, 3 by source."""
    return mixing.mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def op4_chat_format(spark: SparkSession, d: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back from the format."""
    own = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(EXTRA_CONVERSATION, 0, "user", EXTRA_TEXT), (EXTRA_CONVERSATION, 1, "assistant", EXTRA_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(own.unionByName(extra))
    turns = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = out.withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    return loss.select("conv_id", F.size("parsed").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "identical")


def op5_url_filter(spark: SparkSession, d: str) -> DataFrame:
    """Every page judged by the five rules."""
    return urlfilter.judge_urls(table(spark, d, "pages"), urlfilter.rule_table(spark, URL_RULES))


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document and their decoding, as digests."""
    out = bpe.encode_documents(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Near duplicates of all documents on 2-word shingles."""
    return neardup.near_duplicates(table(spark, d, "documents"), width=2)


def op9_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Exact duplicates of all documents."""
    return exactdedup.exact_groups(table(spark, d, "documents"))


def op10_top_k(spark: SparkSession, d: str) -> DataFrame:
    """The 5 highest inner products of every query vector."""
    return topk.top_k(table(spark, d, "embeddings"))


def op11_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what its proof says after tampering."""
    return merkle.manifest(table(spark, d, "documents"))[1]


def op12_simhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    """SimHash fingerprints of all documents and their components within 2 bits."""
    return simhash.near_duplicates(table(spark, d, "documents"))


def op13_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    """Words of all documents with their spelling variants."""
    return spelling.variants(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_mix_sources": op2_mix_sources,
    "op3_quality": op3_quality,
    "op4_chat_format": op4_chat_format,
    "op5_url_filter": op5_url_filter,
    "op6_toxicity": op6_toxicity,
    "op7_bpe": op7_bpe,
    "op8_near_dedup": op8_near_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_top_k": op10_top_k,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_simhash_dedup": op12_simhash_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}
