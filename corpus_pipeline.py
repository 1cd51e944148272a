"""Corpus pipeline: quality filter, exact and near duplicates, source mix, BPE ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` applies them to
``documents``, writing every stage's result as Parquet in the shared folder and reading
it again as the next one's input.  All stages but the last return the columns of
``documents``; the last returns doc_id, n_tokens, ids_le and decoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cinerank.config import materialize
from cinerank.llm import bpe, exactdedup, mixing, neardup, quality
from cinerank.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the largest doc_id."""
    return exactdedup.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8)."""
    return neardup.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.apply_mix(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoding."""
    return bpe.encode_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality classifier", quality_filter), ("exact dedup", exact_dedup), ("MinHash near-dedup", near_dedup),
          ("mixing sources", mix_sources), ("BPE encoding", bpe_encode)]

#: A trained classifier, a seeded draw and a tokenizer have no SQL form; tests compare
#: every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
