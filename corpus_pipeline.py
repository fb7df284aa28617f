"""Corpus preparation: five stages over ``documents``, each a thin call of an
operator of ``chronodim.llm``.

Every function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronodim.llm import bpe, decontaminate, quality, simhash, suffix_dedup
from chronodim.llm.common import stage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that of the smallest id."""
    return simhash.keep_one(docs, shingle=3, max_distance=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated 200-byte strings go; every document stays."""
    return suffix_dedup.cut(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit),
    ids_sha256 and decoded_sha256 of every document left."""
    out = bpe.bpe(docs, bpe.default_path())
    return bpe.digests(out, "ids").select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_free),
    ("bpe_encoding", tokens),
]

#: SQL can't express the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
