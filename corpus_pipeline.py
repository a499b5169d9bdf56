"""A corpus pipeline of training-data operators: each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendlens.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from trendlens.llm.common import stored, table
from trendlens.llm.queries import vocabulary


def toxic_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the field rejects go."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def exact_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the largest doc_id stays."""
    return exact_dedup.dedup(docs)


def near_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component the smallest doc_id stays."""
    return ngram_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a row for each copy that the source weights take."""
    return mixing.mix(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: every row's ids, and the text decoded from them, as digests."""
    import public_tokenizers

    return bpe.round_trip(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxic_go),
    ("exact dedup", exact_copies_go),
    ("n-gram Jaccard join", near_copies_go),
    ("mixing", mixed),
    ("byte-level BPE", tokenized),
]

#: The toxicity model and the BPE ids can't be expressed in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
