"""From raw documents to token digests: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir). All but the last return rows of ``docs`` with all their
columns; the last returns doc_id, n_tokens, ids_sha256 and decoded_sha256. Nulls, empty texts,
repeated rows and further columns are treated as the operators' modules say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tableferry.llm import bpe, decontaminate, exact_dedup, ngram_join, quality
from tableferry.llm.common import ship, small_batches, table
from tableferry.session import written

TOKENIZER = "byte_bpe_50k.json"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    small_batches(ship(spark))
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for A-Z case) the row with the largest doc_id."""
    small_batches(ship(spark))
    return exact_dedup.deduplicated(docs, keep="largest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id."""
    small_batches(ship(spark))
    return ngram_join.one_per_group(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(ship(spark))
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every remaining document."""
    small_batches(ship(spark))
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("decontamination", benchmark_free),
    ("bpe", tokens),
]

# The first stage's model cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
