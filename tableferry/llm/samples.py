"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import held_out


def one_label(labels: DataFrame, column: str, pick: str = "max") -> DataFrame:
    """(doc_id, label) with one row per labelled id; of several labels the largest or smallest.

    Rows without an id or a label are left out.
    """
    value = F.col(column).cast("int")
    chosen = (F.max if pick == "max" else F.min)(value)
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    return rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(chosen.alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` labelled documents that are not held out.

    Chosen by a hash of the id, so that the same tables give the same sample. The sample of the
    labels has at most ``bound`` rows; that makes it safe to broadcast. Of rows that repeat a
    doc_id, the one whose text has the smallest hash is taken.
    """
    usable = labels.where(~held_out(F.col("doc_id")))
    total = usable.count()
    share = min(1.0, 0.9 * bound / total) if total > bound else 1.0
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label")
    return found.agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")
