"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, n: int, which: int) -> Column:
    """Whether crc32 of the id's text leaves ``which`` modulo ``n``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % n == which, F.lit(False))


def labelled(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label) of every labelled document.

    Null ids and labels don't count; of several labels of one document the largest does.
    """
    rows = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(label)).cast("int").alias("label"))


def labelled_sample(labels: DataFrame, label: str, bound: int, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label) of ``bound`` documents at most, the first by a hash of the id."""
    rows = labelled(labels, label, doc_id)
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def sample_texts(docs: DataFrame, sample: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, label, text) of the sample; the sample has a size bound, so it is broadcast."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return kept.join(F.broadcast(sample), "doc_id")
