"""Bounded, reproducible samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most documents of either class that a classifier is fitted on.
MAX_PER_CLASS = 5000


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo `modulus`; a null doc_id has none."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def training_rows(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: int = MAX_PER_CLASS) -> DataFrame:
    """(doc_id, text, label) of at most `per_class` documents of each class, least hash of doc_id first, never held-out ones."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(~held_out & F.col("label").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    # At most 2 * per_class pairs of numbers: small enough for every executor whatever the corpus.
    ids = F.broadcast(picked[0].union(picked[1]))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(ids, "doc_id")
