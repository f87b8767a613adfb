"""Cleaning of a corpus in five stages, each written and read again: toxicity, near-duplicates, repeated passages,
benchmark leaks, and SentencePiece ids with merge-dropout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import decontaminate, merge_dropout, near_dedup, substring_dedup, toxicity
from tickforge.llm.labelled import remainder
from tickforge.llm.shared import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt on the labelled ones that are still here, does not reject.

    Null and empty texts are scored like others, rows without doc_id too; repeated rows share their fate; without labels
    or documents nothing is rejected; a very long text is scored whole, sentence by sentence.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.not_toxic(docs, toxicity.fit(docs, labels, remainder(4) == 2))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8: the least doc_id.

    Texts without words and rows without doc_id stay; rows that repeat a doc_id stay or go together.
    """
    return near_dedup.keep_one(docs, k=5, num=80, den=100)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words and more that stand in a lesser doc_id or earlier in the same text.

    Null texts and rows without doc_id stay as they are; rows that share a doc_id are cut each for itself.
    """
    return substring_dedup.without_repeats(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within a fifth of its words.

    Null texts and rows without doc_id stay; rows that share a doc_id go together; without a benchmark all stay.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and the text that they decode to, per document; null where the text is null, no ids where it is empty."""
    out = merge_dropout.encode(docs.select("doc_id", "text"), decoded="decoded")
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.col("decoded").alias("text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode),
]

#: Classifiers, chunk digests and seeded merges are not SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last one's rows. Empty tables give no rows; extra columns go through all stages but the last."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
