"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

``run(spark, sf_dir)`` reads ``documents`` (and ``benchmark``) of a folder and
applies the stages in order. Each stage's result is written as Parquet to the
shared checkpoint folder and read again as the next stage's input, so a lost
executor or a failed stage never costs the stages before it.

All stages but the last return the columns of ``documents``.

Defined results, for every stage: columns other than those named pass through
under their own names, whatever these are; an empty table stays empty; texts
are read whole. What nulls, empty texts, ties and repeated rows mean is said at
each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import decontam, language_id, line_dedup, near_dup, packing
from stockledger.llm.catalog import WORD_BPE
from stockledger.llm.common import table, written

#: SQL cannot express the language classifier or the tokenizer; the tests hold a brute-force version against run().
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the classifier learns from ``docs`` itself.

    Null, empty and letterless texts go (no language), as do texts beyond the
    rejection distance; equally near languages go to the first by name, which
    decides nothing here. Repeated rows are judged one by one. Without any
    label no language is known, and all documents go.
    """
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand earlier; documents of which nothing is left go.

    ``n_chars`` follows the text where lines went. Null texts have no lines and
    stay, as do empty ones that lost no line. The first of alike lines by
    (doc_id, line) stays; rows that repeat an id and a text lose the same lines.
    """
    kept = line_dedup.dedup_lines(docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c in ("n_lines", "n_removed")}))
    kept = kept.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, size).otherwise(F.col("n_chars")))
    own = [F.col(f"__own_{c}").alias(c) if c in ("n_lines", "n_removed") else F.col(c) for c in docs.columns]
    return kept.select(*own)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more.

    The smallest (doc_id, hash of the text) of a group stays, once if its row is
    repeated. Null and blank texts are near copies of nothing and stay.
    """
    return near_dup.keep_one(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``.

    Null and empty texts have no words, are not contaminated and stay; repeated
    rows are judged alike. An empty benchmark contaminates nothing.
    """
    return decontam.filter_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens.

    A null or empty text is its closing id alone. Repeated rows are packed as
    often as they stand; equal lengths are placed by rank, so ties decide only
    which of two equal pieces fills which place.
    """
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near_copies),
    ("decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
