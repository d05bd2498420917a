"""Corpus pipeline: quality, near-duplicates, benchmark leaks, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and reread as the next stage's ``docs``; all but the last keep the columns of ``documents``.

Defined cases: null texts are empty; a row without a ``doc_id`` is never a duplicate; equal
rows (same ``doc_id`` and text) count as one document and one stays, rows that share a
``doc_id`` with different texts are each decided in their own text's group, so one row of
each group stays; empty tables give empty results; without labels of both classes the quality stage keeps
everything (class 1 only) or nothing; further columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.llm import decontamination, line_quality, ngram_join, packing
from paritas.llm.common import free_name, read, written
from paritas.llm.queries import QUALITY_BOUND, learnable
from paritas.llm.tokens import default_vocabulary

SHINGLE_WORDS, SIMILARITY = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose line score reaches the bound."""
    field = line_quality.train(docs, learnable(read(spark, sf_dir, "labels")))
    name = free_name("_quality", docs.columns)
    return line_quality.score(docs, field, docs.columns, name=name).filter(F.col(name) >= QUALITY_BOUND).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the least id of each group."""
    return ngram_join.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that leak no benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of at most 2048 tokens."""
    cut = packing.pieces(docs, default_vocabulary())
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontaminate), ("best-fit packing", pack)]

#: SQL expresses neither the fitted field nor the tokenizer; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
