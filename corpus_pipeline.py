"""Corpus pipeline: documents -> without toxic texts -> in a known language ->
one of each group of near-duplicates -> packed training sequences.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the
columns of the documents.  The models are fitted on the documents that the
stage is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicforge.llm import langid, order_minhash, queries, toxicity
from topicforge.llm.common import read, scratch_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), toxicity.learnable())
    return toxicity.keep_clean(docs, model)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough confidence."""
    return langid.keep_accepted(docs, langid.train(docs, langid.learnable()))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return order_minhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return queries.packed_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_language),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: The stages learn and align, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
