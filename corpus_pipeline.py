"""The corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of documents. Each stage works on every row that
the stage before it kept: a language the text can be told to be in, not toxic, one document of
each group of near-duplicates, secrets masked, packed into sequences. Empty tables pass through
as empty tables; each operator's module states its cases for NULLs, empty and long texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from careflow.llm import language_id, near_dup, packing, secret_scan, toxicity
from careflow.llm.common import bounded_batches, stage, table

# Compression classification, trained layers, union of links and evolution are not SQL.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    bounded_batches(spark)
    return language_id.keep(docs, language_id.learn(docs))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that op7 calls toxic go; learnt from all labels whose documents are left."""
    bounded_batches(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), held=-1)
    return toxicity.keep(docs, model, toxicity.TOXIC_FROM)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, similarity 0.8)."""
    bounded_batches(spark)
    return near_dup.keep(docs, near_dup.Params(words=5, percent=80))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    bounded_batches(spark)
    return secret_scan.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    bounded_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("near_dup", near_dup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
