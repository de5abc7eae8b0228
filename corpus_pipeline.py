"""The corpus pipeline: documents through toxicity, quality, near duplicates, mixing and tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Between
stages documents are written as Parquet and read again, which also cuts the lineage. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from access_spark.llm import mixing, ngram_join, pieces, resampling, toxicity
from access_spark.llm.common import table
from access_spark.llm.queries import PIECE_MODEL, tokenizer_file
from access_spark.session import shared_dir, small_batches


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not call toxic."""
    return toxicity.clean_documents(docs, table(small_batches(spark), sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards the labelled good ones."""
    return resampling.kept_documents(docs, table(small_batches(spark), sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    small_batches(spark)
    return ngram_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixing.mixed_documents(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's pieces, the bytes of the original at which they end, the digests
    of the ids and of the decoded text."""
    small_batches(spark)
    return pieces.encode_documents(docs, tokenizer_file(PIECE_MODEL), keep=["doc_id", "source"], spans=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

#: Two stages learn a model and one encodes pieces, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the result of the last one.

    Every stage's documents are written below the folder that executors share.
    """
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
