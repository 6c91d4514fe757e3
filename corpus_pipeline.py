"""The corpus pipeline: quality, near-duplicates, secrets, mixing, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmix.llm import common, mixing, piece_sampling, quality, secret_scan, simhash_dedup
from gridmix.session import work_dir


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; labels teach the classifier."""
    common.prepare(spark)
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    common.prepare(spark)
    return simhash_dedup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced by [REDACTED]."""
    common.prepare(spark)
    return secret_scan.redact(docs, work_dir(spark, "ledger"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    common.prepare(spark)
    return mixing.mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the pieces of a sampled segmentation and the text that these decode to."""
    common.prepare(spark)
    return piece_sampling.decode(piece_sampling.encode(docs))


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix),
          ("pieces", pieces)]

#: Hashes, trained scores and sampled pieces have no SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each read from what the one before wrote."""
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
