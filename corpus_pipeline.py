"""From raw documents to encoded training text, stage by stage.

Each stage works on all that the one before it kept and is written as Parquet to the shared
folder before the next one reads it, so a lost executor costs at most tasks of one stage. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodlake.llm import decontaminate, pieces, pii, quality, simhash_dedup
from moodlake.llm.common import read, settle
from moodlake.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accept(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near copies, with the shingles and distance of op4, the document with
    the smallest id stays."""
    return simhash_dedup.keep_one(docs)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays."""
    return pii.mask(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, with the check that they decode to it."""
    return pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", keep_distinct),
    ("benchmark_decontamination", keep_unseen),
    ("pii", mask_personal),
    ("sentencepiece", encode),
]

#: SQL cannot express the stages; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
