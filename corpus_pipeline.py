"""Documents to training sequences in five stages, each over all that the one before it kept.

Quality classifier, near duplicates, benchmark decontamination, mix of sources, token files. Stages hand over through
Parquet; each returns the columns of ``documents`` but the last, which returns what its files hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontam, mixing, quality_fm, simhash, token_arrow
from stratalake.llm.common import shared_folder, table
from stratalake.llm.queries import vocabulary

#: No stage after the classifier can be told in SQL without it; tests hold each against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from all labels of the original documents."""
    original = table(spark, sf_dir, "documents")
    machine = quality_fm.fit(original, table(spark, sf_dir, "labels"), F.lit(True))
    return quality_fm.good_documents(docs, machine)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near fingerprints (words and bits as in ``op4``)."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark text."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, as often as it takes them, in training order."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what is read back from them."""
    return token_arrow.tokens_round_trip(docs, vocabulary())


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = shared_folder(spark)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
