"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

A stage is ``(name, function)``; the function takes (spark, docs, sf_dir) and returns a DataFrame.  All but
the last return the columns of ``documents``; the last returns the packed pieces of what is left.  Nulls, empty
and very long texts, repeated rows, empty tables and extra columns are dealt with by the operators, whose
docstrings say how.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm.exact_dedup import exact_dedup
from tallyframe.llm.kneser_ney import quality_filter
from tallyframe.llm.mixing import mix_sources
from tallyframe.llm.packing import packed_pieces
from tallyframe.llm.simhash import near_dedup
from tallyframe.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the n-gram quality classifier rejects go."""
    return quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document that the mix takes twice is two rows."""
    return mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences."""
    return packed_pieces(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("mix to target weights", mix),
    ("best-fit packing", pack),
]
#: SQL can express neither the n-gram model nor the linked fingerprints; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between them goes to the shared folder."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
