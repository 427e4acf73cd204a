"""From raw documents to packed training sequences, in five stages.

Each stage reads all rows that the one before wrote, and its decisions take effect:
languages drops documents whose language can't be told; quality drops those that the weakly trained
scorer rejects; near_duplicates keeps one document of each group of linked ones; mixture repeats and
drops documents so that sources meet their targets; packing cuts and packs all tokens that are left.
"""

from __future__ import annotations

from lumenframe.llm import jaccard, langid, mixing, packing, quality
from lumenframe.llm.common import load, materialize
from pyspark.sql import DataFrame, SparkSession


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.train(docs))


def qualities(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, *quality.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("languages", languages), ("quality", qualities), ("near_duplicates", near_duplicates), ("mixture", mixture), ("packing", packed)]

#: Learned models, hashed sets and tokenizers have no SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
