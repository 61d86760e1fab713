"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run()
writes as Parquet and reads back as the next stage's docs. All but the last
return the columns of documents, and any further ones, whatever their names.
Texts of any length are taken whole; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presswork.llm import minhash_join, mixing, packing, quality, secrets
from presswork.llm.common import Scratch, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it learns from the labelled rows of the input tables.

    Null and empty texts have the model's prior, so all of them stay or go; rows that repeat stay or go together.
    """
    model = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.accepted(spark, docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, similarity 0.8 or more.

    Null and empty texts and rows without doc_id stay; of a group the smallest doc_id does; a doc_id that repeats stands once.
    """
    return minhash_join.one_of_each(spark, docs, width=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark, and n_chars counted anew; a null text stays null with its n_chars."""
    return secrets.without_secrets(spark, docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight; a document stands as often as the mix takes it.

    A null source is one too, the last; a text without words is taken no more often than its source.
    """
    return mixing.mixture(spark, docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in the sequences; a null or empty text is its end alone."""
    return packing.pack(spark, docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("minhash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: A learned model and a tokenizer's ids aren't SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
