"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presswork.llm import collocations, decontaminate, lexical, media, minhash_join, mixing, packing, quality, secrets, suffix_dedup, topk, warc, wrapper
from presswork.llm.common import table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(spark, table(spark, sf_dir, "documents"), width=4, percent=80)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"), least=0)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark, table(spark, sf_dir, "embeddings"), every=50, k=5)


def op5_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(spark, table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(spark, table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(spark, table(spark, sf_dir, "pages"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"), least=30, longest=4, top=2000, share=80)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_minhash_dedup,
        op2_quality_classifier,
        op3_warc_salvage,
        op4_exact_topk,
        op5_media_chunks,
        op6_secret_scan,
        op7_suffix_dedup,
        op8_best_fit_packing,
        op9_source_mixing,
        op10_html_extraction,
        op11_lexical_search,
        op12_collocations,
        op13_decontamination,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_dedup": minhash_join.ORACLE_SQL,
        "op3_warc_salvage": warc.ORACLE_SQL,
        "op4_exact_topk": topk.ORACLE_SQL,
        "op7_suffix_dedup": suffix_dedup.ORACLE_SQL,
        "op9_source_mixing": mixing.ORACLE_SQL,
        "op11_lexical_search": lexical.ORACLE_SQL,
        "op12_collocations": collocations.ORACLE_SQL,
        "op13_decontamination": decontaminate.ORACLE_SQL,
    }
