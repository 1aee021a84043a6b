"""Registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from moldwise.llm import cover_lloyd, decontaminate, infilling, jaccard, language, nearest, ngram_lm, quality, segment, sharding, token_counts, token_records, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scoring_report(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding_report(_table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents")).drop("class_id")


def op4_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(_table(spark, sf_dir, "documents"))


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.token_report(_table(spark, sf_dir, "documents"))


def op6_sampled_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.segmentation_report(_table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_report(_table(spark, sf_dir, "embeddings"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_cover_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_lloyd.code_report(_table(spark, sf_dir, "embeddings"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_report(_table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.infilling_report(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_trie, op2_sharding, op3_jaccard_join, op4_language_crf, op5_token_records, op6_sampled_segmentation, op7_nearest_neighbours, op8_quality_classifier, op9_toxicity, op10_decontamination, op11_cover_lloyd, op12_token_counts, op13_fill_in_middle)
}
SQL: dict[str, str] = {"op3_jaccard_join": jaccard.ORACLE_SQL, "op7_nearest_neighbours": nearest.ORACLE_SQL, "op10_decontamination": decontaminate.ORACLE_SQL, "op11_cover_lloyd": cover_lloyd.ORACLE_SQL, "op13_fill_in_middle": infilling.ORACLE_SQL}
