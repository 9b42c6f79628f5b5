"""Registered queries of the corpus operators.

Each takes ``(spark, sf_dir)`` and returns its operator's result over every
row and whole text of its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tagwave.llm import centroids as CC
from tagwave.llm import decontamination as DC
from tagwave.llm import exact_dedup as ED
from tagwave.llm import fill_middle as FM
from tagwave.llm.common import read_table
from tagwave.llm.language_id import languages
from tagwave.llm.license_scan import license_digest
from tagwave.llm.lm_scoring import lm_scores
from tagwave.llm.mixing import mix_counts
from tagwave.llm.near_dedup import near_groups
from tagwave.llm.packing import pack
from tagwave.llm.pii import personal_data_digest
from tagwave.llm.quality import quality_scores
from tagwave.llm.token_counts import token_counts


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DC.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read_table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(read_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ED.exact_dedup(read_table(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read_table(spark, sf_dir, "documents"), shingle=4)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(read_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(read_table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CC.cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FM.fill_in_middle_digest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_license_scan": op5_license_scan,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_pii": op9_pii,
    "op10_packing": op10_packing,
    "op11_mixing": op11_mixing,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_fill_middle": op13_fill_middle,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op1_decontamination": DC.ORACLE_SQL,
    "op7_exact_dedup": ED.ORACLE_SQL,
    "op12_centroid_clustering": CC.ORACLE_SQL,
    "op13_fill_middle": FM.ORACLE_SQL,
}
