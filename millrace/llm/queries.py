"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, languages, licences, negatives, neighbours, order, periodic, pii, preference, resample, simhash, subword, suffix
from millrace.llm.common import table


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op1_personal_data(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.op2_repeated_bytes(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op3_near_duplicates(table(spark, sf_dir, "documents"))


def op4_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.format_pairs(preference.neighbour_pairs(table(spark, sf_dir, "conversations")))


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.materialise(table(spark, sf_dir, "documents"))


def op6_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op10_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.encode(table(spark, sf_dir, "documents"), digest=True)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.op11_digests(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.op12_mine(table(spark, sf_dir, "embeddings"))


def op13_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.op13_predict(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": op1_personal_data,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_simhash": op3_simhash,
    "op4_preference": op4_preference,
    "op5_training_order": op5_training_order,
    "op6_resampling": op6_resampling,
    "op7_decontamination": op7_decontamination,
    "op8_licences": op8_licences,
    "op9_neighbours": op9_neighbours,
    "op10_subword": op10_subword,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_languages": op13_languages,
}
ORACLE: dict[str, str] = {"op4_preference": preference.ORACLE, "op8_licences": licences.oracle(), "op12_hard_negatives": negatives.ORACLE}
