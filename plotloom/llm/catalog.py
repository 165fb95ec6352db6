"""Registered queries of the corpus operators, with their SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plotloom.llm import decontaminate, divergence, fim, html, licenses, lmscore, packing, quality, sharding, simhash, tokenfiles, toxicity, warc
from plotloom.llm.common import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(read(spark, sf_dir, "documents"))


def op2_best_fit_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.pieces(tokenfiles.written(read(spark, sf_dir, "documents")))


def op3_extendible_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op5_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.scored(read(spark, sf_dir, "documents"))


def op6_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(read(spark, sf_dir, "documents"))


def op7_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_minimum_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_dom_tree_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(read(spark, sf_dir, "pages"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_zip_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(warc.written(read(spark, sf_dir, "pages")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_best_fit_token_files, op3_extendible_hash_sharding, op4_simhash_near_dedup, op5_masked_pseudo_likelihood,
                                   op6_line_frequency_rules, op7_suffix_array_decontamination, op8_kneser_ney_toxicity,
                                   op9_minimum_slack_packing, op10_dom_tree_extraction, op11_source_divergence, op12_zip_web_archives, op13_fill_in_middle)}


def oracles() -> dict[str, str]:
    return {"op3_extendible_hash_sharding": sharding.SQL, "op6_line_frequency_rules": quality.SQL, "op7_suffix_array_decontamination": decontaminate.SQL,
            "op11_source_divergence": divergence.SQL, "op12_zip_web_archives": warc.SQL, "op13_fill_in_middle": fim.SQL}
