"""From raw documents to packed sequences: quality rules, toxicity, near-dedup, decontamination, packing.

Every stage but the last returns the columns of ``documents``; the last returns packed pieces. A stage reads what the one before
it wrote, so a lost executor costs no more than its tasks of the stage at work.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plotloom.llm import decontaminate, packing, quality, simhash, toxicity
from plotloom.llm.common import read, saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go, and so do lines that too many documents of a host share."""
    return quality.cleaned(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labels of the documents that are here."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of packed sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [("quality_rules", quality_rules), ("toxicity", toxic), ("near_dedup", near_dedup),
                                   ("decontamination", decontamination), ("packing", pack)]

#: No SQL: tokenizer, fitted models and XXH64 are out of its reach; tests/llm/ hold brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again for the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
