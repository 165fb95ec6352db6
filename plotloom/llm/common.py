"""Helpers shared by the corpus operators: working tables, safe rows, spread-out ranks."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotloom.session import work_path

#: Words are runs of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: work done once that outlives the loss of executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_rows(df: DataFrame, name: str = "row") -> DataFrame:
    """Pack all columns into one struct, so that helper columns beside it can't clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def from_rows(df: DataFrame, name: str = "row") -> DataFrame:
    return df.select(f"{name}.*")


def row_keys(row: str = "row", cols: tuple[str, ...] = ("doc_id", "text")) -> list[Column]:
    """128 bits that stand for a row's values: never null, so equal rows meet in a plain equi-join."""
    vals = [F.col(f"{row}.`{c}`") for c in cols]
    marks = [v.isNull() for v in vals]
    return [F.xxhash64(*vals, *marks).alias("k1"), F.xxhash64(F.lit("b"), *marks, *reversed(vals)).alias("k2")]


def ranked(df: DataFrame, key: str, order: list[str], rank: str = "rank", salts: int = 64) -> DataFrame:
    """Number the rows of each ``key`` from 0 without gaps, whatever the size of a key.

    Rows of a key are dealt over ``salts`` sub-keys by a hash of ``order``; each sub-key is numbered by itself and starts where
    the counts of the sub-keys before it end. Equal rows under one sub-key get different numbers.
    """
    from pyspark.sql import Window
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    counts = dealt.groupBy(F.col(key).alias("_key"), F.col("_salt").alias("_of")).agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order)).cast("long") - 1
    numbered = dealt.withColumn("_own", own)
    joined = numbered.join(starts, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_of")))
    return joined.withColumn(rank, F.col("_start") + F.col("_own")).drop("_salt", "_own", "_key", "_of", "_start")
