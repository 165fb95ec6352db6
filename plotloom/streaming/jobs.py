"""The two append-only feeds as Structured Streaming jobs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _feed(spark: SparkSession, path: str, schema: T.StructType, glob: str | None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r.option("pathGlobFilter", glob) if glob else r).parquet(path)


def append_rows(spark: SparkSession, path: str, schema: T.StructType, out: str, checkpoint: str, glob: str | None = None,
                partition: str | None = None) -> None:
    """Rows appended as they arrive, each exactly once; drains what is there and stops."""
    w = _feed(spark, path, schema, glob).writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (w.partitionBy(partition) if partition else w).start(out).awaitTermination()


def latest_per_key(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], pos: str, value: str, keep: str, out: str, checkpoint: str,
                   glob: str | None = None) -> None:
    """Last value per key by log position among rows passing ``keep``; ordering is by position, so late rows are harmless.

    The state is keyed by Spark and each micro-batch writes only the keys it changed, as one epoch under ``out``. An epoch counts once
    its number is among the commits, a file that appears whole; a batch run again writes nothing that is committed. Read by ``latest_rows``.
    """
    ok = F.expr(keep)
    agg = _feed(spark, path, schema, glob).groupBy(*keys).agg(
        F.coalesce(F.max_by(F.when(ok, F.struct(value)), F.when(ok, F.col(pos)))[value], F.lit("")).alias(value), F.max(pos).alias("last_pos"))
    changes, commits = f"{out}/changes", f"{out}/commits"

    def commit(epochs: list[tuple[int]]) -> None:
        spark.createDataFrame(epochs, "epoch bigint").coalesce(1).write.mode("append").parquet(commits)

    def store(batch: DataFrame, epoch: int) -> None:
        if spark.read.schema("epoch bigint").parquet(commits).filter(F.col("epoch") == epoch).isEmpty():
            batch.write.mode("overwrite").parquet(f"{changes}/epoch={epoch}")
            commit([(epoch,)])
    commit([])      # the table is there before its first epoch
    agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start().awaitTermination()


def latest_rows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """What ``latest_per_key`` has committed so far: of each key the row of its latest epoch."""
    commits = spark.read.schema("epoch bigint").parquet(f"{out}/commits").distinct()
    changes = spark.read.parquet(f"{out}/changes").withColumn("epoch", F.col("epoch").cast("bigint"))
    rest = [c for c in changes.columns if c not in (*keys, "epoch")]
    newest = changes.join(commits, "epoch", "left_semi").groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("row"))
    return newest.select(*keys, "row.*")
