"""Session defaults and the two shared-folder helpers (checkpoints, working tables)."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(master: str = "local[8]", app: str = "plotloom", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitted session is used as it is."""
    b = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULTS, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    settings.update(conf)
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local master may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="plotloom-")
    sc.setCheckpointDir(root)
    return root


def cut_lineage(df: DataFrame) -> DataFrame:
    """Work done once that survives the loss of executors: a table in the shared folder, read back.

    Unlike a checkpoint it has a known size, so small ones are broadcast by Spark's own check, and it carries no constraints over
    from the plan it came from; in a loop those multiply from round to round. A column without a type can't be written as a table
    and is checkpointed.
    """
    spark = df.sparkSession
    if any(isinstance(f.dataType, T.NullType) for f in df.schema.fields):
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_dir(spark))
        return df.checkpoint(eager=True)
    path = work_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured_broadcasts(spark: SparkSession) -> None:
    """Let a side of a join be broadcast only once its shuffle has shown how large it is.

    The size of a scan is that of its compressed columns, and an explode adds nothing to it: what is planned as a few megabytes of plots
    can be gigabytes of samples, all of them collected by the driver. The session's own limit goes on to hold for measured sizes.
    """
    limit, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if spark.conf.get(limit) != "-1":
        if spark.conf.get(measured, None) is None:
            spark.conf.set(measured, spark.conf.get(limit))
        spark.conf.set(limit, "-1")


def sized_shuffles(spark: SparkSession, partitions: int = 0) -> None:
    """Shuffles of ``partitions``, or the session's own number if that is larger; adaptive coalescing joins the small ones.

    What a task holds follows the rows of its partition, so a fixed number of partitions makes tasks grow with the tables. Coalescing
    goes by compressed bytes, of which geometry unfolds a hundredfold and more in hash tables: its target is 2 MB unless the session says otherwise.
    """
    spark.conf.set(_INITIAL, str(max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(advisory, None) is None:
        spark.conf.set(advisory, "2m")


def shuffles(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session starts with."""
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(own, int(spark.conf.get(_INITIAL, None) or own))


def held(df: DataFrame) -> DataFrame:
    """The same rows, worked out here: no filter on them moves back before this place, where it would work its columns out once more."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows over all shuffle partitions by key; adaptive coalescing would put small ones into one task."""
    return df.repartition(shuffles(df.sparkSession), *by)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal rows that are small but dear to work on over all shuffle partitions, and hold them there: a filter on what is worked out of
    them would otherwise run in the few tasks they come from."""
    return held(dealt(df, *by))


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a working table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
