"""Connected components of a large graph, by large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import saved


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the smallest node reachable.

    Every round links each node to the smallest neighbour it knows, once over its larger neighbours and once over its
    smaller ones; the rounds end when the edges stay as they are, which is then a star around each root. The number of
    rounds grows with the logarithm of the graph. Self-links, repeated links and either direction are fine; a link with
    a null end counts for nothing; no edges give an empty result.
    """
    e = saved(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
              .filter("_a <> _b").select("u", "v").distinct(), "links")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.col("c")).alias("m"))
        large = (both.filter("v > u").join(least, F.col("u") == F.col("c"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        small = (large.join(low, F.col("u") == F.col("c")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct())
        e = saved(small, "links")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
