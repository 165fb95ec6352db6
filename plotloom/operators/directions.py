"""Direction groups of segments and of matched outline samples."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.session import cut_lineage

PRIMARY_MIN, CROSS_MIN, CROSS_ANGLE, GROUP_TOL = 40.0, 20.0, 30.0, 10.0


def _apart(a, b) -> Column:
    """Angle of two undirected bearings in degrees."""
    d = F.abs(a - b)
    return F.degrees(F.least(d, math.pi - d))


def direction_groups(items: DataFrame, keys: list[str], first: list[Column], weight: str, tol_deg: float = GROUP_TOL) -> DataFrame:
    """Groups of like bearing: keys, no, bearing, total.

    The first item (by ``first``, smallest struct) without a group founds one and takes every free item within
    the tolerance, as a one-by-one greedy pass would. Founders differ by more than the tolerance, so there are
    few rounds however many items a key has, and each round is a combinable aggregate. Items of one bearing go together in any case:
    they are one row from the start.
    """
    each = items.select(*keys, "bearing", weight, F.struct(*first).alias("_o"))
    left, out = cut_lineage(each.groupBy(*keys, "bearing").agg(F.sum(weight).alias(weight), F.min("_o").alias("_o"))), None
    no = 0
    while not left.isEmpty():
        head = left.groupBy(*keys).agg(F.min_by("bearing", "_o").alias("_h"))
        j = cut_lineage(left.join(head, keys).withColumn("_in", _apart(F.col("bearing"), F.col("_h")) <= tol_deg))
        g = j.filter("_in").groupBy(*keys, F.col("_h").alias("bearing")).agg(F.sum(weight).alias("total")).withColumn("no", F.lit(no))
        out = g if out is None else out.unionByName(g)
        left, no = j.filter("not _in").drop("_in", "_h"), no + 1
    return out if out is not None else items.select(*keys, "bearing", F.col(weight).alias("total"), F.lit(0).alias("no")).limit(0)


def observability(matched: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Matched metres in the main direction and in the strongest direction at least 30 degrees from it.

    ``matched``: keys and bearing of the matched metre samples at the pose (radians, undirected).
    """
    g = cut_lineage(direction_groups(matched.withColumn("one", F.lit(1)), keys, order, "one"))
    main = g.groupBy(*keys).agg(F.min_by(F.struct(F.col("bearing"), F.col("total")), F.struct(-F.col("total"), "no")).alias("m"))
    gap = _apart(F.col("bearing"), F.col("m.bearing"))
    cross = (g.join(main, keys).filter(gap >= CROSS_ANGLE).groupBy(*keys)
             .agg(F.min_by(F.struct(F.col("total").alias("t"), gap.alias("a")), F.struct(-F.col("total"), "no")).alias("c")))
    p, c = F.col("m.total").cast("double"), F.coalesce(F.col("c.t"), F.lit(0)).cast("double")
    return main.join(cross, keys, "left").select(
        *keys, p.alias("primary_m"), c.alias("cross_m"), F.coalesce(F.round("c.a", 1), F.lit(0.0)).alias("cross_angle_deg"),
        ((p >= PRIMARY_MIN) & (c >= CROSS_MIN)).cast("int").alias("ok"))
