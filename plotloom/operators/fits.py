"""Rigid and similarity fits as grouped sums, and what is derived from them."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.functions import geo
from plotloom.session import cut_lineage

POSE_RMS_LIMIT = 3.0


def _centre(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Group means joined back, so products are summed in a small frame."""
    m = pairs.groupBy(*keys).agg(*[F.avg(c).alias(f"_m{c}") for c in ("px", "py", "qx", "qy")], F.count("*").alias("n"))
    return pairs.join(m, keys)


def _sums(keys: list[str], df: DataFrame) -> DataFrame:
    px, py, qx, qy = (F.col(c) - F.col(f"_m{c}") for c in ("px", "py", "qx", "qy"))
    return df.groupBy(*keys, "n", "_mpx", "_mpy", "_mqx", "_mqy").agg(
        F.sum(px * qx).alias("xx"), F.sum(px * qy).alias("xy"), F.sum(py * qx).alias("yx"), F.sum(py * qy).alias("yy"),
        F.sum(px * px).alias("pxx"), F.sum(px * py).alias("pxy"), F.sum(py * py).alias("pyy"))


def _angle() -> Column:
    return F.degrees(F.atan2(F.col("xy") - F.col("yx"), F.col("xx") + F.col("yy")))


def _residuals(pairs: DataFrame, fits: DataFrame, keys: list[str], scale: Column | float = 1.0) -> DataFrame:
    """Mean square and largest residual of each fit, measured around the group centre."""
    j = pairs.join(fits, keys)
    x, y = geo.rigid((F.col("px") - F.col("_mpx")) * scale, (F.col("py") - F.col("_mpy")) * scale, F.col("theta"), F.lit(0.0), F.lit(0.0))
    d2 = (x - (F.col("qx") - F.col("_mqx"))) ** 2 + (y - (F.col("qy") - F.col("_mqy"))) ** 2
    return j.groupBy(*keys).agg(F.sqrt(F.avg(d2)).alias("rms"), F.sqrt(F.max(d2)).alias("max_m"))


def _fit_table(pairs: DataFrame, keys: list[str]) -> DataFrame:
    s = _sums(keys, _centre(pairs, keys)).withColumn("theta", _angle())
    x, y = geo.rigid(F.col("_mpx"), F.col("_mpy"), F.col("theta"), F.lit(0.0), F.lit(0.0))
    return s.withColumns({"tx": F.col("_mqx") - x, "ty": F.col("_mqy") - y})


def rigid_fit(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Least-squares rotation and shift per key, scale 1, no mirror: theta, tx, ty, rms, max_m, n.

    ``pairs``: px, py (sheet) and qx, qy (ground). Every step is a combinable aggregate.
    """
    f = _fit_table(pairs, keys)
    r = _residuals(pairs, f.select(*keys, "theta", "_mpx", "_mpy", "_mqx", "_mqy"), keys)
    return f.select(*keys, "theta", "tx", "ty", "n").join(r, keys)


def similarity_fit(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Descriptive scale with its rms, and the anisotropy of the affine fit."""
    f = _fit_table(pairs, keys)
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("yx")
    norm2 = F.col("xx") ** 2 + F.col("xy") ** 2 + F.col("yx") ** 2 + F.col("yy") ** 2
    scale = F.try_divide(F.sqrt(norm2 + F.abs(det) * 2.0), F.col("pxx") + F.col("pyy"))
    pd = F.col("pxx") * F.col("pyy") - F.col("pxy") ** 2
    # affine matrix M with q = M p, from the normal equations of the centred points
    a = F.try_divide(F.col("xx") * F.col("pyy") - F.col("yx") * F.col("pxy"), pd)
    b = F.try_divide(F.col("yx") * F.col("pxx") - F.col("xx") * F.col("pxy"), pd)
    c = F.try_divide(F.col("xy") * F.col("pyy") - F.col("yy") * F.col("pxy"), pd)
    d = F.try_divide(F.col("yy") * F.col("pxx") - F.col("xy") * F.col("pxy"), pd)
    e, g = a * a + b * b + c * c + d * d, F.abs(a * d - b * c)
    hi, lo = F.sqrt(e + g * 2.0), F.sqrt(F.greatest(e - g * 2.0, F.lit(0.0)))
    f = f.withColumns({"scale": scale, "anisotropy": F.when(hi > lo, (hi + lo) / (hi - lo)).when(hi.isNotNull(), math.inf)})
    r = _residuals(pairs, f.select(*keys, "theta", "scale", "_mpx", "_mpy", "_mqx", "_mqy"), keys, F.col("scale"))
    return f.select(*keys, "theta", "scale", "anisotropy").join(r.select(*keys, "rms"), keys)


def pose_from_points(points: DataFrame, keys: list[str]) -> DataFrame:
    """Pose per survey from its control points (two at least), with scale and anisotropy."""
    p = points.select(*keys, F.col("source_x").alias("px"), F.col("source_y").alias("py"), F.col("map_x").alias("qx"), F.col("map_y").alias("qy"))
    return (rigid_fit(p, keys).filter("n >= 2")
            .join(similarity_fit(p, keys).select(*keys, "scale", "anisotropy"), keys))


def truth_source(points_pose: DataFrame, geometry_pose: DataFrame, keys: list[str], limit: float = POSE_RMS_LIMIT,
                 cols: tuple[str, ...] = ("theta", "tx", "ty", "rms")) -> DataFrame:
    """The points pose unless it is missing or too loose, else the geometry pose, and which one it was."""
    a = points_pose.select(*keys, F.struct(*cols).alias("_p"))
    b = geometry_pose.select(*keys, F.struct(*cols).alias("_g"))
    good = F.coalesce(F.col("_p.rms") <= limit, F.lit(False))
    pick = F.when(good, F.col("_p")).otherwise(F.col("_g"))
    return (a.join(b, keys, "full").withColumns({"_t": pick, "source": F.when(good, "points").otherwise("geometry")})
            .filter("_t is not null").select(*keys, *[F.col("_t")[c].alias(c) for c in cols], "source"))


def jackknife_heading(pairs: DataFrame, keys: list[str], unit: list[str]) -> DataFrame:
    """Spread of the heading when one point (or one polygon's points) is left out; 0 below four points.

    The sums without a unit are the group sums minus the unit's own sums, re-centred.
    """
    terms = {"n": F.lit(1.0), "sx": F.col("a"), "sy": F.col("b"), "tx": F.col("c"), "ty": F.col("d"), "dot": F.col("a") * F.col("c") + F.col("b") * F.col("d"),
             "crs": F.col("a") * F.col("d") - F.col("b") * F.col("c")}
    local = _centre(pairs, keys).select(*keys, *unit, *[(F.col(s) - F.col(f"_m{s}")).alias(t) for s, t in (("px", "a"), ("py", "b"), ("qx", "c"), ("qy", "d"))])
    own = local.groupBy(*keys, *unit).agg(*[F.sum(v).alias(k) for k, v in terms.items()])
    total = own.groupBy(*keys).agg(*[F.sum(k).alias(f"t_{k}") for k in terms])
    j = own.join(total, keys)
    left = {k: F.col(f"t_{k}") - F.col(k) for k in terms}
    dot = left["dot"] - (left["sx"] * left["tx"] + left["sy"] * left["ty"]) / left["n"]
    crs = left["crs"] - (left["sx"] * left["ty"] - left["sy"] * left["tx"]) / left["n"]
    th = F.when(left["n"] > 0, F.degrees(F.atan2(crs, dot)))
    return j.withColumn("th", th).groupBy(*keys).agg(
        F.when(F.max("t_n") >= 4, F.max("th") - F.min("th")).otherwise(0.0).alias("heading_spread"))


def residuals_by_pair(obs: DataFrame, poses: DataFrame, keys: list[str]) -> DataFrame:
    """n, rms and largest distance of matched points per survey pair at the given poses.

    ``obs``: keys, a, b, pax, pay, pbx, pby (sheet metres). ``poses``: keys, survey, theta, tx, ty.
    """
    def posed(side):
        return poses.select(*keys, F.col("survey").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("theta", "tx", "ty")])
    j = obs.join(posed("a"), [*keys, "a"]).join(posed("b"), [*keys, "b"])
    ax, ay = geo.rigid(F.col("pax"), F.col("pay"), *[F.col(f"{c}_a") for c in ("theta", "tx", "ty")])
    bx, by = geo.rigid(F.col("pbx"), F.col("pby"), *[F.col(f"{c}_b") for c in ("theta", "tx", "ty")])
    d = F.hypot(ax - bx, ay - by)
    return j.withColumn("d", d).groupBy(*keys, "a", "b").agg(F.count("*").alias("n"), F.sqrt(F.avg(F.col("d") ** 2)).alias("rms"), F.max("d").alias("max_m"))


def area_scale(hand: DataFrame, sheet: DataFrame, keys: list[str]) -> DataFrame:
    a, b = hand.groupBy(*keys).agg(F.sum("area").alias("ha")), sheet.groupBy(*keys).agg(F.sum("area").alias("sa"))
    return a.join(b, keys).select(*keys, F.when(F.col("sa") > 0, F.sqrt(F.col("ha") / F.col("sa"))).alias("area_scale"))


def area_ratio_check(plots: DataFrame, stated: DataFrame, keys: list[str]) -> DataFrame:
    """Polygon total against the independently stated area."""
    t = plots.groupBy(*keys).agg(F.sum("area").alias("total"))
    ref = F.nullif(F.col("stated"), F.lit(0.0))
    return t.join(stated, keys, "left").select(*keys, F.round("total", 2).alias("polygon_total_sqm"), F.round(F.col("total") / ref, 3).alias("area_ratio"),
                                               F.round((F.col("total") - ref) * 100.0 / ref, 2).alias("deviation_pct"))


def team_points_newer(points: DataFrame, files: DataFrame, records: DataFrame, keys: list[str]) -> DataFrame:
    """Refit from the owner's points where their file is over a second newer than the tool's record.

    ``files``: keys, mtime. ``records``: keys, written. Two points at least.
    """
    fresh = files.join(records, keys, "left").filter(
        "written is null or mtime > written + interval 1 second").select(*keys)
    p = points.join(fresh, keys, "left_semi").select(*keys, F.col("source_x").alias("px"), F.col("source_y").alias("py"),
                                                     F.col("map_x").alias("qx"), F.col("map_y").alias("qy"))
    return rigid_fit(p, keys).filter("n >= 2")


def nearest_vertex_refine(verts: DataFrame, hand: DataFrame, start: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Pose from hand-edited geometry: three rounds of nearest-vertex pairs within a shrinking reach.

    ``verts``: keys, plot_id, x, y (sheet). ``hand``: keys, plot_id, hx, hy (ground). ``start``: keys, theta,
    tx, ty. ``sizes``: keys, size (square root of the sheet area). A round with fewer than three pairs keeps
    the pose it had.
    """
    verts, hand, sizes = cut_lineage(verts), cut_lineage(hand), cut_lineage(sizes)
    pose = start.select(*keys, "theta", "tx", "ty", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("rms"))
    for share in (0.15, 0.07, 0.0):
        reach = F.greatest(F.lit(4.0), F.col("size") * share)
        w = verts.join(pose.select(*keys, "theta", "tx", "ty"), keys).join(sizes, keys)
        gx, gy = geo.rigid(F.col("x"), F.col("y"), F.col("theta"), F.col("tx"), F.col("ty"))
        near = (w.withColumns({"gx": gx, "gy": gy}).join(hand, [*keys, "plot_id"])
                .withColumn("d", F.hypot(F.col("hx") - F.col("gx"), F.col("hy") - F.col("gy"))).filter(F.col("d") <= reach)
                .groupBy(*keys, "plot_id", F.col("x").alias("px"), F.col("y").alias("py"))
                .agg(F.min_by(F.struct("hx", "hy"), F.struct("d", "hx", "hy")).alias("h"))
                .select(*keys, "px", "py", F.col("h.hx").alias("qx"), F.col("h.hy").alias("qy")))
        near = cut_lineage(near)                 # the fit reads it several times
        fit = rigid_fit(near, keys).filter("n >= 3").select(*keys, *[F.col(c).alias(f"_{c}") for c in ("theta", "tx", "ty", "n", "rms")])
        pose = cut_lineage(pose.join(fit, keys, "left").select(*keys, *[F.coalesce(f"_{c}", c).alias(c) for c in ("theta", "tx", "ty", "n", "rms")]))
    return pose
