"""Measures between two rings, and of one ring's hull, as column expressions: a ring against the edges of another, no array of pairs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.functions import geo, kernels

_disagreement = F.arrow_udf(kernels.disagreement, T.StructType([T.StructField(n, T.DoubleType()) for n in ("mean_m", "p95_m", "max_m", "corner_mean_m", "corner_max_m")]
                                                               + [T.StructField("corners_matched", T.IntegerType())]))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def to_edges(x, y, edges) -> Column:
    """Distance of a point to the nearest of ``edges`` (see ``geo.ring_edges``)."""
    return F.array_min(F.transform(edges, lambda e: geo.point_segment_distance(x, y, e["x0"], e["y0"], e["x1"], e["y1"])))


def _crossed(edges, others) -> Column:
    def meets(e, o):
        ux, uy, vx, vy = e["x1"] - e["x0"], e["y1"] - e["y0"], o["x1"] - o["x0"], o["y1"] - o["y0"]
        den = ux * vy - uy * vx
        wx, wy = o["x0"] - e["x0"], o["y0"] - e["y0"]
        t, s = F.try_divide(wx * vy - wy * vx, den), F.try_divide(wx * uy - wy * ux, den)
        return F.coalesce((F.abs(den) >= 1e-12) & (t > 0) & (t < 1) & (s > 0) & (s < 1), F.lit(False))
    return F.exists(edges, lambda e: F.exists(others, lambda o: meets(e, o)))


def ring_gap(a, b) -> Column:
    """Distance of two polygons; 0 when they touch, cross or hold one another."""
    def measured(ea, eb):
        apart = F.least(F.array_min(F.transform(a, lambda p: to_edges(p["x"], p["y"], eb))), F.array_min(F.transform(b, lambda p: to_edges(p["x"], p["y"], ea))))
        held = geo.inside_ring(b, a[0]["x"], a[0]["y"]) | geo.inside_ring(a, b[0]["x"], b[0]["y"])
        return F.when(held | _crossed(ea, eb), 0.0).otherwise(apart)
    return let(geo.ring_edges(a), lambda ea: let(geo.ring_edges(b), lambda eb: measured(ea, eb)))


def hausdorff(a, b) -> Column:
    """Largest distance of a vertex of either ring to the other ring's line."""
    def one(p, q):
        return let(geo.ring_edges(q), lambda e: F.array_max(F.transform(p, lambda v: to_edges(v["x"], v["y"], e))))
    return F.greatest(one(a, b), one(b, a))


def quantile(values, q: float) -> Column:
    """Linear interpolation between order statistics; null for no values."""
    def picked(s):
        at = (F.size(s) - 1) * F.lit(q)
        low = F.get(s, F.floor(at).cast("int"))
        return F.when(F.size(s) > 0, low + (at - F.floor(at)) * (F.get(s, F.ceil(at).cast("int")) - low))
    return let(F.sort_array(values), picked)


def keep_if(df: DataFrame, name: str, value: Column, test) -> DataFrame:
    """Append ``value`` and keep rows that pass ``test(value)``; a plain filter would be pushed down with a second copy of the value."""
    return df.withColumn(name, F.explode(F.filter(F.array(value), test)))


def along(ring, n) -> Column:
    """``n`` points at equal steps along the ring from its first vertex."""
    def placed(edges):
        lens = F.transform(edges, lambda e: geo.length(e["x0"], e["y0"], e["x1"], e["y1"]))
        ends = F.aggregate(lens, F.array(F.lit(0.0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))

        def points(at):
            def one(k):
                s = F.element_at(at, -1) * k / n
                return let(F.size(F.filter(F.slice(at, F.lit(1), F.size(edges)), lambda v: v <= s)) - 1, lambda i: let(F.get(edges, i), lambda e: let(
                    F.try_divide(s - F.get(at, i), F.get(at, i + 1) - F.get(at, i)), lambda t: geo.pt(e["x0"] + (e["x1"] - e["x0"]) * F.coalesce(t, F.lit(0.0)), e["y0"] + (e["y1"] - e["y0"]) * F.coalesce(t, F.lit(0.0))))))
            return F.transform(F.sequence(F.lit(0), n.cast("int") - 1), one)
        return let(ends, points)
    return let(geo.ring_edges(ring), placed)


def boundary_quantile(a, b, q: float = 0.9, reach: float = 3.0) -> Column:
    """Quantile of the gap along ring ``a``, over its samples (a metre apart, 20 at least) within ``reach`` of polygon ``b``; null if none."""
    def near(samples, eb):
        d = F.transform(samples, lambda p: let(to_edges(p["x"], p["y"], eb), lambda v: F.when((v < reach) | geo.inside_ring(b, p["x"], p["y"]), v)))
        return F.filter(d, lambda v: v.isNotNull())
    n = F.greatest(F.lit(20.0), F.floor(geo.ring_length(a)).cast("double"))
    samples = let(n, lambda n: along(a, n))
    return let(samples, lambda s: let(geo.ring_edges(b), lambda eb: quantile(near(s, eb), q)))


def disagreement(a, b, reach: float = 10.0, step: float = 1.0) -> Column:
    """Outline samples of ring ``a`` to the line of ring ``b``, and corners of ``a`` to the nearest vertex of ``b``, as one struct.

    Some hundred samples a ring against every edge: on Arrow batches, where a column expression takes milliseconds a row.
    """
    xy = [F.transform(r, f) for r in (a, b) for f in (lambda v: v["x"], lambda v: v["y"])]
    return _disagreement(*xy, F.lit(step), F.lit(reach))


def hull(ring) -> Column:
    """Counter-clockwise convex hull: lower and upper chain over the points in order."""
    def left(o, p, q):
        return (p["x"] - o["x"]) * (q["y"] - o["y"]) - (p["y"] - o["y"]) * (q["x"] - o["x"]) > 0

    def chain(points):
        # a point ends the chain's tail back to where the turn to it is a left one; on a convex chain those are all but the last few
        def add(acc, q):
            good = F.size(F.filter(F.slice(acc, F.lit(2), F.greatest(F.size(acc) - 1, F.lit(0))), lambda p, i: left(F.get(acc, i), p, q)))
            return F.concat(F.slice(acc, F.lit(1), F.least(F.size(acc), good + 1)), F.array(q))
        return F.aggregate(points, F.slice(points, F.lit(1), F.lit(0)), add)
    return let(F.array_sort(F.array_distinct(ring)), lambda s: let(chain(s), lambda lo: let(chain(F.reverse(s)), lambda up: F.concat(
        F.slice(lo, F.lit(1), F.greatest(F.size(lo) - 1, F.lit(1))), F.slice(up, F.lit(1), F.greatest(F.size(up) - 1, F.lit(0)))))))


def smallest_rectangle(ring) -> Column:
    """Struct (long_m, short_m) of the smallest rotated rectangle; one of its sides lies on a hull edge. Of equal areas the narrowest counts."""
    def sides(h):
        def one(e):
            n = geo.length(e["x0"], e["y0"], e["x1"], e["y1"])
            ux, uy = (e["x1"] - e["x0"]) / n, (e["y1"] - e["y0"]) / n
            u, v = F.transform(h, lambda p: p["x"] * ux + p["y"] * uy), F.transform(h, lambda p: p["y"] * ux - p["x"] * uy)
            return let(F.struct((F.array_max(u) - F.array_min(u)).alias("w"), (F.array_max(v) - F.array_min(v)).alias("t")), lambda s: F.struct(
                F.round(s["w"] * s["t"], 6).alias("area"), F.least(s["w"], s["t"]).alias("short_m"), F.greatest(s["w"], s["t"]).alias("long_m")))
        return let(F.array_min(F.transform(geo.ring_edges(h), one)), lambda b: F.struct(b["long_m"].alias("long_m"), b["short_m"].alias("short_m")))
    return let(hull(ring), sides)
