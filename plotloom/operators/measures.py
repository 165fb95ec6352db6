"""Plot and sheet measures: tables of vertices, edges, samples, placements, digests, rectangles."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.functions import geo, rings


def ring_vertices(plots: DataFrame, keys: list[str]) -> DataFrame:
    r = plots.select(*keys, F.posexplode("rings").alias("ring_no", "ring"))
    return r.select(*keys, "ring_no", F.posexplode("ring").alias("seq", "p")).select(*keys, "ring_no", "seq", "p.x", "p.y")


def ring_edges(plots: DataFrame, keys: list[str], ring: str = "rings") -> DataFrame:
    """One row per edge of every ring."""
    r = plots.select(*keys, F.posexplode(ring).alias("ring_no", "ring"))
    return r.select(*keys, "ring_no", F.explode(geo.ring_edges(F.col("ring"))).alias("e")).select(*keys, "ring_no", "e.*")


def turn_angles(plots: DataFrame, keys: list[str]) -> DataFrame:
    r = plots.select(*keys, F.posexplode("rings").alias("ring_no", "ring"))
    return (r.select(*keys, "ring_no", F.posexplode(geo.signed_turns(F.col("ring"))).alias("seq", "signed_deg"))
            .withColumn("turn_deg", F.abs("signed_deg")))


def ring_measures(plots: DataFrame, keys: list[str]) -> DataFrame:
    rings = F.col("rings")
    return plots.select(*keys, geo.net_area(rings).alias("area_sqm"), geo.ring_length(rings[0]).alias("perimeter_m"),
                        F.size(rings[0]).alias("n_vertices"), (F.size(rings) - 1).alias("n_holes"))


def outline_samples(plots: DataFrame, keys: list[str], step: float, ring: str = "ring", packed: bool = False) -> DataFrame:
    """Half-step samples along a ring with the bearing of their edge, in radians.

    Packed, a ring stays one row with what its samples follow from, ``edges`` (no, x0, y0, x1, y1, n, bearing): a hundredth of the bytes where
    rows are dealt out. ``spatial.nearest_sample`` and the like unfold them where they are compared.
    """
    ends = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    if packed:
        return plots.select(*keys, F.transform(geo.ring_edges(F.col(ring)), lambda e: F.struct(
            *[e[c].alias(c) for c in ("no", "x0", "y0", "x1", "y1")], geo.outline_steps(geo.length(e["x0"], e["y0"], e["x1"], e["y1"]), step).alias("n"),
            F.atan2(e["y1"] - e["y0"], e["x1"] - e["x0"]).alias("bearing"))).alias("edges"))
    e = plots.select(*keys, F.explode(geo.ring_edges(F.col(ring))).alias("e")).select(*keys, "e.*")
    n = geo.outline_steps(geo.length(*ends), step)
    pts = geo.samples_between(*ends, n, half=True)
    return (e.withColumn("bearing", F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")))
            .select(*keys, F.col("no").alias("edge_no"), "bearing", F.posexplode(pts).alias("k", "p"))
            .select(*keys, "edge_no", "k", "p.x", "p.y", "bearing"))


def segment_samples(segs: DataFrame, keys: list[str], step: float = 0.5) -> DataFrame:
    """Samples of directed segments, both ends included, with the undirected bearing in radians."""
    dx, dy = F.col("bx") - F.col("ax"), F.col("b_y") - F.col("ay")
    n = geo.segment_steps(F.hypot(dx, dy), step)
    pts = geo.samples_between(F.col("ax"), F.col("ay"), F.col("bx"), F.col("b_y"), n, half=False)
    return (segs.withColumn("bearing", geo.radians_mod_pi(F.atan2(dy, dx)))
            .select(*keys, "bearing", F.posexplode(pts).alias("k", "p")).select(*keys, "k", "p.x", "p.y", "bearing"))


def place(plots: DataFrame, poses: DataFrame, keys: list[str]) -> DataFrame:
    """Rings at their sheet's pose; ``ground`` holds the moved rings."""
    p = poses.select(*keys, "theta", "tx", "ty")
    return plots.join(p, keys).withColumn("ground", geo.rigid_rings(F.col("rings"), F.col("theta"), F.col("tx"), F.col("ty")))


def placed_bodies(plots: DataFrame, poses: DataFrame, hand: DataFrame, keys: list[str]) -> DataFrame:
    """The team's own rings where they placed the plot, else the sheet at the recovered pose."""
    h = hand.select(*keys, "poly_id", F.col("rings").alias("_hand"))
    return (place(plots, poses, keys).join(h, [*keys, "poly_id"], "left")
            .withColumn("ground", F.coalesce("_hand", "ground")).drop("_hand"))


def rigidity_violations(placed: DataFrame, keys: list[str], tol: float = 1e-6) -> DataFrame:
    """Plots whose area or perimeter changed; an empty result is the expectation."""
    before, after = F.col("rings")[0], F.col("ground")[0]
    d = placed.select(*keys, F.abs(geo.ring_area(after) - geo.ring_area(before)).alias("area_change"),
                      F.abs(geo.ring_length(after) - geo.ring_length(before)).alias("length_change"))
    return d.filter((F.col("area_change") > tol) | (F.col("length_change") > tol))


def edge_table(plots: DataFrame, keys: list[str], ring: str = "ring") -> DataFrame:
    """Edges clockwise from the northernmost vertex, numbered from 1, with grid and true bearing."""
    r = plots.select(*keys, geo.start_at_north(geo.clockwise(F.col(ring))).alias("r"))
    e = r.select(*keys, F.explode(geo.ring_edges(F.col("r"))).alias("e")).select(*keys, "e.*")
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    conv = geo.grid_convergence((F.col("x0") + F.col("x1")) / 2.0, (F.col("y0") + F.col("y1")) / 2.0)
    return (e.withColumns({"edge_no": F.col("no") + 1, "length_m": F.hypot(dx, dy), "bearing_grid_deg": geo.bearing_grid(dx, dy),
                           "grid_convergence_deg": conv})
            .withColumn("bearing_true_deg", F.pmod(F.col("bearing_grid_deg") + F.col("grid_convergence_deg"), F.lit(360.0))))


def fingerprint_geometry(plots: DataFrame, keys: list[str]) -> DataFrame:
    """Digest per layer, to the millimetre, blind to the order of its plots.

    Every plot is hashed on its own row; the layer combines sums of the hashes, so nothing is collected.
    """
    def mm(v):
        return F.floor(v * 1000.0 + 0.5).cast("bigint").cast("string")
    text = F.array_join(F.transform("rings", lambda r: F.array_join(F.transform(
        r, lambda p: F.concat(mm(p["x"]), F.lit(","), mm(p["y"]))), ";")), "|")
    h = plots.select(*keys, F.sha2(text, 256).alias("h"))

    def part(a):
        return F.sum(F.conv(F.substring("h", a, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").cast("string")
    return h.groupBy(*keys).agg(F.sha2(F.concat_ws(":", part(1), part(16), F.count("*").cast("string")), 256).alias("fingerprint"))


def glyph_bitmap(glyphs: DataFrame, keys: list[str], outlines: str = "rings") -> DataFrame:
    """Bits and aspect ratio of glyphs given as closed outlines."""
    flat = glyphs.select(*keys, F.flatten(F.transform(outlines, geo.ring_edges)).alias("edges"))
    xs, ys = F.transform("edges", lambda e: e["x0"]), F.transform("edges", lambda e: e["y0"])
    boxed = flat.select(*keys, "edges", F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
                        F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))
    tiny = F.lit(1e-6)
    sized = boxed.select(*keys, "edges", "minx", "miny",
                         F.when(F.col("maxx") > F.col("minx"), F.col("maxx") - F.col("minx")).otherwise(tiny).alias("w"),
                         F.when(F.col("maxy") > F.col("miny"), F.col("maxy") - F.col("miny")).otherwise(tiny).alias("h"))
    bits = geo.glyph_bits(*[F.col(c) for c in ("edges", "minx", "miny", "w", "h")])
    return sized.select(*keys, bits.alias("bits"), (F.col("w") / F.col("h")).alias("ar"))


def min_rotated_rectangle(plots: DataFrame, keys: list[str], ring: str = "ring") -> DataFrame:
    return plots.select(*keys, rings.smallest_rectangle(F.col(ring)).alias("m")).select(*keys, "m.*")
