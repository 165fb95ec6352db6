"""Geometry as column expressions. A ring is an open ARRAY<STRUCT<x,y>>; angles in degrees unless said."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ACRE_PER_SQM = 0.000247105381
POINT_MM = 25.4 / 72.0


def pt(x, y) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def length(x0, y0, x1, y1) -> Column:
    return F.hypot(x1 - x0, y1 - y0)


def bearing_math(dx, dy) -> Column:
    """Anticlockwise from +x, undirected: 0 <= deg < 180."""
    return F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(180.0))


def bearing_compass(math_deg) -> Column:
    return F.pmod(90.0 - math_deg, F.lit(180.0))


def bearing_grid(dx, dy) -> Column:
    """Clockwise from north, directed: 0 <= deg < 360."""
    return F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0))


def turn_gap(a, b) -> Column:
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def line_gap(a, b) -> Column:
    """Angle between undirected lines, 0..90."""
    d = F.pmod(a - b, F.lit(180.0))
    return F.least(d, 180.0 - d)


def param_on_segment(px, py, ax, ay, bx, by) -> Column:
    dx, dy = bx - ax, by - ay
    return F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy)


def clamp01(t) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))


def distance_at(px, py, ax, ay, bx, by, t) -> Column:
    return F.hypot(px - (ax + t * (bx - ax)), py - (ay + t * (by - ay)))


def point_segment_distance(px, py, ax, ay, bx, by) -> Column:
    """To the segment itself; a segment of no length counts as its point."""
    t = F.coalesce(clamp01(param_on_segment(px, py, ax, ay, bx, by)), F.lit(0.0))
    return distance_at(px, py, ax, ay, bx, by, t)


def crossing(p, q) -> Column:
    """Struct (t, u, x, y) of the proper crossing of segments p and q, each (x0,y0,x1,y1); null if none."""
    ux, uy, vx, vy = p[2] - p[0], p[3] - p[1], q[2] - q[0], q[3] - q[1]
    den = ux * vy - uy * vx
    wx, wy = q[0] - p[0], q[1] - p[1]
    ok = F.abs(den) >= 1e-12
    t, u = F.try_divide(wx * vy - wy * vx, den), F.try_divide(wx * uy - wy * ux, den)
    lo, hi = 1e-9, 1 - 1e-9
    inside = ok & (t > lo) & (t < hi) & (u > lo) & (u < hi)
    return F.when(inside, F.struct(t.alias("t"), u.alias("u"), (p[0] + t * ux).alias("x"), (p[1] + t * uy).alias("y")))


# ---- rings

def following(ring) -> Column:
    """The ring shifted by one: element k is the vertex after k."""
    return F.when(F.size(ring) > 0, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))).otherwise(ring)


def preceding(ring) -> Column:
    return F.concat(F.slice(ring, -1, 1), F.slice(ring, 1, F.size(ring) - 1))


def fold(values) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def ring_area(ring) -> Column:
    """Signed shoelace area, measured from the first vertex so large coordinates do not cancel."""
    o = ring[0]
    return fold(F.zip_with(ring, following(ring), lambda a, b:
                           (a["x"] - o["x"]) * (b["y"] - o["y"]) - (b["x"] - o["x"]) * (a["y"] - o["y"]))) / 2.0


def ring_length(ring) -> Column:
    return fold(F.zip_with(ring, following(ring), lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"])))


def net_area(rings) -> Column:
    """Outer ring minus holes."""
    return F.abs(ring_area(rings[0])) - fold(F.transform(F.slice(rings, 2, F.size(rings)), lambda r: F.abs(ring_area(r))))


def vertex_mean(ring) -> Column:
    n = F.size(ring).cast("double")
    return pt(fold(F.transform(ring, lambda p: p["x"])) / n, fold(F.transform(ring, lambda p: p["y"])) / n)


def ring_moments(ring) -> Column:
    """Struct (a, mx, my): signed area and first moments about the ring's first vertex."""
    o = ring[0]

    def term(f):
        return fold(F.zip_with(ring, following(ring), lambda a, b: f(
            a["x"] - o["x"], a["y"] - o["y"], b["x"] - o["x"], b["y"] - o["y"])))
    return F.struct((term(lambda ax, ay, bx, by: ax * by - bx * ay) / 2.0).alias("a"),
                    (term(lambda ax, ay, bx, by: (ax + bx) * (ax * by - bx * ay)) / 6.0).alias("mx"),
                    (term(lambda ax, ay, bx, by: (ay + by) * (ax * by - bx * ay)) / 6.0).alias("my"))


def ring_centroid(ring) -> Column:
    m = ring_moments(ring)
    return pt(ring[0]["x"] + F.try_divide(m["mx"], m["a"]), ring[0]["y"] + F.try_divide(m["my"], m["a"]))


def signed_turns(ring) -> Column:
    """Turn at each vertex in ring order, left positive."""
    before, after = preceding(ring), following(ring)
    return F.transform(ring, lambda p, i: F.pmod(
        F.degrees(F.atan2(F.get(after, i)["y"] - p["y"], F.get(after, i)["x"] - p["x"])
                  - F.atan2(p["y"] - F.get(before, i)["y"], p["x"] - F.get(before, i)["x"])) + 180.0, F.lit(360.0)) - 180.0)


def ring_edges(ring) -> Column:
    """Array of (no, x0, y0, x1, y1), ``no`` from 0."""
    nxt = following(ring)
    return F.transform(ring, lambda p, i: F.struct(
        i.alias("no"), p["x"].alias("x0"), p["y"].alias("y0"), F.get(nxt, i)["x"].alias("x1"), F.get(nxt, i)["y"].alias("y1")))


def rigid(x, y, theta_deg, tx, ty) -> tuple[Column, Column]:
    c, s = F.cos(F.radians(theta_deg)), F.sin(F.radians(theta_deg))
    return c * x - s * y + tx, s * x + c * y + ty


def rigid_back(x, y, theta_deg, tx, ty) -> tuple[Column, Column]:
    c, s = F.cos(F.radians(theta_deg)), F.sin(F.radians(theta_deg))
    return c * (x - tx) + s * (y - ty), c * (y - ty) - s * (x - tx)


def rigid_ring(ring, theta_deg, tx, ty) -> Column:
    return F.transform(ring, lambda p: pt(*rigid(p["x"], p["y"], theta_deg, tx, ty)))


def rigid_rings(rings, theta_deg, tx, ty) -> Column:
    return F.transform(rings, lambda r: rigid_ring(r, theta_deg, tx, ty))


def clockwise(ring) -> Column:
    """Same first vertex, walked clockwise."""
    back = F.concat(F.slice(ring, 1, 1), F.reverse(F.slice(ring, 2, F.size(ring))))
    return F.when(ring_area(ring) > 0, back).otherwise(ring)


def start_at_north(ring) -> Column:
    """Rotated to begin at the first vertex of largest y."""
    k = -F.array_max(F.transform(ring, lambda p, i: F.struct(p["y"].alias("y"), (-i).alias("i"))))["i"]
    return F.concat(F.slice(ring, k + 1, F.size(ring)), F.slice(ring, F.lit(1), k))


def inside_ring(ring, px, py) -> Column:
    """Even-odd test by counting edges to the right of the point."""
    nxt = following(ring)
    hits = F.zip_with(ring, nxt, lambda a, b: F.when(
        (a["y"] > py) != (b["y"] > py),
        (a["x"] + F.try_divide((py - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"]) > px).cast("int")).otherwise(0))
    return F.aggregate(hits, F.lit(0), lambda s, h: s + h) % 2 == 1


def inside_polygon(rings, px, py) -> Column:
    return inside_ring(rings[0], px, py) & ~F.exists(F.slice(rings, 2, F.size(rings)), lambda r: inside_ring(r, px, py))


def box(ring) -> dict[str, Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return {"minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys)}


def samples_between(x0, y0, x1, y1, n, half: bool) -> Column:
    """n points at half steps, or n+1 points including both ends."""
    ks = F.sequence(F.lit(0), (n - 1 if half else n).cast("int"))
    off = 0.5 if half else 0.0
    return F.transform(ks, lambda k: pt(x0 + (x1 - x0) * (k + off) / n, y0 + (y1 - y0) * (k + off) / n))


def outline_steps(len_m, step: float) -> Column:
    return F.greatest(F.lit(1.0), F.rint(len_m / step))


def segment_steps(len_m, step: float) -> Column:
    return F.greatest(F.lit(2.0), F.floor(len_m / step).cast("double"))


def land_units(area) -> dict[str, Column]:
    return {"area_are": area / 100.0, "area_hect": area / 10000.0, "area_acre": area * ACRE_PER_SQM,
            "area_cent": area * ACRE_PER_SQM * 100.0}


def metres_per_point(scale) -> Column:
    return scale * POINT_MM / 1000.0


def grid_convergence(easting, northing) -> Column:
    """Meridian convergence in degrees on UTM north (WGS 84), by the third-order Krueger series."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    big_a = 6378137.0 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    beta = (n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96, n ** 2 / 48 + n ** 3 / 15, 17 * n ** 3 / 480)
    xi, eta = northing / (0.9996 * big_a), (easting - 500000.0) / (0.9996 * big_a)
    xp, ep, sg, tau = xi, eta, F.lit(1.0), F.lit(0.0)
    for j, b in enumerate(beta, 1):
        s, c = F.sin(xi * (2.0 * j)), F.cos(xi * (2.0 * j))
        sh, ch = F.sinh(eta * (2.0 * j)), F.cosh(eta * (2.0 * j))
        xp, ep = xp - s * ch * b, ep - c * sh * b
        sg, tau = sg - c * ch * (2.0 * j * b), tau + s * sh * (2.0 * j * b)
    tt = F.tan(xp) * F.tanh(ep)
    return F.degrees(F.atan((tau + sg * tt) / (sg - tau * tt)))


def flatten_path(ops, n: int = 8) -> Column:
    """Points of a path: m/l give their point, v a cubic whose first handle is the current point, h the start.

    ``ops`` is ARRAY<STRUCT<op, x1, y1, x2, y2>>; v ends at (x2, y2), m and l at (x1, y1).
    """
    def end(o):
        return F.when(o["op"] == "v", pt(o["x2"], o["y2"])).otherwise(pt(o["x1"], o["y1"]))

    def points(o, i):
        before = F.slice(ops, F.lit(1), i)
        cur = end(F.element_at(F.filter(before, lambda b: b["op"] != "h"), -1))
        first = end(F.element_at(F.filter(before, lambda b: b["op"] == "m"), -1))

        def at(k):
            s = k / float(n)
            m = 1.0 - s
            wa, wb, wc = m * m * m + m * m * s * 3.0, m * s * s * 3.0, s * s * s
            return pt(wa * cur["x"] + wb * o["x1"] + wc * o["x2"], wa * cur["y"] + wb * o["y1"] + wc * o["y2"])
        return (F.when(o["op"] == "v", F.transform(F.sequence(F.lit(1), F.lit(n)), at))
                .when(o["op"] == "h", F.array(first)).otherwise(F.array(end(o))))
    return F.flatten(F.transform(ops, points))


GLYPH_COLS, GLYPH_ROWS = 14, 20


def glyph_bits(edges, minx, miny, w, h) -> Column:
    """14 x 20 bits, top row first, by scanline even-odd over the edges of all closed outlines."""
    def row(r):
        yy = miny + h * (F.lit(GLYPH_ROWS - 0.5) - r) / float(GLYPH_ROWS)
        xs = F.transform(F.filter(edges, lambda e: (e["y0"] > yy) != (e["y1"] > yy)),
                         lambda e: e["x0"] + (yy - e["y0"]) * (e["x1"] - e["x0"]) / (e["y1"] - e["y0"]))
        bits = F.transform(F.array(xs), lambda q: F.transform(F.sequence(F.lit(0), F.lit(GLYPH_COLS - 1)), lambda c: F.size(
            F.filter(q, lambda x: x < minx + w * (c + 0.5) / float(GLYPH_COLS))) % 2))
        return F.get(bits, F.lit(0))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(GLYPH_ROWS - 1)), row))


def radians_mod_pi(x) -> Column:
    return F.pmod(x, F.lit(math.pi))
