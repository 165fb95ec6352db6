"""Shared boundaries of neighbouring parcels: nodes, conforming moves, who yields, who owns a gap."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.functions import geo
from plotloom.operators import cells, planar
from plotloom.session import cut_lineage

MERGE_TOL, ON_LINE = 0.05, 0.02
CONFORM_TOL, ANCHOR_TOL, INSERT_DEG = 0.60, 1.50, 20.0
GUARD_FRACTION, MIN_AREA, MAX_FILL_SQM = 0.25, 0.02, 25.0
CONFLICT_NOTE = "railway land carved out of the older parcel sheet; decide in review"


def _key(x, y) -> Column:
    return F.xxhash64(F.floor(x * 1e6 + 0.5), F.floor(y * 1e6 + 0.5))


def _tidy(ring) -> Column:
    """Ring without consecutive equal vertices (micrometre keys), first and last included."""
    prev = geo.preceding(ring)
    return F.filter(ring, lambda p, i: (F.floor(p["x"] * 1e6 + 0.5) != F.floor(F.get(prev, i)["x"] * 1e6 + 0.5))
                    | (F.floor(p["y"] * 1e6 + 0.5) != F.floor(F.get(prev, i)["y"] * 1e6 + 0.5)))


def _vertices(plots: DataFrame, keys: list[str]) -> DataFrame:
    return plots.select(*keys, F.posexplode("ring").alias("seq", "p")).select(*keys, "seq", "p.x", "p.y")


def _rebuild(verts: DataFrame, inserts: DataFrame, keys: list[str]) -> DataFrame:
    """Rings from vertices (seq) and points inserted after a vertex (seq, t); only one ring meets in a group."""
    rows = verts.select(*keys, "seq", F.lit(0.0).alias("t"), "x", "y").unionByName(inserts.select(*keys, "seq", "t", "x", "y"))
    ring = F.transform(F.array_sort(F.collect_list(F.struct("seq", "t", "x", "y"))), lambda e: F.struct(e["x"].alias("x"), e["y"].alias("y")))
    return rows.groupBy(*keys).agg(ring.alias("ring")).withColumn("ring", _tidy(F.col("ring")))


def node_parts(plots: DataFrame, sheet: list[str], merge_tol: float = MERGE_TOL, on_line: float = ON_LINE, cell: float = 8.0) -> DataFrame:
    """Plots of a sheet sharing every vertex they touch: sheet, plot_id, ring, changed.

    Vertices within 5 cm become one point; a vertex within 2 cm of another plot's edge is inserted into it.
    """
    keys = [*sheet, "plot_id"]
    v = cut_lineage(_vertices(plots, keys))
    pts = v.groupBy(*sheet, "x", "y").agg(F.min(F.struct("plot_id", "seq")).alias("first")).withColumn("id", F.xxhash64("x", "y"))
    side = 4 * merge_tol
    o = cells.at_point(pts.select(*sheet, F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("id").alias("oid")), F.col("ox"), F.col("oy"), side)
    probe = cells.over_box(pts, F.col("x") - merge_tol, F.col("y") - merge_tol, F.col("x") + merge_tol, F.col("y") + merge_tol, side)
    near = probe.join(o, [*sheet, "cell_x", "cell_y"]).filter((F.col("id") < F.col("oid")) & (F.hypot(F.col("ox") - F.col("x"), F.col("oy") - F.col("y")) <= merge_tol))
    comp = planar.connected_components(near.select(*sheet, F.col("id").alias("u"), F.col("oid").alias("v")), sheet)
    grouped = pts.join(comp.withColumnRenamed("node", "id"), [*sheet, "id"], "left").withColumn("comp", F.coalesce("comp", "id"))
    rep = grouped.groupBy(*sheet, "comp").agg(F.min_by(F.struct("x", "y"), "first").alias("r"))
    node = grouped.join(rep, [*sheet, "comp"]).select(*sheet, "x", "y", "r")
    merged = v.join(node, [*sheet, "x", "y"]).select(*keys, "seq", F.col("r.x").alias("x"), F.col("r.y").alias("y"))
    rings = cut_lineage(_rebuild(merged, merged.limit(0).withColumn("t", F.lit(0.0)), keys))
    e = rings.select(*keys, F.explode(geo.ring_edges(F.col("ring"))).alias("e")).select(*keys, F.col("e.no").alias("seq"), "e.x0", "e.y0", "e.x1", "e.y1")
    seg = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    on = cells.over_segment(e, *seg, cell, on_line)
    p = cells.at_point(rep.select(*sheet, "r.x", "r.y").distinct(), F.col("x"), F.col("y"), cell)
    t = geo.param_on_segment(F.col("x"), F.col("y"), *seg)
    hit = (on.join(p, [*sheet, "cell_x", "cell_y"]).withColumn("t", t)
           .filter((geo.distance_at(F.col("x"), F.col("y"), *seg, F.col("t")) <= on_line) & (F.col("t") > 1e-6) & (F.col("t") < 1 - 1e-6)
                   & (_key(F.col("x"), F.col("y")) != _key(F.col("x0"), F.col("y0"))) & (_key(F.col("x"), F.col("y")) != _key(F.col("x1"), F.col("y1"))))
           .select(*keys, "seq", "t", "x", "y").distinct())
    out = _rebuild(_vertices(rings, keys), hit, keys)
    was = plots.select(*keys, F.col("ring").alias("_was"))
    return out.join(was, keys).withColumn("changed", (F.col("ring") != F.col("_was")).cast("int")).drop("_was")


def _reach() -> Column:
    return F.when(F.col("is_anchor"), ANCHOR_TOL).otherwise(CONFORM_TOL)


def _settled_edges(settled: DataFrame, cell: float) -> DataFrame:
    """Edges of settled bodies: village, n, is_anchor, x0..y1 with the cells within the largest reach."""
    e = settled.select("village", F.col("survey").alias("n"), "is_anchor", F.explode(geo.ring_edges(F.col("ring"))).alias("e")).select(
        "village", "n", "is_anchor", "e.x0", "e.y0", "e.x1", "e.y1")
    return cells.over_segment(e, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), cell, ANCHOR_TOL)


def _foot(x, y) -> tuple[Column, Column, Column]:
    seg = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    t = F.coalesce(geo.clamp01(geo.param_on_segment(x, y, *seg)), F.lit(0.0))
    fx, fy = seg[0] + t * (seg[2] - seg[0]), seg[1] + t * (seg[3] - seg[1])
    return fx, fy, F.hypot(fx - x, fy - y)


def conform_targets(moving: DataFrame, settled: DataFrame, cell: float = 8.0) -> DataFrame:
    """Where each movable vertex goes: village, survey, x, y, tx, ty, kind, d, n.

    ``moving``: village, survey, plot_id, ring. ``settled``: village, survey, ring, is_anchor. Per settled
    parcel a corner within reach beats its edges; over all, corner before edge, anchor before peer, then the
    nearest. A corner takes only the nearest vertex of a survey, the others go onto that parcel's edge; the
    two ends of a real edge never land on one point.
    """
    vk = ["village", "survey", "x", "y"]
    v = _vertices(moving, ["village", "survey", "plot_id"]).select(*vk).distinct()
    j = cells.at_point(v, F.col("x"), F.col("y"), cell).join(_settled_edges(settled, cell), ["village", "cell_x", "cell_y"]).filter("n <> survey")
    fx, fy, fd = _foot(F.col("x"), F.col("y"))
    cd = F.hypot(F.col("x0") - F.col("x"), F.col("y0") - F.col("y"))
    # both ends of every edge near the vertex are looked at, so no corner in reach is missed
    ce = F.hypot(F.col("x1") - F.col("x"), F.col("y1") - F.col("y"))
    first = cd <= ce
    qx, qy = F.when(first, F.col("x0")).otherwise(F.col("x1")), F.when(first, F.col("y0")).otherwise(F.col("y1"))
    per = j.withColumns({"reach": _reach(), "fd": fd, "fx": fx, "fy": fy, "cd": F.least(cd, ce), "qx": qx, "qy": qy}).filter(F.col("fd") <= F.col("reach"))
    corner = F.col("cd") <= F.col("reach")
    per = per.groupBy(*vk, "n", "is_anchor").agg(
        F.min(F.when(corner, F.struct(F.col("cd").alias("d"), F.col("qx").alias("tx"), F.col("qy").alias("ty")))).alias("c"),
        F.min(F.struct(F.col("fd").alias("d"), F.col("fx").alias("tx"), F.col("fy").alias("ty"))).alias("e"))
    kind = F.when(F.col("c").isNotNull(), 0).otherwise(1)
    pick = F.coalesce("c", "e")
    best = cut_lineage(per.groupBy(*vk).agg(F.min(F.struct(kind.alias("kind"), (~F.col("is_anchor")).alias("peer"), pick["d"].alias("d"), pick["tx"].alias("tx"), pick["ty"].alias("ty"),
                                                           F.col("n").alias("n"), F.col("e").alias("e"))).alias("b")).select(*vk, "b.*").filter("d > 1e-9"))
    owner = best.filter("kind = 0").groupBy("village", "survey", "tx", "ty").agg(F.min(F.struct("d", "x", "y")).alias("o"))
    b = best.join(owner, ["village", "survey", "tx", "ty"], "left")
    beaten = F.coalesce((F.col("kind") == 0) & ((F.col("o.x") != F.col("x")) | (F.col("o.y") != F.col("y"))), F.lit(False))
    moved = cut_lineage(b.select(*vk, *[F.when(beaten, F.col(f"e.{c}")).otherwise(F.col(c)).alias(c) for c in ("tx", "ty", "d")],
                                 F.when(beaten, 1).otherwise(F.col("kind")).alias("kind"), "n"))
    edges = moving.select("village", "survey", F.explode(geo.ring_edges(F.col("ring"))).alias("e")).select("village", "survey", "e.x0", "e.y0", "e.x1", "e.y1")

    def end(i):
        return moved.select("village", "survey", F.col("x").alias(f"x{i}"), F.col("y").alias(f"y{i}"), _key(F.col("tx"), F.col("ty")).alias(f"k{i}"), F.col("d").alias(f"d{i}"))
    both = edges.join(end(0), ["village", "survey", "x0", "y0"]).join(end(1), ["village", "survey", "x1", "y1"])
    tight = both.filter((F.col("k0") == F.col("k1")) & (geo.length(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")) > CONFORM_TOL))
    far0 = F.col("d0") >= F.col("d1")
    drop = tight.select("village", "survey", F.when(far0, F.col("x0")).otherwise(F.col("x1")).alias("x"), F.when(far0, F.col("y0")).otherwise(F.col("y1")).alias("y")).distinct()
    return moved.join(drop, vk, "left_anti")


def apply_moves(moving: DataFrame, targets: DataFrame) -> DataFrame:
    """Rings with their vertices moved; an equal vertex moves alike in every plot of the survey."""
    keys = ["village", "survey", "plot_id"]
    v = _vertices(moving, keys).join(targets.select("village", "survey", "x", "y", "tx", "ty"), ["village", "survey", "x", "y"], "left")
    m = v.select(*keys, "seq", F.coalesce("tx", "x").alias("x"), F.coalesce("ty", "y").alias("y"))
    return _rebuild(m, m.limit(0).withColumn("t", F.lit(0.0)), keys)


def conform_inserts(moved: DataFrame, settled: DataFrame, cell: float = 8.0) -> DataFrame:
    """Settled vertices to insert beside a plot edge that runs along their boundary.

    village, survey, plot_id, seq, t, x, y: after vertex ``seq`` of that ring. Each settled vertex goes into
    the nearest suitable edge of a survey, and into every ring that holds this edge.
    """
    ring = F.col("ring")
    before, after = geo.preceding(ring), geo.following(ring)
    corner = F.transform(ring, lambda p, i: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.get(before, i).alias("a"), F.get(after, i).alias("b")))
    q = settled.select("village", F.col("survey").alias("n"), "is_anchor", F.explode(corner).alias("q")).select("village", "n", "is_anchor", "q.*")
    own = _vertices(moved, ["village", "survey", "plot_id"]).select("village", "survey", _key(F.col("x"), F.col("y")).alias("k")).distinct()
    e = moved.select("village", "survey", "plot_id", F.explode(geo.ring_edges(ring)).alias("e")).select("village", "survey", "plot_id", F.col("e.no").alias("seq"), "e.x0", "e.y0", "e.x1", "e.y1")
    seg = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    j = cells.over_segment(e, *seg, cell, ANCHOR_TOL).join(cells.at_point(q, F.col("x"), F.col("y"), cell), ["village", "cell_x", "cell_y"]).filter("n <> survey")
    t = geo.param_on_segment(F.col("x"), F.col("y"), *seg)
    _, _, d = _foot(F.col("x"), F.col("y"))
    ang = geo.bearing_math(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))

    def along(o):
        return geo.line_gap(geo.bearing_math(F.col(f"{o}.x") - F.col("x"), F.col(f"{o}.y") - F.col("y")), ang) <= INSERT_DEG
    hit = (j.withColumns({"t": t, "d": d, "k": _key(F.col("x"), F.col("y"))}).filter((F.col("d") <= _reach()) & (F.col("t") > 1e-6) & (F.col("t") < 1 - 1e-6) & (along("a") | along("b")))
           .join(own, ["village", "survey", "k"], "left_anti"))
    edge = F.struct(F.least(_key(F.col("x0"), F.col("y0")), _key(F.col("x1"), F.col("y1"))).alias("a"), F.greatest(_key(F.col("x0"), F.col("y0")), _key(F.col("x1"), F.col("y1"))).alias("b"))
    hit = cut_lineage(hit.withColumn("edge", edge).select("village", "survey", "plot_id", "seq", "edge", "k", "x", "y", "t", "d"))
    best = hit.groupBy("village", "survey", "k").agg(F.min(F.struct(F.round("d", 9).alias("d"), "edge")).alias("b")).select("village", "survey", "k", F.col("b.edge").alias("edge"))
    return hit.join(best, ["village", "survey", "k", "edge"], "left_semi").select("village", "survey", "plot_id", "seq", "t", "x", "y").distinct()


def conform_level(moving: DataFrame, settled: DataFrame) -> DataFrame:
    """Moves and inserts for sheets that do not serve one another: village, survey, plot_id, ring, note, max_move_m, inserted."""
    keys = ["village", "survey", "plot_id"]
    t = cut_lineage(conform_targets(moving, settled))
    moved = cut_lineage(apply_moves(moving, t))
    ins = conform_inserts(moved, settled)
    new = _rebuild(_vertices(moved, keys), ins, keys).select(*keys, F.col("ring").alias("new"))
    far = _vertices(moving, keys).join(t, ["village", "survey", "x", "y"]).groupBy(*keys).agg(F.max("d").alias("max_move_m"))
    n_ins = ins.groupBy(*keys).agg(F.count("*").alias("inserted"))
    j = moving.join(new, keys, "left").join(far, keys, "left").join(n_ins, keys, "left")
    was, now = F.abs(geo.ring_area(F.col("ring"))), F.abs(geo.ring_area(F.col("new")))
    ok = F.coalesce((F.size("new") >= 3) & (F.abs(now - was) <= was * GUARD_FRACTION), F.lit(False))
    changed = ok & (F.col("new") != F.col("ring"))
    return j.select(*keys, F.when(ok, F.col("new")).otherwise(F.col("ring")).alias("ring"),
                    F.when(~ok, "kept (conform refused)").when(changed, "conformed").otherwise("").alias("note"),
                    F.when(changed, F.coalesce("max_move_m", F.lit(0.0))).otherwise(0.0).alias("max_move_m"),
                    F.when(changed, F.coalesce("inserted", F.lit(0))).otherwise(0).alias("inserted"))


def conform(moving: DataFrame, settled: DataFrame, ranks: list[int]) -> DataFrame:
    """Conform level by level, most certain first; every settled level serves the next ones.

    ``moving`` carries rank; sheets of one rank run together.
    """
    base = cut_lineage(settled.select("village", "survey", "ring", "is_anchor"))
    out = None
    for k in sorted(ranks):
        done = cut_lineage(conform_level(moving.filter(F.col("rank") == k).drop("rank"), base))
        out = done if out is None else out.unionByName(done)
        base = base.unionByName(done.select("village", "survey", "ring", F.lit(False).alias("is_anchor")))
    return out


def yield_plan(overlaps: DataFrame) -> DataFrame:
    """Who gives way in every residual overlap.

    ``overlaps``: village, a, b, overlap_sqm, area_a, area_b, movable_a/b, rail_a/b, rank_a/b (smaller = more certain).
    A strip keeps its shape against an ordinary parcel, the team's parcel against ours, the more certain
    against the less certain; a loss above a quarter is refused, and two fixed parcels are left alone.
    """
    ma, mb, ra, rb = (F.col(c) for c in ("movable_a", "movable_b", "rail_a", "rail_b"))
    strip = ra != rb
    a_yields = F.when(strip, rb).when(ma & mb, F.col("rank_a") > F.col("rank_b")).otherwise(ma)
    y, k = F.when(a_yields, F.col("a")).otherwise(F.col("b")), F.when(a_yields, F.col("b")).otherwise(F.col("a"))
    can = F.when(a_yields, ma).otherwise(mb)
    area = F.when(a_yields, F.col("area_a")).otherwise(F.col("area_b"))
    act = (F.when(~can, "report only").when(F.col("overlap_sqm") > area * GUARD_FRACTION, "refused").otherwise("clip"))
    return (overlaps.filter((F.col("overlap_sqm") > MIN_AREA) & (ma | mb))
            .select("village", "a", "b", "overlap_sqm", y.alias("yields"), k.alias("keeps"), act.alias("action"), strip.alias("rail_conflict")))


def conflict_table(plan: DataFrame) -> DataFrame:
    """Strip against parcel, each pair once, for review."""
    return (plan.filter("rail_conflict").groupBy("village", F.col("a").alias("survey_a"), F.col("b").alias("survey_b"))
            .agg(F.round(F.max("overlap_sqm"), 2).alias("overlap_sqm")).withColumn("note", F.lit(CONFLICT_NOTE)))


def gap_owner(gaps: DataFrame, plots: DataFrame, max_fill: float = MAX_FILL_SQM) -> DataFrame:
    """Plot sharing the longest border with each small enclosed gap: sheet, face, plot_id, shared_m.

    ``gaps``: sheet, face, ring, area. ``plots``: sheet, plot_id, ring; vertices are shared, so borders meet
    edge by edge.
    """
    def edges(df, *ids):
        e = df.select("sheet", *ids, F.explode(geo.ring_edges(F.col("ring"))).alias("e")).select("sheet", *ids, "e.*")
        p, q = _key(F.col("x0"), F.col("y0")), _key(F.col("x1"), F.col("y1"))
        return e.select("sheet", *ids, F.least(p, q).alias("ka"), F.greatest(p, q).alias("kb"), geo.length(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("len"))
    small = gaps.filter((F.col("area") > MIN_AREA) & (F.col("area") <= max_fill))
    j = edges(small, "face").join(edges(plots, "plot_id").drop("len"), ["sheet", "ka", "kb"])
    share = j.groupBy("sheet", "face", "plot_id").agg(F.sum("len").alias("shared_m"))
    return share.groupBy("sheet", "face").agg(F.max_by(F.struct("plot_id", "shared_m"), F.struct(F.round("shared_m", 6), -F.col("plot_id"))).alias("o")).select("sheet", "face", "o.*")
