import math

from pyspark.sql import functions as F

from plotloom import schemas
from plotloom.functions import kernels
from plotloom.operators import adjust, directions, fits, matching, planar, spatial, topology
from plotloom.operators import measures as ms


def ring_df(spark, rows, extra="id string"):
    return spark.createDataFrame([(*r[:-1], [{"x": float(x), "y": float(y)} for x, y in r[-1]]) for r in rows], extra + ", ring array<struct<x:double,y:double>>")


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def _pairs(spark, p, f):
    return spark.createDataFrame([("s", *map(float, (*a, *f(*a)))) for a in p], "survey string, px double, py double, qx double, qy double")


def test_rigid_fit_recovers_a_pose_even_far_away(spark):
    th = math.radians(33)
    out = fits.rigid_fit(_pairs(spark, box(0, 0, 10, 6), lambda x, y: (math.cos(th) * x - math.sin(th) * y + 392150, math.sin(th) * x + math.cos(th) * y + 1413000)), ["survey"]).first()
    assert abs(out.theta - 33) < 1e-7 and abs(out.tx - 392150) < 1e-6 and out.rms < 1e-8
    big = fits.rigid_fit(_pairs(spark, box(0, 0, 10, 6), lambda x, y: (1.1 * x, 1.1 * y)), ["survey"]).first()
    assert big.rms > 0.1


def test_similarity_reports_scale(spark):
    out = fits.similarity_fit(_pairs(spark, box(0, 0, 10, 6), lambda x, y: (0.9 * x + 5, 0.9 * y)), ["survey"]).first()
    assert abs(out.scale - 0.9) < 1e-9 and abs(out.anisotropy - 1) < 1e-6


def test_square_samples_and_turns(spark):
    d = ring_df(spark, [("s", box(0, 0, 10, 10))])
    assert ms.outline_samples(d, ["id"], 1.0).count() == 40
    t = ms.turn_angles(d.withColumn("rings", F.array("ring")), ["id"])
    assert {round(r.turn_deg, 6) for r in t.collect()} == {90.0}


def test_chain_match_shares_one_edge(spark):
    def pt(ring):
        return [{"x": float(x), "y": float(y)} for x, y in ring]
    rows = [("ab", pt(box(0, 0, 40, 25)), pt(box(40, 0, 75, 25))), ("none", pt(box(0, 0, 40, 25)), pt(box(0, 0, 13.7, 9.1))), ("long", pt(box(0, 0, 60, 27)), pt(box(0, -27, 60, 0)))]
    kind = "array<struct<x:double,y:double>>"
    c = matching.edge_chain_match(spark.createDataFrame(rows, f"k string, ring_a {kind}, ring_b {kind}"), ["k"]).collect()
    ab = [r for r in c if r.k == "ab"]
    assert len(ab) >= 2 and max(r.length_m for r in ab) == 25.0 and not [r for r in c if r.k == "none"]
    assert any(r.n_pairs == 2 and abs(r.length_m - 60) < 1e-9 for r in c if r.k == "long")


def test_overlap_of_slivers_and_non_convex_rings(spark):
    import numpy as np
    assert abs(kernels.overlap_of(np.array(box(0, 0, 10, 10.0)), np.array(box(9.7, 0, 19.7, 10.0))) - 3.0) < 1e-9
    ell = np.array([(0, 0), (6, 0), (6, 2), (2, 2), (2, 6), (0, 6)], float)
    assert abs(kernels.overlap_of(ell, np.array(box(1, 1, 5, 5.0))) - 7.0) < 1e-9
    assert abs(kernels.overlap_of(ell[::-1], np.array(box(1, 1, 5, 5.0))) - 7.0) < 1e-9


def test_overlap_ledger_lists_each_pair_once(spark):
    b = spatial.with_box(ring_df(spark, [("v", 1, box(0, 0, 10, 10)), ("v", 2, box(9.7, 0, 19.7, 10)), ("v", 3, box(50, 0, 60, 10))], "village string, id int"), F.col("ring"))
    got = spatial.overlap_ledger(b, ["village"], 4.0).collect()
    assert [(r.id, r.o_id, round(r.overlap_sqm, 6)) for r in got] == [(1, 2, 3.0)]


def _adjust(spark, free, fixed, priors=None, **kinds):
    pose = "village string, survey string, theta double, tx double, ty double"
    pr = None if priors is None else spark.createDataFrame(priors, pose + ", sigma_pos double, sigma_head double")
    out = adjust.block_adjust(spark.createDataFrame(free, pose), spark.createDataFrame(fixed, pose), adjust.observations(**kinds), pr)
    return {r.survey: r for r in out.collect()}


def test_adjustment_snaps_to_a_line_in_utm(spark):
    x, y = 392500.0, 1413000.0
    line = spark.createDataFrame([("v", "B", 0.0, k, x, y, x, y + 50, 0.3) for k in (5.0, 15.0, 25.0, 35.0)], "village string, survey string, x double, y double, ax double, ay double, bx double, b_y double, sigma double")
    out = _adjust(spark, [("v", "B", 0.0, x - 2, y)], [], line=line)
    assert abs(out["B"].tx - x) < 0.05 and abs(out["B"].dtheta_deg) < 0.5 and out["B"].shift_m > 1


def test_adjustment_pairs_and_gcps(spark):
    pair = spark.createDataFrame([("v", "A", "B", 10.0, k, 0.0, k, 0.3) for k in (0.0, 20.0)], "village string, a string, b string, pax double, pay double, pbx double, pby double, sigma double")
    gcp = spark.createDataFrame([("w", "C", 0.0, 0.0, 500.0, 500.0, 1.0), ("w", "C", 30.0, 0.0, 530.0, 500.0, 1.0)], "village string, survey string, x double, y double, mx double, my double, sigma double")
    out = _adjust(spark, [("v", "B", 0.0, 12.0, 1.0), ("w", "C", 0.0, 495.0, 498.0)], [("v", "A", 0.0, 0.0, 0.0)], pair=pair, gcp=gcp)
    assert set(out) == {"B", "C"}
    assert abs(out["B"].tx - 10) < 0.05 and abs(out["B"].ty) < 0.05
    assert abs(out["C"].tx - 500) < 0.2 and abs(out["C"].ty - 500) < 0.2


def test_polygonize_holes_islands_and_dangles(spark):
    segs, k = [], 0
    for r in (box(0, 0, 30, 30), box(10, 10, 20, 20)):
        for a, b in zip(r, r[1:] + r[:1]):
            k += 1
            segs.append(("s", f"e{k:02d}", *map(float, (*a, *b))))
    segs.append(("s", "t1", 0.0, 5.0, 30.0, 5.0))                  # splits the outer square by two T-junctions
    segs.append(("s", "d1", 15.0, 5.0, 15.0, 8.0))                 # dangles
    p = planar.polygonize(spark.createDataFrame(segs, "sheet string, seg_id string, ax double, ay double, bx double, b_y double"), 0.05, 8.0).collect()
    assert sorted((round(r.area, 6), len(r.rings)) for r in p) == [(100.0, 1), (150.0, 1), (650.0, 2)]


def test_dissolve_keeps_t_vertex_and_turns_clockwise(spark):
    d = ring_df(spark, [("s", 1, box(0, 0, 5, 10)), ("s", 2, box(5, 0, 10, 10))], "survey string, id int")
    o = planar.dissolve_outline(d, ["id"], ["survey"]).first()
    assert o.area == 100.0 and len(o.ring) == 6


def test_enclosed_gap_goes_to_its_longest_neighbour(spark):
    d = ring_df(spark, [("v", 1, [(0, 0), (20, 0), (20, 10), (16, 10), (4, 10), (0, 10)]), ("v", 2, [(0, 10), (4, 10), (4, 10.3), (16, 10.3), (16, 10), (20, 10), (20, 20), (0, 20)])], "village string, id int")
    g = planar.gap_ledger(d, ["id"], ["village"])
    rows = g.collect()
    assert len(rows) == 1 and abs(rows[0].area - 3.6) < 1e-9
    o = topology.gap_owner(g, d.select(F.col("village").alias("sheet"), F.col("id").alias("plot_id"), "ring")).first()
    assert o.plot_id == 2


def test_conform_moves_onto_the_settled_boundary_and_inserts_its_vertex(spark):
    settled = ring_df(spark, [("v", "A", [(0, 0), (10, 0), (10, 6), (10, 10), (0, 10)])], "village string, survey string").withColumn("is_anchor", F.lit(False))
    moving = ring_df(spark, [("v", "B", 1, box(10.3, 0, 20, 10))], "village string, survey string, plot_id int")
    c = topology.conform_level(moving, settled).first()
    pts = {(p.x, p.y) for p in c.ring}
    assert {(10.0, 0.0), (10.0, 6.0), (10.0, 10.0)} <= pts and c.max_move_m < 0.6 and c.inserted == 1
    again = topology.conform_level(spark.createDataFrame([("v", "B", 1, c.ring)], moving.schema), settled).first()
    assert again.note == "" and {(p.x, p.y) for p in again.ring} == pts


def test_node_parts_inserts_a_touching_corner(spark):
    d = ring_df(spark, [("s", 1, box(0, 0, 10, 10)), ("s", 2, [(10.02, 3), (20, 3), (20, 6), (10, 6)])], "survey string, plot_id int")
    n = {r.plot_id: {(p.x, p.y) for p in r.ring} for r in topology.node_parts(d, ["survey"]).collect()}
    assert (10.0, 6.0) in n[1]


def test_direction_groups_add_up(spark):
    s = spark.createDataFrame([("s", 0.0, 100.0), ("s", 0.05, 60.0), ("s", math.pi / 2, 40.0)], "sheet string, bearing double, w double")
    assert sorted(r.total for r in directions.direction_groups(s, ["sheet"], [-F.col("w")], "w").collect()) == [40.0, 160.0]
    o = directions.observability(s.withColumn("k", F.col("w")), ["sheet"], [F.col("k")]).first()
    assert o.primary_m == 2.0 and o.cross_m == 1.0 and o.ok == 0


def test_schemas_have_the_fixed_widths():
    assert len(schemas.FEATURE_ROW) == 56 and len(schemas.STATUS_ROW) == 37
