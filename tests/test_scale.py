"""How plans deal with small files that unfold."""

import glob
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plotloom.functions import geo, kernels
from plotloom.operators import adjust, directions, matching, overlap, spatial
from plotloom.operators import measures as ms
from plotloom.plans import catalog
from plotloom.plans.shapes import corner_ring, plots
from plotloom.session import measured_broadcasts
from plotloom.sources import readers, writers

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["nearest_boundary_line", "share_score", "point_in_polygon", "glyph_parts", "edges_to_polygon", "corner_gcps"])
def test_nothing_is_broadcast_on_the_size_of_a_file(spark, key):
    plan = catalog.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan


def test_limit_of_the_session_holds_for_measured_sizes(spark):
    limit, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    own = spark.newSession()
    own.conf.set(limit, "300k")
    measured_broadcasts(own)
    measured_broadcasts(own)
    assert own.conf.get(limit) == "-1" and own.conf.get(measured) == "300k"


def test_tables_that_unfold_are_dealt_out(spark):
    fx = catalog.Inputs(spark, SF)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fx.lattice_fx.rdd.getNumPartitions() == n and fx.supplier.rdd.getNumPartitions() == n


def test_village_of_many_rows_passes_no_integer(spark, tmp_path):
    rows = [(1_200_049, 3), (7_200_049, 5), (50, 1)]
    spark.createDataFrame(rows, "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    v = catalog.Inputs(spark, str(tmp_path)).village_fx
    assert v.schema == catalog.Inputs(spark, SF).village_fx.schema
    for row in v.collect():
        for n, (c, r) in enumerate(((row.c, row.r), (row.c + 1, row.r), (row.c + 1, row.r + 1), (row.c, row.r + 1)), 1):
            assert row[f"x{n}"] == 40 * c + ((7919 * c + 104729 * r + 31 * c * r) % 97 - 48) / 8
            assert row[f"y{n}"] == 25 * r + ((6101 * c + 15485 * r + 53 * c * r) % 97 - 48) / 8


def test_filters_stay_behind_the_dealing(spark):
    big = catalog.Inputs(spark, SF).village_fx.withColumn("area", geo.ring_area(corner_ring())).filter("area > 100")
    plan = big._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" in plan and "lambda" not in plan[plan.index("Repartition"):]


def test_shared_area_by_lines_is_not_unfolded_into_rows(spark):
    def ring(*xy):
        return [{"x": float(x), "y": float(y)} for x, y in xy]
    u = ring((0, 0), (30, 0), (30, 20), (20, 20), (20, 10), (10, 10), (10, 20), (0, 20))        # a U, met twice by the upper lines
    rows = [(1, u, ring((0, 0), (30, 0), (30, 20), (0, 20)), 500.0), (2, u, ring((5, 12), (25, 12), (25, 18)), 30.0), (3, u, ring((12, 11), (18, 11), (18, 19)), 0.0),
            (4, ring((0, 0), (10, 0), (0, 10)), ring((0, 0), (10, 0), (10, 10), (0, 10)), 50.0), (5, u, ring((40, 0), (50, 0), (50, 9)), None)]
    d = spark.createDataFrame(rows, "id int, ring array<struct<x:double,y:double>>, o_ring array<struct<x:double,y:double>>, want double")
    d = d.withColumns(geo.box(F.col("ring")) | {f"o_{k}": v for k, v in geo.box(F.col("o_ring")).items()})
    shared = overlap.shared_area(d, ["id"])
    got = {r.id: r.sqm for r in shared.collect()}
    assert set(got) == {1, 2, 3, 4}
    assert all(got[i] == pytest.approx(want, abs=0.25) for i, _, _, want in rows[:4])
    assert "explode" not in shared._jdf.queryExecution().optimizedPlan().toString()


def test_partitions_follow_the_rows(spark, tmp_path):
    spark.range(20_001).selectExpr("id as p_partkey", "3 as p_size").write.parquet(f"{tmp_path}/part.parquet")
    own = spark.newSession()
    large = catalog.Inputs(own, str(tmp_path))
    assert large.lattice_fx.rdd.getNumPartitions() == 5
    counted = large.lattice_fx.groupBy("village").count()
    assert re.search(r"hashpartitioning\(village#\d+, 5\)", counted._jdf.queryExecution().executedPlan().toString())
    small = catalog.Inputs(own, SF)
    assert small.lattice_fx.rdd.getNumPartitions() == int(own.conf.get("spark.sql.shuffle.partitions")) < 5


def test_files_of_sheets_follow_the_villages(spark, tmp_path):
    fx = catalog.Inputs(spark, SF)
    p = plots(fx, True).withColumns({"survey_no": F.col("survey")})
    writers.sink_sheets(p, ["poly_id", "survey_no", "plot_no"], f"{tmp_path}/sheets")
    files = glob.glob(f"{tmp_path}/sheets/**/*.txt", recursive=True)
    assert len(files) == p.select("village").distinct().count() < p.select("survey").distinct().count()
    back = readers.scan_sheets(spark, f"{tmp_path}/sheets", r"village=([^/]+)/", by_line=True)
    key = ["village", "survey", "poly_id", "plot_no", "rings"]
    assert sorted(back.select(*key).collect(), key=str) == sorted(p.select(*key).collect(), key=str)


def test_a_file_per_sheet_is_still_read(spark, tmp_path):
    (tmp_path / "v 7").mkdir()
    (tmp_path / "v 7" / "12A_parcels.geojson").write_text("""{"type": "FeatureCollection", "name": "else",
      "features": [{"type": "Feature", "properties": {"poly_id": 3}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}""")
    (row,) = readers.scan_sheets(spark, str(tmp_path)).collect()
    assert (row.survey, row.poly_id, len(row.rings[0])) == ("12A", 3, 3)


def test_readings_are_compared_on_arrow_batches(spark):
    def ring(*xy):
        return [{"x": float(x), "y": float(y)} for x, y in xy]
    square, near = ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((0, 1), (10, 1), (10, 11), (0, 11))
    rows = [(1, square, square), (2, square, near), (3, ring((0, 0), (40, 0), (40, 0), (0, 3)), square), (4, None, square), (5, square, ring((3, 4), (3, 4)))]
    d = spark.createDataFrame(rows, "id int, ring array<struct<x:double,y:double>>, hand array<struct<x:double,y:double>>")
    out = spatial.reading_disagreement(d, ["id"])
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()
    got = {r.id: r for r in out.collect()}
    assert tuple(got[1])[1:] == (0.0, 0.0, 0.0, 0.0, 0.0, 4)
    # bottom: ten samples a metre below; top: a metre inside but for its ends; sides: half a metre below, then on the line
    assert got[2].mean_m == pytest.approx((18 * 1.0 + 4 * 0.5) / 40) and got[2].max_m == 1.0 and got[2].corner_mean_m == 1.0 and got[2].corners_matched == 4
    # forty samples on the bottom, ten of them on the square's; one on the edge of no length
    assert got[3].max_m == pytest.approx(30.0) and got[3].corner_max_m == 10.0 and got[3].corners_matched == 2
    assert got[4].mean_m is None and got[4].corners_matched is None
    assert got[5].max_m == pytest.approx(math.hypot(7, 5.5)) and got[5].corner_max_m == pytest.approx(math.hypot(7, 6))


def test_runs_and_eroded_overlap_are_worked_out_on_the_row(spark):
    kind = "array<struct<x:double,y:double>>"
    box = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (40, 0), (40, 25), (0, 25))]
    sheets = spark.createDataFrame([("v", "a", box), ("v", "b", box)], f"village string, survey string, ring {kind}")
    runs = matching.shared_runs(sheets, spark.createDataFrame([("v", "a", "b")] * 2, "village string, survey string, other string"))
    assert "aggregate(" not in runs._jdf.queryExecution().optimizedPlan().toString()
    rows = runs.collect()
    assert len({r.chain_key for r in rows}) == len(rows) and max(r.length_m for r in rows) == 130.0     # a pair named twice is one; all edges agree
    g = spatial.with_box(sheets.withColumn("core", overlap.core_of(F.col("ring"))), F.col("ring"))
    shares = overlap.overlapping(g, g, ["village", "survey", "o_survey"], lambda: F.col("survey") < F.col("o_survey"))
    plan = shares._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 3 and "aggregate(" not in plan.replace("aggregate(zip_with", "")      # both cores and the pair, each once
    assert [r.share for r in shares.collect()] == [pytest.approx(34 * 19 / 1000)]


def test_starts_of_long_rings_lose_no_run(monkeypatch):
    pick = np.random.default_rng(7)
    lists = [[], [], [], []]
    for n, m in ((4, 4), (30, 41), (60, 60), (0, 5), (25, 70)):
        a, b = (np.cumsum(pick.choice([3.0, 5.0, 8.0], (k, 2)) * pick.choice([-1.0, 1.0], (k, 2)), 0) for k in (n, m))
        b[:min(n, m) // 2] = a[:min(n, m) // 2][::-1] + 0.05 if n else b[:0]
        for to, v in zip(lists, (*a.T, *b.T)):
            to.append(v.tolist())
    args = [pa.array(v, pa.list_(pa.float64())) for v in lists]
    run = kernels.common_runs(8.0, 0.3, 0.01, 5.0, 10.0)
    monkeypatch.setattr(kernels, "FEW_STARTS", 10 ** 9)
    every = run(*args).to_pylist()
    assert sum(map(len, every)) > 40 and every[3] == []
    monkeypatch.setattr(kernels, "FEW_STARTS", 0)
    assert run(*args).to_pylist() == every
    monkeypatch.setattr(kernels, "MEETINGS", 50)
    assert run(*args).to_pylist() == every


def test_files_of_features_follow_the_villages(spark, tmp_path):
    p = plots(catalog.Inputs(spark, SF), True).repartition(4, "poly_id")
    writers.sink_features(p, ["survey", "poly_id", "plot_no"], f"{tmp_path}/features")
    files = glob.glob(f"{tmp_path}/features/**/*.txt", recursive=True)
    assert len(files) == p.select("village").distinct().count()
    back = spark.read.text(f"{tmp_path}/features").select(F.get_json_object("value", "$.properties.survey").alias("s"), F.get_json_object("value", "$.properties.poly_id").cast("int").alias("p"))
    assert sorted(back.collect()) == sorted(p.select("survey", "poly_id").collect())


def test_packed_outlines_meet_what_their_samples_meet(spark):
    fx = catalog.Inputs(spark, SF)
    p, poses = plots(fx), fx.near_poses_fx.select("village", "survey", "theta", "tx", "ty")
    x, y = geo.rigid(F.col("lx"), F.col("ly"), F.col("theta"), F.col("tx"), F.col("ty"))
    loose = ms.outline_samples(p, ["village", "survey", "i"], 1.0).withColumnsRenamed({"x": "lx", "y": "ly"}).join(poses, ["village", "survey"]).withColumns({"x": x, "y": y})
    packed = ms.outline_samples(p, ["village", "survey", "i"], 1.0, packed=True).join(poses, ["village", "survey"])
    feats = fx.features_fx.filter("substr(edge_id, 1, 1) = 'h'")        # some samples have nothing in reach, some cells no segment
    ids, told = ["i", "edge_no", "k"], ["village", "i", "edge_no", "k", "bearing", "dist", "s_bearing"]
    want, got = (spatial.nearest_sample(d, feats, ["village"], ids, 2.5).select(*told).collect() for d in (loose, packed))
    assert sorted(map(str, got)) == sorted(map(str, want)) and 0 < sum(r.dist is None for r in got) < len(got)
    want, got = (spatial.nearest_boundary_line(ms.outline_samples(p, ["village", "i"], 2.0, packed=k), feats, ["village"], ids).select("village", *ids, "dist", "edge_id", "ax").collect()
                 for k in (False, True))
    assert sorted(map(str, got)) == sorted(map(str, want)) and got


def test_samples_are_not_dealt_out(spark):
    for key in ("share_score", "nearest_boundary_line"):
        plan = catalog.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and not re.search(r"Exchange hashpartitioning\([^)]*edge_no", plan)
    d = spark.createDataFrame([("s", 0.5, 1, k) for k in range(50)] + [("s", 0.9, 2, 60)], "sheet string, bearing double, one int, k int")
    kept = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(directions, "cut_lineage", lambda df: kept.append(df.count()) or df)
        assert sorted(r.total for r in directions.direction_groups(d, ["sheet"], [F.col("k")], "one").collect()) == [2, 50]
    assert max(kept) == 2


def test_a_village_is_adjusted_in_its_task_as_by_rounds(spark, monkeypatch):
    pose, point = "village string, survey string, theta double, tx double, ty double", "village string, a string, b string, pax double, pay double, pbx double, pby double, sigma double"
    free = spark.createDataFrame([(v, s, 1.5, 40.0 * k + 1, 0.5 - k) for v in "vw" for k, s in enumerate("BCD", 1)] + [("u", "B", 0.0, 3.0, 4.0)], pose)
    fixed = spark.createDataFrame([(v, "A", 0.0, 0.0, 0.0) for v in "vw"], pose)
    pair = [(v, a, b, 40.0, y, 0.0, y + (5.0 if (v, b, y) == ("w", "D", 20.0) else 0.0), 0.3) for v in "vw" for a, b in ("AB", "BC", "CD", "AX", "XB") for y in (0.0, 10.0, 20.0)]
    line = spark.createDataFrame([("v", "D", "C", x, 0.0, 0.0, 0.0, 80.0, 0.0, 0.6) for x in (5.0, 30.0)],
                                 "village string, survey string, other string, x double, y double, x0 double, y0 double, x1 double, y1 double, sigma double")
    gcp = spark.createDataFrame([("w", "C", 5.0, 5.0, 84.5, 6.0, 1.0)], "village string, survey string, x double, y double, mx double, my double, sigma double")
    obs = adjust.observations(pair=spark.createDataFrame(pair, point), pair_line=line, gcp=gcp)
    rounds = []
    monkeypatch.setattr(adjust, "_by_rounds", lambda *a, f=adjust._by_rounds: rounds.append(1) or f(*a))
    got = {}
    for most in (300_000, 10):      # the village u has no observations; it is adjusted in its task in any case
        monkeypatch.setattr(adjust, "IN_TASK", most)
        got[most] = sorted(tuple(r) for r in adjust.block_adjust(free, fixed, obs).collect())
        assert len(rounds) == (most == 10)
    assert [r[:2] for r in got[10]] == [r[:2] for r in got[300_000]] and len(got[10]) == 7
    assert np.allclose([r[2:] for r in got[10]], [r[2:] for r in got[300_000]], atol=1e-6)
    assert np.allclose(got[10][1][2:5], (0.0, 40.0, 0.0), atol=0.1)
    assert [r.sigma_pos_m for r in adjust.block_adjust(free, fixed, obs, sigmas=False).collect()] == [None] * 7
    with pytest.raises(Exception, match="still moving"):
        monkeypatch.setattr(adjust, "GIVE_UP", 1)
        adjust.block_adjust(free, fixed, obs).collect()


def test_boundary_lines_are_found_on_the_row_of_a_pair(spark):
    def ring(*xy):
        return [{"x": float(x), "y": float(y)} for x, y in xy]
    sheets = spark.createDataFrame([("v", "a", ring((0, 0), (10, 0), (10, 4), (0, 4))), ("v", "b", ring((0, 0), (6, 0), (6, 6), (0, 6)))],
                                   "village string, survey string, ring array<struct<x:double,y:double>>")
    poses = spark.createDataFrame([("v", "a", 0.0, 0.0, 0.0, 0.0), ("v", "b", 0.0, 2.0, 5.0, 0.25)], "village string, survey string, theta double, tx double, ty double, rms double")
    o = spatial.boundary_line_observations(sheets, poses, spark.createDataFrame([("v", "a", "b")] * 2, "village string, survey string, other string"))
    assert "edge_no" not in " ".join(re.findall(r"RepartitionByExpression|Exchange \w+\([^)]*\)", o._jdf.queryExecution().executedPlan().toString()))
    got = sorted((r.edge_no, r.k, r.x, r.y, r.o_edge, r.x0, r.y0, r.x1, r.y1, r.sigma, r.perp) for r in o.collect())
    # b's lower edge lies a metre above a's upper one, from x = 2 to 8; the samples beyond its ends do not face it, those of the lower side are 5 m away
    top = [(2, k, x, 4.0, 0, 0.0, 0.0, 6.0, 0.0, 0.85, 1.0) for k, x in ((1, 7.0), (2, 5.0), (3, 3.0))]
    low = [(0, k, x, 0.0, 0, 0.0, 0.0, 6.0, 0.0, 0.85, 5.0) for k, x in ((1, 3.0), (2, 5.0), (3, 7.0))]
    assert got == low + top


