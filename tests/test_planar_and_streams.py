"""Long dangles, gaps without their outline, and the keyed state of a stream across restarts."""

import math

import pytest
from pyspark.sql import functions as F

from plotloom.operators import planar
from plotloom.streaming import jobs

EDGE = "sheet string, u bigint, v bigint"


def pruned_by_hand(edges):
    """Ends of degree one taken away until there are none."""
    live = set(edges)
    while True:
        degree = {}
        for s, u, v in live:
            for n in (u, v):
                degree[s, n] = degree.get((s, n), 0) + 1
        cut = {e for e in live if degree[e[0], e[1]] == 1 or degree[e[0], e[2]] == 1}
        if not cut:
            return live
        live -= cut


def rounds_of(monkeypatch, call):
    """How many tables ``call`` writes, and what it returns."""
    written, real = [], planar.cut_lineage
    monkeypatch.setattr(planar, "cut_lineage", lambda df: written.append(1) or real(df))
    out = call()
    return len(written), out


def test_prune_dangles_equals_the_rule_edge_by_edge(spark):
    ring = [(1, 2), (2, 3), (3, 4), (1, 4)]
    comb = [(2, 10), (10, 11), (11, 12), (10, 13), (13, 14), (13, 15)]                  # a tree on the ring
    bridge = [(3, 20), (20, 21), (21, 30), (30, 31), (31, 32), (30, 32), (32, 33)]      # two rings, the way between them stays
    alone = [(40, 41), (41, 42), (41, 43)]                                              # a tree of its own goes whole
    edges = [("a", *e) for e in ring + comb + bridge + alone] + [("b", *e) for e in ring + [(4, 9)]] + [("c", 7, 8)]
    kept, gone = planar.prune_dangles(spark.createDataFrame(edges, EDGE))
    want = pruned_by_hand(edges)
    assert {tuple(r) for r in kept.select("sheet", "u", "v").collect()} == want
    assert {tuple(r) for r in gone.select("sheet", "u", "v").collect()} == set(edges) - want


def test_prune_dangles_takes_a_long_path_in_few_rounds(spark, monkeypatch):
    path = [("a", n, n + 1) for n in range(100, 1100)]
    edges = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("a", 1, 3), ("a", 3, 100), *path], EDGE)
    written, (kept, gone) = rounds_of(monkeypatch, lambda: planar.prune_dangles(edges))
    assert kept.count() == 3 and gone.count() == 1001
    assert written <= 2 + 12        # the table it starts from, the marked edges, and the rounds between


def ring_edges(sheet, first, n):
    """Edges of a ring of n nodes, as ``walk_faces`` takes them."""
    at = [(first + k, math.cos(2 * math.pi * k / n), math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [(sheet, p[0], q[0], *p[1:], *q[1:]) for p, q in zip(at, at[1:] + at[:1], strict=True)]


def test_faces_are_numbered_while_they_are_labelled(spark, monkeypatch):
    edges = [e for k in range(50) for e in ring_edges("short", 10 * k, 4)] + ring_edges("long", 10_000, 60)
    for n in range(2, 8):
        edges += ring_edges(f"ring{n}", 0, n) if n > 2 else [("ring2", 1, 2, 0.0, 0.0, 1.0, 0.0)]
    sizes, real = [], planar.cut_lineage

    def kept(df):
        out = real(df)
        sizes.append(out.count())
        return out
    monkeypatch.setattr(planar, "cut_lineage", kept)
    faces = {}
    for r in planar.walk_faces(spark.createDataFrame(edges, f"{EDGE}, ux double, uy double, vx double, vy double")).collect():
        faces.setdefault((r.sheet, r.face), {})[r.back] = r.u
    assert len(faces) == 2 * (50 + 1 + 5) + 1
    for (sheet, _), ring in faces.items():
        n = 60 if sheet == "long" else 4 if sheet == "short" else int(sheet[4:])
        assert sorted(ring) == list(range(1 - n, 1))            # each step back from the first half-edge stands once
        nodes = [ring[k] for k in sorted(ring)]
        assert all((b - a) % n in (1, n - 1) for a, b in zip(nodes, nodes[1:], strict=False)) or n == 2 or sheet == "short"
    assert len(sizes) <= 1 + 8                                  # the order, and a round for each doubling over the longest ring
    assert sizes[-1] <= 120 < sizes[0]                          # short rings have left by then


def test_prune_dangles_without_edges(spark):
    kept, gone = planar.prune_dangles(spark.createDataFrame([], EDGE))
    assert kept.count() == gone.count() == 0


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


def test_gaps_are_gathered_without_the_outline(spark, monkeypatch):
    # three by three squares far from the origin, the middle one left out; a second village without a gap
    x0, y0 = 512_345.0, 1_234_567.0
    plots = [("v", f"{i}{j}", square(x0 + 10 * i, y0 + 10 * j, 10)) for i in range(3) for j in range(3) if (i, j) != (1, 1)]
    plots += [("w", str(i), square(x0 + 10 * i, y0, 10)) for i in range(3)]
    df = spark.createDataFrame(plots, "village string, id string, ring array<struct<x:double,y:double>>")
    gathered, real = [], planar.face_rings
    monkeypatch.setattr(planar, "face_rings", lambda walked: gathered.append({r.face for r in walked.select("face").collect()}) or real(walked))
    gaps = planar.gap_ledger(df, ["id"], ["village"]).collect()
    assert [(g.sheet, round(g.area, 6), len(g.ring)) for g in gaps] == [("v", 100.0, 4)]
    assert gathered == [{gaps[0].face}]
    outline = {r.sheet: r for r in planar.dissolve_outline(df, ["id"], ["village"]).collect()}
    assert {k: (round(o.area, 6), len(o.ring)) for k, o in outline.items()} == {"v": (900.0, 12), "w": (300.0, 8)}
    assert all(math.isfinite(p.x) for p in outline["v"].ring)


@pytest.fixture
def feed(spark, tmp_path):
    def arrive(name, rows):
        spark.createDataFrame(rows, "survey string, pos bigint, verdict string, kind string").coalesce(1).write.parquet(str(tmp_path / "feed" / name))

    def run():
        schema = spark.createDataFrame([], "survey string, pos bigint, verdict string, kind string").schema
        jobs.latest_per_key(spark, str(tmp_path / "feed" / "*"), schema, ["survey"], "pos", "verdict", "kind <> 'note'", str(tmp_path / "out"), str(tmp_path / "state"))

    def state():
        return {r.survey: (r.verdict, r.last_pos) for r in jobs.latest_rows(spark, str(tmp_path / "out"), ["survey"]).collect()}
    return arrive, run, state, tmp_path / "out"


def test_a_restarted_stream_writes_changed_keys_only(spark, feed):
    arrive, run, state, out = feed
    arrive("one", [("1", 1, "green", "run"), ("2", 2, "red", "run"), ("3", 3, "seen", "note"), ("1", 4, "amber", "run")])
    run()
    assert state() == {"1": ("amber", 4), "2": ("red", 2), "3": ("", 3)}
    arrive("two", [("2", 9, "green", "run"), ("2", 7, "amber", "run"), ("4", 8, "red", "run")])
    run()
    assert state() == {"1": ("amber", 4), "2": ("green", 9), "3": ("", 3), "4": ("red", 8)}
    epochs = spark.read.parquet(str(out / "changes")).filter("survey is not null").groupBy("epoch").agg(F.sort_array(F.collect_set("survey")).alias("s")).orderBy("epoch").collect()
    assert [r.s for r in epochs] == [["1", "2", "3"], ["2", "4"]]
    run()           # nothing new
    assert len(state()) == 4


def test_an_epoch_without_commit_is_not_read(spark, feed):
    arrive, run, state, out = feed
    arrive("one", [("1", 1, "green", "run")])
    run()
    spark.createDataFrame([("1", "half", 99)], "survey string, verdict string, last_pos bigint").write.parquet(str(out / "changes" / "epoch=77"))
    assert state() == {"1": ("green", 1)}
