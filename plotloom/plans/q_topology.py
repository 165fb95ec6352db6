"""Boundary reconciliation queries."""

from pyspark.sql import functions as F

from plotloom.functions import geo
from plotloom.operators import topology as tp
from plotloom.plans.catalog import query
from plotloom.plans.q_planar import _HOLES, _gaps
from plotloom.plans.shapes import corner_ring, plots, r


@query("node_parts", """select village, l.i as plot_id, 4 + case when p_size%3=0 then 1 else 0 end + case when exists (select 1 from lattice_fx o where o.village=l.village and o.c=l.c and o.r=l.r+1 and o.p_size%3=0) then 1 else 0 end as n_vertices from lattice_fx l""")
def _node(fx):
    mid = geo.pt((F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2)
    p = [geo.pt(F.col(f"x{n}"), F.col(f"y{n}")) for n in (1, 2, 3, 4)]
    ring = F.when(F.col("p_size") % 3 == 0, F.array(p[0], mid, *p[1:])).otherwise(F.array(*p))
    src = fx.lattice_fx.select("village", F.col("i").alias("plot_id"), ring.alias("ring"))
    return tp.node_parts(src, ["village"]).select("village", "plot_id", F.size("ring").cast("bigint").alias("n_vertices"))


def _sides(fx):
    l = fx.lattice_fx.withColumns({"ring": corner_ring(), "survey": F.col("i").cast("string"), "plot_id": F.col("i")})
    settled = l.filter("c % 2 = 0").select("village", "survey", "ring", F.lit(False).alias("is_anchor"))
    moving = l.filter("c % 2 = 1").select("village", "survey", "plot_id", F.transform("ring", lambda p: geo.pt(p["x"] + 0.25, p["y"] + 0.125)).alias("ring"), (F.col("r") % 2).alias("rank"))
    return moving, settled


@query("conform_targets", """with v as (select village, i, seq, x, y from ring_vertices_fx where ring_no=0) select village, cast(v.i as varchar) as survey, x+0.25 as x, y+0.125 as y, x as tx, y as ty from v join lattice_fx l using (village, i) where c%2=1 and (c<49 or seq in (0,3))""")
def _targets(fx):
    moving, settled = _sides(fx)
    return tp.conform_targets(moving.drop("rank"), settled).select("village", "survey", "x", "y", "tx", "ty")


_A = "abs((x1*{y2}-{x2}*y1)+({x2}*{y3}-{x3}*{y2})+({x3}*y4-x4*{y3})+(x4*y1-x1*y4))/2"
_SAME, _OPEN = _A.format(x2="x2", y2="y2", x3="x3", y3="y3"), _A.format(x2="(x2+0.25)", y2="(y2+0.125)", x3="(x3+0.25)", y3="(y3+0.125)")


@query("conform", f"select village, i as plot_id, round(case when c<49 then {_SAME} else {_OPEN} end,4) as area, 'conformed' as note, 4 as n_vertices from lattice_fx where c%2=1")
def _conform(fx):
    moving, settled = _sides(fx)
    c = tp.conform(moving, settled, [0, 1])
    return c.select("village", "plot_id", r(F.abs(geo.ring_area(F.col("ring"))), 4).alias("area"), "note", F.size("ring").alias("n_vertices"))


@query("conform_inserts", """select village, cast(i as varchar) as survey, i as plot_id, 0 as seq, (x1+x2)/2 as x, (y1+y2)/2+0.25 as y from lattice_fx where r%10>0
  union all select village, cast(i as varchar), i, 2, (x3+x4)/2, (y3+y4)/2+0.25 from lattice_fx where (r+1)%10>0""")
def _inserts(fx):
    # every settled plot below carries an extra vertex a quarter metre beside the middle of its top edge
    l = fx.lattice_fx
    moved = l.select("village", F.col("i").cast("string").alias("survey"), F.col("i").alias("plot_id"), corner_ring().alias("ring"))
    p = [geo.pt(F.col(f"x{n}"), F.col(f"y{n}")) for n in (1, 2, 3, 4)]
    mid = geo.pt((F.col("x4") + F.col("x3")) / 2, (F.col("y4") + F.col("y3")) / 2 + 0.25)
    settled = l.filter("(r + 1) % 10 > 0").select("village", F.concat(F.lit("s"), "i").alias("survey"), F.array(p[0], p[1], p[2], mid, p[3]).alias("ring"), F.lit(False).alias("is_anchor"))
    got = tp.conform_inserts(moved, settled)
    return got.select("village", "survey", "plot_id", "seq", "x", "y")


_OV = """(select cast(l_linenumber as varchar) as village, l_suppkey as a, 100+l_partkey%100 as b, max(l_quantity)/8 as overlap_sqm, min(l_extendedprice)/1000 as area_a, min(l_orderkey%50)+0.5 as area_b, l_suppkey%3>0 as ma, l_partkey%100%4>0 as mb, l_suppkey%7=0 as ra, l_partkey%100%5=0 as rb,
   l_suppkey%9 as ka, l_partkey%100%9 as kb from lineitem group by l_linenumber, l_suppkey, l_partkey%100)"""
_PLAN = f"""(select village, a, b, overlap_sqm, case when ay then a else b end as yields, case when ay then b else a end as keeps, case when not (case when ay then ma else mb end) then 'report only'
    when overlap_sqm>0.25*(case when ay then area_a else area_b end) then 'refused' else 'clip' end as action, ra<>rb as rail_conflict
  from (select *, case when ra<>rb then rb when ma and mb then ka>kb else ma end as ay from {_OV} o where overlap_sqm>0.02 and (ma or mb)) q)"""


def _plan(fx):
    s, p = F.col("l_suppkey"), F.col("l_partkey") % 100
    g = fx.lineitem.groupBy(F.col("l_linenumber").cast("string").alias("village"), s.alias("a"), (p + 100).alias("b")).agg((F.max("l_quantity") / 8).alias("overlap_sqm"), (F.min("l_extendedprice") / 1000).alias("area_a"),
                                                                   (F.min(F.col("l_orderkey") % 50) + 0.5).alias("area_b"))
    a, b = F.col("a"), F.col("b") - 100
    return tp.yield_plan(g.withColumns({"movable_a": a % 3 > 0, "movable_b": b % 4 > 0, "rail_a": a % 7 == 0, "rail_b": b % 5 == 0, "rank_a": a % 9, "rank_b": b % 9}))


query("yield_plan", f"select * from {_PLAN} p")(_plan)


@query("conflict_table", f"select village, a as survey_a, b as survey_b, round(overlap_sqm,2) as overlap_sqm, '{tp.CONFLICT_NOTE}' as note from {_PLAN} p where rail_conflict")
def _conflicts(fx):
    return tp.conflict_table(_plan(fx))


@query("gap_owner", f"""with h as (select * from lattice_fx where {_HOLES}),
  s as (select h.village, h.i, o.i as plot_id, case when o.r=h.r-1 then sqrt((x1b-x2b)^2+(y1b-y2b)^2) when o.r=h.r+1 then sqrt((x4b-x3b)^2+(y4b-y3b)^2) when o.c=h.c+1 then sqrt((x2b-x3b)^2+(y2b-y3b)^2) else sqrt((x1b-x4b)^2+(y1b-y4b)^2) end as m
    from (select *, x1 as x1b, y1 as y1b, x2 as x2b, y2 as y2b, x3 as x3b, y3 as y3b, x4 as x4b, y4 as y4b from h) h join (select i, village, c, r from lattice_fx) o on o.village=h.village and abs(o.c-h.c)+abs(o.r-h.r)=1)
  select village as sheet, arg_max(plot_id, struct_pack(a:=round(m,6), b:=-plot_id)) as plot_id, round(max(m),5) as shared_m from s group by village, i""")
def _owner(fx):
    p = plots(fx).select(F.col("village").alias("sheet"), F.col("i").alias("plot_id"), "ring")
    holes = fx.lattice_fx.filter("c between 1 and 48 and r % 10 between 1 and 8 and c % 4 = 1 and r % 4 = 2").select(F.col("i").alias("plot_id"))
    return tp.gap_owner(_gaps(fx), p.join(holes, "plot_id", "left_anti"), 2000.0).select("sheet", "plot_id", r(F.col("shared_m"), 5).alias("shared_m"))
