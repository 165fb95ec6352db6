"""Fit queries."""

from pyspark.sql import functions as F

from plotloom.functions import geo
from plotloom.operators import fits
from plotloom.operators import measures as ms
from plotloom.operators import ranking as rk
from plotloom.plans.catalog import query
from plotloom.plans.shapes import plots, r

_P = "p as (select survey, sx as px, sy as py, mx as qx, my as qy, l_partkey%6 as poly from control_points_fx where enable='1')"
_FIT = f"""{_P}, m as (select survey, avg(px) as ax, avg(py) as ay, avg(qx) as bx, avg(qy) as b_y, count(*) as n from p group by 1),
  c as (select p.survey, px-ax as px, py-ay as py, qx-bx as qx, qy-b_y as qy, poly from p join m on m.survey=p.survey),
  s as (select survey, sum(px*qx) as xx, sum(px*qy) as xy, sum(py*qx) as yx, sum(py*qy) as yy, sum(px*px) as pxx, sum(px*py) as pxy, sum(py*py) as pyy from c group by 1),
  t as (select s.*, atan2(xy-yx, xx+yy) as th, n, ax, ay, bx, b_y from s join m on m.survey=s.survey),
  f as (select survey, degrees(th) as theta, bx-(cos(th)*ax-sin(th)*ay) as tx, b_y-(sin(th)*ax+cos(th)*ay) as ty, n, th from t),
  e as (select c.survey, sqrt(avg((cos(th)*px-sin(th)*py-qx)^2+(sin(th)*px+cos(th)*py-qy)^2)) as rms, sqrt(max((cos(th)*px-sin(th)*py-qx)^2+(sin(th)*px+cos(th)*py-qy)^2)) as max_m from c join f on f.survey=c.survey group by 1)"""


def pairs(fx):
    return fx.control_points_fx.filter("enable = '1'").select("survey", F.col("sx").alias("px"), F.col("sy").alias("py"), F.col("mx").alias("qx"),
                                                              F.col("my").alias("qy"), (F.col("l_partkey") % 6).alias("poly"))


def points(fx):
    return fx.control_points_fx.filter("enable = '1'").select("survey", F.col("sx").alias("source_x"), F.col("sy").alias("source_y"),
                                                              F.col("mx").alias("map_x"), F.col("my").alias("map_y"))


@query("rigid_fit", f"with {_FIT} select f.survey, round(theta,5) as theta, round(tx,3) as tx, round(ty,3) as ty, n, round(rms,5) as rms, round(max_m,5) as max_m from f join e on e.survey=f.survey")
def _rigid(fx):
    return fits.rigid_fit(pairs(fx), ["survey"]).select("survey", r(F.col("theta"), 5).alias("theta"), r(F.col("tx"), 3).alias("tx"), r(F.col("ty"), 3).alias("ty"),
                                                        "n", r(F.col("rms"), 5).alias("rms"), r(F.col("max_m"), 5).alias("max_m"))


_SIM = f"""with {_FIT}, g as (select *, sqrt(xx^2+xy^2+yx^2+yy^2+2*abs(xx*yy-xy*yx))/(pxx+pyy) as scale, pxx*pyy-pxy^2 as pd from t),
  af as (select *, (xx*pyy-yx*pxy)/pd as a, (yx*pxx-xx*pxy)/pd as b, (xy*pyy-yy*pxy)/pd as cc, (yy*pxx-xy*pxy)/pd as d from g),
  an as (select *, sqrt((a^2+b^2+cc^2+d^2 + sqrt((a^2+b^2-cc^2-d^2)^2+4*(a*cc+b*d)^2))/2) as s1, sqrt((a^2+b^2+cc^2+d^2 - sqrt((a^2+b^2-cc^2-d^2)^2+4*(a*cc+b*d)^2))/2) as s2 from af),
  es as (select c.survey, sqrt(avg((scale*(cos(th)*px-sin(th)*py)-qx)^2+(scale*(sin(th)*px+cos(th)*py)-qy)^2)) as srms from c join g on g.survey=c.survey group by 1)"""


@query("similarity_fit", _SIM + " select an.survey, round(degrees(th),5) as theta, round(scale,6) as scale, round(s1/s2,5) as anisotropy, round(srms,5) as rms from an join es on es.survey=an.survey")
def _similar(fx):
    return fits.similarity_fit(pairs(fx), ["survey"]).select("survey", r(F.col("theta"), 5).alias("theta"), r(F.col("scale")).alias("scale"),
                                                             r(F.col("anisotropy"), 5).alias("anisotropy"), r(F.col("rms"), 5).alias("rms"))


@query("pose_from_points", _SIM + " select f.survey, round(theta,5) as theta, round(f.tx,3) as tx, round(f.ty,3) as ty, f.n, round(rms,5) as rms, round(scale,6) as scale, round(s1/s2,5) as anisotropy from f join e on e.survey=f.survey join an on an.survey=f.survey where f.n>=2")
def _points(fx):
    return fits.pose_from_points(points(fx), ["survey"]).select("survey", r(F.col("theta"), 5).alias("theta"), r(F.col("tx"), 3).alias("tx"), r(F.col("ty"), 3).alias("ty"), "n",
                                                                r(F.col("rms"), 5).alias("rms"), r(F.col("scale")).alias("scale"), r(F.col("anisotropy"), 5).alias("anisotropy"))


@query("truth_source", f"""with {_FIT}, pp as (select f.survey, theta, tx, ty, rms*cast(cast(f.survey as int)%9 as double) as rms from f join e on e.survey=f.survey where cast(f.survey as int)%5<>0),
  gp as (select cast(s_suppkey as varchar) as survey, cast(s_suppkey%90 as double) as theta, cast(s_suppkey as double) as tx, 0.0::double as ty, 0.5::double as rms from supplier where s_suppkey%7<>0)
  select coalesce(pp.survey,gp.survey) as survey, round(case when pp.rms<=3 then pp.theta else gp.theta end,5) as theta, round(case when pp.rms<=3 then pp.tx else gp.tx end,3) as tx,
    case when pp.rms<=3 then 'points' else 'geometry' end as source from pp full join gp on gp.survey=pp.survey where coalesce(pp.rms<=3,false) or gp.survey is not null""")
def _truth(fx):
    k = F.col("survey").cast("int")
    pp = fits.rigid_fit(pairs(fx), ["survey"]).filter(k % 5 != 0).withColumn("rms", F.col("rms") * (k % 9).cast("double"))
    s = F.col("s_suppkey")
    gp = fx.supplier.filter(s % 7 != 0).select(s.cast("string").alias("survey"), (s % 90).cast("double").alias("theta"), s.cast("double").alias("tx"), F.lit(0.0).alias("ty"), F.lit(0.5).alias("rms"))
    return fits.truth_source(pp, gp, ["survey"]).select("survey", r(F.col("theta"), 5).alias("theta"), r(F.col("tx"), 3).alias("tx"), "source")


@query("jackknife_heading", f"""with {_FIT}, u as (select survey, poly, count(*) as n, sum(px) as a, sum(py) as b, sum(qx) as c, sum(qy) as d, sum(px*qx+py*qy) as dot, sum(px*qy-py*qx) as crs from c group by 1,2),
  k as (select u.survey, sum(o.n) as n, sum(o.a) as a, sum(o.b) as b, sum(o.c) as c, sum(o.d) as d, sum(o.dot) as dot, sum(o.crs) as crs from u join u o on o.survey=u.survey and o.poly<>u.poly group by u.survey, u.poly)
  select survey, round(max(degrees(atan2(crs-(a*d-b*c)/n, dot-(a*c+b*d)/n)))-min(degrees(atan2(crs-(a*d-b*c)/n, dot-(a*c+b*d)/n))),6) as heading_spread from k group by 1""")
def _jack(fx):
    return fits.jackknife_heading(pairs(fx), ["survey"], ["poly"]).withColumn("heading_spread", r(F.col("heading_spread")))


_OBS = "(select cast(l_suppkey as varchar) as a, cast(l_partkey%100 as varchar) as b, l_quantity as pax, cast(l_linenumber*5 as double) as pay, l_quantity+1 as pbx, cast(l_orderkey%30 as double) as pby from lineitem)"


@query("residuals_by_pair", f"""with po as (select cast(s_suppkey as varchar) as survey, cast((s_suppkey*37)%360 as double) as theta, cast(s_suppkey as double)/4 as tx, cast(s_suppkey%13 as double) as ty from supplier),
  j as (select o.a, o.b, cos(radians(p.theta))*pax-sin(radians(p.theta))*pay+p.tx-(cos(radians(q.theta))*pbx-sin(radians(q.theta))*pby+q.tx) as dx, sin(radians(p.theta))*pax+cos(radians(p.theta))*pay+p.ty-(sin(radians(q.theta))*pbx+cos(radians(q.theta))*pby+q.ty) as dy
    from {_OBS} o join po p on p.survey=o.a join po q on q.survey=o.b)
  select a, b, count(*) as n, round(sqrt(avg(dx*dx+dy*dy)),5) as rms, round(sqrt(max(dx*dx+dy*dy)),5) as max_m from j group by 1,2""")
def _residuals(fx):
    s = F.col("s_suppkey")
    po = fx.supplier.select(s.cast("string").alias("survey"), ((s * 37) % 360).cast("double").alias("theta"), (s.cast("double") / 4).alias("tx"), (s % 13).cast("double").alias("ty"))
    o = fx.lineitem.select(F.col("l_suppkey").cast("string").alias("a"), (F.col("l_partkey") % 100).cast("string").alias("b"), F.col("l_quantity").alias("pax"),
                           (F.col("l_linenumber") * 5).cast("double").alias("pay"), (F.col("l_quantity") + 1).alias("pbx"), (F.col("l_orderkey") % 30).cast("double").alias("pby"))
    return fits.residuals_by_pair(o, po, []).select("a", "b", "n", r(F.col("rms"), 5).alias("rms"), r(F.col("max_m"), 5).alias("max_m"))


_SHOE = "abs((x1*y2-x2*y1)+(x2*y3-x3*y2)+(x3*y4-x4*y3)+(x4*y1-x1*y4))/2"


@query("area_scale", f"select village, survey, round(sqrt(sum({_SHOE}*(1+poly_id/64.0::double))/sum({_SHOE})),6) as area_scale from lattice_fx group by 1,2")
def _scale(fx):
    p = plots(fx).select("village", "survey", "poly_id", F.abs(geo.ring_area(F.col("ring"))).alias("area"))
    return fits.area_scale(p.withColumn("area", F.col("area") * (F.col("poly_id") / 64.0 + 1)), p, ["village", "survey"]).withColumn("area_scale", r(F.col("area_scale")))


@query("area_ratio_check", f"""with t as (select survey, sum({_SHOE}) as total, max(i) as i from lattice_fx group by 1), s as (select survey, total, case when i%16=3 then null when i%16=7 then 0 else cast(3900+i%300 as double) end as st from t)
  select survey, round(total,2) as polygon_total_sqm, round(total/nullif(st,0),3) as area_ratio, round(100*(total-st)/nullif(st,0),2) as deviation_pct from s""")
def _ratio(fx):
    p = plots(fx).select("survey", F.abs(geo.ring_area(F.col("ring"))).alias("area"))
    i = F.col("i")
    st = fx.lattice_fx.groupBy("survey").agg(F.max("i").alias("i")).select("survey", F.when(i % 16 == 3, None).when(i % 16 == 7, 0.0).otherwise((i % 300 + 3900).cast("double")).alias("stated"))
    return fits.area_ratio_check(p, st, ["survey"])


@query("team_points_newer", f"""with {_FIT}, fr as (select cast(s_suppkey as varchar) as survey from supplier where s_suppkey%4=0 or s_suppkey%4>=2)
  select f.survey, round(theta,5) as theta, round(tx,3) as tx, round(ty,3) as ty, n, round(rms,5) as rms from f join e on e.survey=f.survey join fr on fr.survey=f.survey where n>=2""")
def _newer(fx):
    s = F.col("s_suppkey")
    t0 = F.lit("2026-09-01 00:00:00").cast("timestamp")
    files = fx.supplier.select(s.cast("string").alias("survey"), t0.alias("mtime"))
    late = F.when(s % 4 == 1, F.expr("timestamp'2026-08-31 23:59:59.5'")).when(s % 4 == 2, F.expr("timestamp'2026-08-31 23:59:58'")).otherwise(F.expr("timestamp'2026-08-01 00:00:00'"))
    records = fx.supplier.filter(s % 4 != 0).select(s.cast("string").alias("survey"), late.alias("written"))
    f = fits.team_points_newer(points(fx), files, records, ["survey"])
    return f.select("survey", r(F.col("theta"), 5).alias("theta"), r(F.col("tx"), 3).alias("tx"), r(F.col("ty"), 3).alias("ty"), "n", r(F.col("rms"), 5).alias("rms"))


@query("nearest_vertex_pairs", """
  with v as (select survey, count(*) as n from (select distinct survey, poly_id, x, y from ring_vertices_fx where ring_no=0) q group by 1)
  select village, p.survey, round(((theta+540)%360)-180,4)+0.0 as theta, round(tx,2) as tx, round(ty,2) as ty, n from poses_fx p join v on v.survey=p.survey""")
def _vertices(fx):
    key = ["village", "survey"]
    p = plots(fx)
    v = ms.ring_vertices(p, [*key, "poly_id"]).select(*key, F.col("poly_id").alias("plot_id"), "x", "y")
    placed = ms.place(p, fx.poses_fx, key).withColumn("rings", F.col("ground"))
    hand = ms.ring_vertices(placed, [*key, "poly_id"]).select(*key, F.col("poly_id").alias("plot_id"), F.col("x").alias("hx"), F.col("y").alias("hy"))
    cs = geo.ring_centroid(F.col("ring"))
    cg = geo.ring_centroid(F.col("ground")[0])
    start = fits.rigid_fit(ms.place(p, fx.poses_fx, key).select(*key, cs["x"].alias("px"), cs["y"].alias("py"), (cg["x"] + F.col("poly_id") / 8).alias("qx"), cg["y"].alias("qy")), key)
    sizes = p.groupBy(*key).agg(F.sqrt(F.sum(F.abs(geo.ring_area(F.col("ring"))))).alias("size"))
    out = fits.nearest_vertex_refine(v, hand, start, sizes, key)
    return out.select(*key, r(F.pmod(F.col("theta") + 540, F.lit(360.0)) - 180, 4).alias("theta"), r(F.col("tx"), 2).alias("tx"), r(F.col("ty"), 2).alias("ty"), "n")


@query("polygon_numbering", f"select survey, i, row_number() over (partition by survey order by round({_SHOE},4) desc, i) as poly_no from lattice_fx")
def _number(fx):
    a = F.round(F.abs(geo.ring_area(F.col("ring"))), 4)
    p = plots(fx).select("survey", "i", a.alias("area"))
    return rk.ranked(p, ["survey"], [-F.floor(F.log2("area"))], [F.desc("area"), F.col("i")], "poly_no").select("survey", "i", "poly_no")


@query("chainage", """with e as (select v.i, v.ring_no, v.seq, sqrt((n.x-v.x)^2+(n.y-v.y)^2) as len from ring_vertices_fx v join ring_vertices_fx n on n.i=v.i and n.ring_no=v.ring_no and n.seq=(v.seq+1)%4)
  select i, ring_no, seq, round(coalesce(sum(len) over (partition by i, ring_no order by seq rows between unbounded preceding and 1 preceding),0),6) as at_m from e""")
def _chainage(fx):
    from plotloom.operators import matching
    return matching.chainage(plots(fx, True), ["i"]).withColumn("at_m", r(F.col("at_m")))
