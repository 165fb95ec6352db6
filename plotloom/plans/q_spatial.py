"""Spatial join queries."""

from pyspark.sql import functions as F

from plotloom.functions import geo, rings
from plotloom.operators import evaluation as ev  # noqa: F401
from plotloom.operators import measures as ms
from plotloom.operators import neighbours as nb
from plotloom.operators import spatial as sp
from plotloom.plans.catalog import query
from plotloom.plans.shapes import plots, r

KEY = ["village", "survey", "poly_id"]
_IN = """(select l.label_id, l.village, l.label, l.x, l.y, p.i as plot_id, a.area from label_points_fx l join lattice_fx p on p.village=l.village and l.x between least(p.x1,p.x4) and greatest(p.x2,p.x3) and l.y between least(p.y1,p.y2) and greatest(p.y3,p.y4)
   join area a on a.i=p.i where (select count(*) from edge e where e.i=p.i and e.ring_no=0 and (e.y>l.y)<>(e.ny>l.y) and e.x+(l.y-e.y)*(e.nx-e.x)/(e.ny-e.y)>l.x)%2=1
   and (select count(*) from edge e where e.i=p.i and e.ring_no=1 and (e.y>l.y)<>(e.ny>l.y) and e.x+(l.y-e.y)*(e.nx-e.x)/(e.ny-e.y)>l.x)%2=0)"""
EDGE = """edge as materialized (select v.*, n.x as nx, n.y as ny from ring_vertices_fx v join ring_vertices_fx n on n.i=v.i and n.ring_no=v.ring_no and n.seq=(v.seq+1)%4)"""
_AREA = "area as (select i, sum(case when ring_no=0 then abs(s) else -abs(s) end) as area from (select i, ring_no, sum(x*ny-nx*y)/2 as s from edge group by 1,2) q group by 1)"


def _plots(fx):
    return plots(fx, True).withColumns({"plot_id": F.col("i"), "area": geo.net_area(F.col("rings"))})


@query("point_in_polygon", f"with {EDGE}, {_AREA} select label_id, plot_id from {_IN} q")
def _pip(fx):
    return sp.containing_polygons(fx.label_points_fx, _plots(fx), "village", 32.0).select("label_id", "plot_id")


@query("label_to_polygon", f"with {EDGE}, {_AREA}, h as (select label_id, arg_min(plot_id, struct_pack(a:=area, b:=plot_id)) as plot_id from {_IN} q group by 1) select l.label_id, l.village, plot_id from label_points_fx l left join h on h.label_id=l.label_id")
def _assign(fx):
    return sp.label_to_polygon(fx.label_points_fx, _plots(fx), "village", 32.0).select("label_id", "village", "plot_id")


@query("resolve_labels", f"""
  with {EDGE}, {_AREA}, h as (select label_id, label, x, y, arg_min(plot_id, struct_pack(a:=area, b:=plot_id)) as plot_id from {_IN} q group by 1,2,3,4),
  m as (select i, avg(x) as cx, avg(y) as cy from ring_vertices_fx where ring_no=0 group by 1),
  d as (select h.*, row_number() over (partition by plot_id order by sqrt((x-cx)^2+(y-cy)^2), label_id) as k, count(*) over (partition by plot_id) as n from h join m on m.i=plot_id),
  g as (select plot_id, max(n) as n, max(case when k=1 then label end) as plot_no, string_agg(label,'/' order by k) filter (where k>1) as alt from d group by 1)
  select village, i as plot_id, g.plot_no, coalesce(n,0) as n_labels_in_polygon, alt as alt_labels, case when g.plot_no is not null then 1 else 0 end as numbered,
   case when n>1 then 1 else 0 end as review_needed, case when g.plot_no is not null then 'glyph_outline' else 'none' end as label_source from lattice_fx left join g on g.plot_id=i""")
def _resolve(fx):
    p = _plots(fx)
    a = sp.label_to_polygon(fx.label_points_fx, p, "village", 32.0)
    return sp.resolve_labels(p.select("village", "plot_id", "rings"), a, "sketch").drop("rings")


_SAMP = """samp as materialized (select i, village, survey, poly_id, seq as edge_no, k, x+(nx-x)*(k+0.5::double)/n as x, y+(ny-y)*(k+0.5::double)/n as y, atan2(ny-y,nx-x) as bearing
   from (select *, greatest(1, round_even(sqrt((nx-x)^2+(ny-y)^2)/{0},0)) as n from edge where ring_no=0) e, range(0,60) g(k) where k<n)"""
_FEATS = """feats as materialized (select edge_id, village, ax+(bx-ax)*k/n as x, ay+(b_y-ay)*k/n as y, ((atan2(b_y-ay,bx-ax)%pi())+pi())%pi() as bearing from
   (select *, greatest(2, floor(sqrt((bx-ax)^2+(b_y-ay)^2)/0.5)) as n from features_fx) e, range(0,120) g(k) where k<=n)"""


def _near(points: str, cols: str) -> str:
    """Nearest feature sample per point, within 2.5 m, by brute force over the edges whose box is near."""
    return f"""near as (select {cols}, arg_min(struct_pack(d:=(f.x-p.x)*(f.x-p.x)+(f.y-p.y)*(f.y-p.y), b:=f.bearing), struct_pack(d:=(f.x-p.x)*(f.x-p.x)+(f.y-p.y)*(f.y-p.y), b:=f.bearing)) as m
     from {points} p join features_fx e on e.village=p.village and p.x between least(e.ax,e.bx)-3 and greatest(e.ax,e.bx)+3 and p.y between least(e.ay,e.b_y)-3 and greatest(e.ay,e.b_y)+3
     join feats f on f.edge_id=e.edge_id where (f.x-p.x)*(f.x-p.x)+(f.y-p.y)*(f.y-p.y)<=6.25 group by all)"""


@query("nearest_sample", f"""
  with {_FEATS}, pts as (select village, i, seq, x, y from ring_vertices_fx where ring_no=0), {_near('pts', 'p.i, p.seq')}
  select pts.i, pts.seq, round(sqrt(m.d),6) as dist, round(m.b,6) as bearing from pts left join near on near.i=pts.i and near.seq=pts.seq""")
def _nearest(fx):
    v = ms.ring_vertices(plots(fx), ["village", "i"])
    n = sp.nearest_sample(v.select("village", "i", "seq", "x", "y"), fx.features_fx, ["village"], ["i", "seq"], 2.5)
    return n.select("i", "seq", r(F.col("dist")).alias("dist"), r(F.col("s_bearing")).alias("bearing"))


@query("share_score", f"""
  with {EDGE}, {_SAMP.format('1.0')}, {_FEATS},
  mv as materialized (select s.village, s.survey, s.i, s.edge_no, s.k, theta, bearing, cos(radians(theta))*x-sin(radians(theta))*y+tx as x, sin(radians(theta))*x+cos(radians(theta))*y+ty as y from samp s join near_poses_fx p on p.village=s.village and p.survey=s.survey),
  {_near('mv', 'p.i, p.edge_no, p.k')},
  j as (select mv.*, m.d as d2, ((degrees(m.b)-degrees(bearing)-theta)%180+180)%180 as g from mv left join near n on n.i=mv.i and n.edge_no=mv.edge_no and n.k=mv.k)
  select village, survey, count(*) as n, round(count(*) filter (where sqrt(d2)<=1.5 and least(g,180-g)<=12)/count(*)::double,6) as share from j group by 1,2""")
def _share(fx):
    s = ms.outline_samples(plots(fx), KEY, 1.0, packed=True)
    out = sp.share_score(s, fx.near_poses_fx.select("village", "survey", "theta", "tx", "ty"), fx.features_fx, ["village", "survey"], [])
    return out.withColumn("share", r(F.col("share")))


@query("nearest_boundary_line", f"""
  with {EDGE}, {_SAMP.format('2.0')},
  j as (select s.i, s.edge_no, s.k, s.x, s.y, ax, ay, bx, b_y, greatest(0,least(1,((s.x-ax)*(bx-ax)+(s.y-ay)*(b_y-ay))/((bx-ax)^2+(b_y-ay)^2))) as t from samp s
   join features_fx f on f.village=s.village and s.x between least(ax,bx)-2 and greatest(ax,bx)+2 and s.y between least(ay,b_y)-2 and greatest(ay,b_y)+2),
  m as (select i, edge_no, k, min(sqrt((x-(ax+t*(bx-ax)))^2+(y-(ay+t*(b_y-ay)))^2)) as dist from j group by 1,2,3)
  select i, edge_no, k, round(dist,6) as dist from m where dist<=2""")
def _line(fx):
    s = ms.outline_samples(plots(fx), ["village", "i"], 2.0, packed=True)
    return sp.nearest_boundary_line(s, fx.features_fx, ["village"], ["i", "edge_no", "k"]).select("i", "edge_no", "k", r(F.col("dist")).alias("dist"))


def _each_plot(fx):
    """Every plot taken as a sheet of its own at its survey's pose: outlines, poses, neighbour pairs."""
    p = plots(fx).join(fx.near_poses_fx, ["village", "survey"])
    out = p.select("village", F.col("i").cast("string").alias("survey"), "ring", "theta", (F.col("tx") + F.col("i") % 3 * 0.25).alias("tx"), "ty", "rms")
    g = fx.lattice_fx.select("village", F.col("i").cast("string").alias("survey"), "c", "r")
    steps = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))]))
    to = g.select("village", "survey", "c", "r", steps.alias("s")).select("village", "survey", (F.col("c") + F.col("s.a")).alias("c"), (F.col("r") + F.col("s.b")).alias("r"))
    pairs = to.join(g.withColumnRenamed("survey", "other"), ["village", "c", "r"]).select("village", "survey", "other")
    return out, pairs


@query("boundary_line_observations", f"""
  with {EDGE}, {_SAMP.format('2.0')}, po as materialized (select l.i, l.village, l.c, l.r, theta, tx+(l.i%3)*0.25::double as tx, ty, rms from lattice_fx l join near_poses_fx p on p.village=l.village and p.survey=l.survey),
  pr as materialized (select a.i as a, b.i as b from po a join po b on b.village=a.village and abs(a.c-b.c)+abs(a.r-b.r)=1),
  gs as materialized (select s.i, edge_no, k, cos(radians(theta))*x-sin(radians(theta))*y+tx as gx, sin(radians(theta))*x+cos(radians(theta))*y+ty as gy, degrees(bearing)+theta as dir from samp s join po on po.i=s.i),
  ge as materialized (select e.i, e.seq as o_edge, rms, cos(radians(theta))*x-sin(radians(theta))*y+tx as ax, sin(radians(theta))*x+cos(radians(theta))*y+ty as ay, cos(radians(theta))*nx-sin(radians(theta))*ny+tx as bx, sin(radians(theta))*nx+cos(radians(theta))*ny+ty as b_y
     from edge e join po on po.i=e.i where ring_no=0),
  j as (select gs.i, pr.b, edge_no, k, o_edge, rms, ((gx-ax)*(bx-ax)+(gy-ay)*(b_y-ay))/((bx-ax)^2+(b_y-ay)^2) as t, abs((gx-ax)*(b_y-ay)-(gy-ay)*(bx-ax))/sqrt((bx-ax)^2+(b_y-ay)^2) as perp,
     ((degrees(atan2(b_y-ay,bx-ax))-dir)%180+180)%180 as g, sqrt((bx-ax)^2+(b_y-ay)^2) as len from gs join pr on pr.a=gs.i join ge on ge.i=pr.b)
  select cast(i as varchar) as survey, cast(b as varchar) as other, edge_no, k, round(min(perp),5) as perp, round(min(rms)+0.6,6) as sigma from j where len>=1 and least(g,180-g)<=15 and t between -0.05 and 1.05 and perp<=8 group by 1,2,3,4""")
def _observe(fx):
    out, pairs = _each_plot(fx)
    o = sp.boundary_line_observations(out.select("village", "survey", "ring"), out.drop("ring"), pairs)
    return o.select("survey", "other", "edge_no", "k", r(F.col("perp"), 5).alias("perp"), r(F.col("sigma")).alias("sigma"))


def _bodies(fx):
    """Plots on the ground at their survey's pose."""
    p = ms.place(plots(fx), fx.near_poses_fx.select("village", "survey", "theta", (F.col("tx") * 2).alias("tx"), "ty"), ["village", "survey"])
    p = p.join(fx.near_poses_fx.select("village", "survey", (F.col("rms") / 4).alias("rms")), ["village", "survey"])
    b = p.select("village", "survey", F.col("i").alias("id"), F.col("ground")[0].alias("ring"), "rms")
    return sp.with_box(b, F.col("ring"))


_BODY = """body as materialized (select v.i, v.village, v.seq, p.rms/4 as rms, cos(radians(theta))*x-sin(radians(theta))*y+tx*2 as x, sin(radians(theta))*x+cos(radians(theta))*y+ty as y from ring_vertices_fx v
     join near_poses_fx p on p.village=v.village and p.survey=v.survey where ring_no=0),
  be as materialized (select a.*, b.x as nx, b.y as ny from body a join body b on b.i=a.i and b.seq=(a.seq+1)%4),
  bb as materialized (select i, village, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1, max(rms) as rms, sum(sqrt((nx-x)^2+(ny-y)^2)) as per from be group by 1,2),
  bp as materialized (select a.i as a, b.i as b, a.per, a.rms+b.rms+0.3::double as allowed from bb a join bb b on b.village=a.village and a.i<b.i and b.x0<=a.x1+5 and b.x1>=a.x0-5 and b.y0<=a.y1+5 and b.y1>=a.y0-5),
  both_ways as (select a, b, a as pa, b as pb from bp union all select a, b, b, a from bp),
  vd as (select w.a, w.b, v.x, v.y, e.x as ex, e.y as ey, e.nx, e.ny, greatest(0,least(1,((v.x-e.x)*(e.nx-e.x)+(v.y-e.y)*(e.ny-e.y))/((e.nx-e.x)^2+(e.ny-e.y)^2))) as t from both_ways w join body v on v.i=w.pa join be e on e.i=w.pb),
  gd as (select a, b, min(sqrt((x-(ex+t*(nx-ex)))^2+(y-(ey+t*(ny-ey)))^2)) as d from vd group by 1,2),
  ins as (select w.a, w.b, v.seq, count(*)%2 as inside from both_ways w join body v on v.i=w.pa join be e on e.i=w.pb and (e.y>v.y)<>(e.ny>v.y) and e.x+(v.y-e.y)*(e.nx-e.x)/(e.ny-e.y)>v.x where v.seq=0 group by w.a, w.b, w.pa, v.seq),
  crs as (select distinct p.a, p.b from bp p join be e on e.i=p.a join be f on f.i=p.b where ((e.nx-e.x)*(f.y-e.y)-(e.ny-e.y)*(f.x-e.x))*((e.nx-e.x)*(f.ny-e.y)-(e.ny-e.y)*(f.nx-e.x))<0
     and ((f.nx-f.x)*(e.y-f.y)-(f.ny-f.y)*(e.x-f.x))*((f.nx-f.x)*(e.ny-f.y)-(f.ny-f.y)*(e.nx-f.x))<0),
  zero as (select a, b from crs union select a, b from ins where inside=1),
  gaps as materialized (select gd.a, gd.b, case when z.a is not null then 0 else d end as gap from gd left join zero z on z.a=gd.a and z.b=gd.b)"""


@query("close_pairs", f"with {_BODY} select a, b, round(gap,5)+0.0 as gap_m from gaps where gap<=5")
def _close(fx):
    return sp.close_pairs(_bodies(fx), ["village"], 5.0, 64.0).select(F.col("id").alias("a"), F.col("o_id").alias("b"), r(F.col("gap_m"), 5).alias("gap_m"))


@query("anchor_conflicts", f"""with {_BODY}, run as (select *, sqrt((nx-x)^2+(ny-y)^2) as len, coalesce(sum(sqrt((nx-x)^2+(ny-y)^2)) over (partition by i order by seq rows between unbounded preceding and 1 preceding),0) as s0 from be),
  cp as (select g.a, g.b, p.per, p.allowed, greatest(20, floor(p.per)) as n from gaps g join bp p on p.a=g.a and p.b=g.b where gap<=5),
  sm as materialized (select c.a, c.b, allowed, k, e.x+(e.nx-e.x)*(k/n*per-s0)/len as x, e.y+(e.ny-e.y)*(k/n*per-s0)/len as y from cp c join run e on e.i=c.a, range(0,400) g(k) where k<n and k/n*per>=s0 and k/n*per<s0+len),
  ds as (select s.a, s.b, allowed, k, min(sqrt((s.x-(e.x+greatest(0,least(1,((s.x-e.x)*(e.nx-e.x)+(s.y-e.y)*(e.ny-e.y))/((e.nx-e.x)^2+(e.ny-e.y)^2)))*(e.nx-e.x)))^2+(s.y-(e.y+greatest(0,least(1,((s.x-e.x)*(e.nx-e.x)+(s.y-e.y)*(e.ny-e.y))/((e.nx-e.x)^2+(e.ny-e.y)^2)))*(e.ny-e.y)))^2)) as d,
     count(*) filter (where (e.y>s.y)<>(e.ny>s.y) and e.x+(s.y-e.y)*(e.nx-e.x)/nullif(e.ny-e.y,0)>s.x)%2 as inside from sm s join be e on e.i=s.b group by 1,2,3,4),
  q as (select a, b, max(allowed) as allowed, quantile_cont(d,0.9) as p90 from ds where inside=1 or d<3 group by 1,2)
  select a, b, round(p90,4) as p90_gap_m, round(allowed,4) as allowed_m from q where p90>allowed""")
def _conflicts(fx):
    c = sp.anchor_conflicts(_bodies(fx), ["village"])
    return c.select(F.col("id").alias("a"), F.col("o_id").alias("b"), r(F.col("p90_gap_m"), 4).alias("p90_gap_m"), r(F.col("allowed_m"), 4).alias("allowed_m"))


@query("overlap_ledger")
def _overlaps(fx):
    o = sp.overlap_ledger(_bodies(fx), ["village"])
    return o.select(F.col("id").alias("a"), F.col("o_id").alias("b"), F.round("overlap_sqm", 4).alias("overlap_sqm"))


def _two(fx):
    """Sheet at the fitted pose and the hand reading of every plot."""
    p = ms.place(plots(fx), fx.near_poses_fx, ["village", "survey"])
    hand = F.transform("ring", lambda q: geo.pt(q["x"] * 1.015625 + 0.25, q["y"] - 0.5))
    return p.select(*KEY, F.col("ground")[0].alias("ring"), hand.alias("hand"), "theta")


_TWO = """ra as materialized (select v.i, v.seq, cos(radians(theta))*x-sin(radians(theta))*y+tx as x, sin(radians(theta))*x+cos(radians(theta))*y+ty as y, theta from ring_vertices_fx v join near_poses_fx p on p.village=v.village and p.survey=v.survey where ring_no=0),
  rb as materialized (select i, seq, x*1.015625::double+0.25 as x, y-0.5 as y from ring_vertices_fx where ring_no=0),
  ae as materialized (select a.*, b.x as nx, b.y as ny from ra a join ra b on b.i=a.i and b.seq=(a.seq+1)%4), hb as materialized (select a.*, b.x as nx, b.y as ny from rb a join rb b on b.i=a.i and b.seq=(a.seq+1)%4)"""
_PD = "sqrt(({0}.x-(e.x+greatest(0,least(1,(({0}.x-e.x)*(e.nx-e.x)+({0}.y-e.y)*(e.ny-e.y))/((e.nx-e.x)^2+(e.ny-e.y)^2)))*(e.nx-e.x)))^2+({0}.y-(e.y+greatest(0,least(1,(({0}.x-e.x)*(e.nx-e.x)+({0}.y-e.y)*(e.ny-e.y))/((e.nx-e.x)^2+(e.ny-e.y)^2)))*(e.ny-e.y)))^2)"


@query("hausdorff", f"""with {_TWO}, d as (select a.i, a.seq, min({_PD.format('a')}) as d from ra a join hb e on e.i=a.i group by 1,2 union all select b.i, b.seq, min({_PD.format('b')}) from rb b join ae e on e.i=b.i group by 1,2)
  select i, round(max(d),5) as hausdorff_m from d group by 1""")
def _haus(fx):
    t = _two(fx).join(fx.lattice_fx.select(*KEY, "i"), KEY)
    return t.select("i", r(rings.hausdorff(F.col("ring"), F.col("hand")), 5).alias("hausdorff_m"))


@query("reading_disagreement", f"""with {_TWO},
  s as (select i, seq, k, x+(nx-x)*(k+0.5::double)/n as x, y+(ny-y)*(k+0.5::double)/n as y from (select *, greatest(1, round_even(sqrt((nx-x)^2+(ny-y)^2),0)) as n from ae) q, range(0,60) g(k) where k<n),
  d as (select s.i, s.seq, s.k, min({_PD.format('s')}) as d from s join hb e on e.i=s.i group by 1,2,3), c as (select a.i, a.seq, least(10, min(sqrt((a.x-b.x)^2+(a.y-b.y)^2))) as d from ra a join rb b on b.i=a.i group by 1,2),
  m as (select i, avg(d) as mean_m, quantile_cont(d,0.95) as p95_m, max(d) as max_m from d group by 1), k as (select i, avg(d) as cm, max(d) as cx, count(*) filter (where d<10) as n from c group by 1)
  select village, survey, poly_id, round(mean_m,5) as mean_m, round(p95_m,5) as p95_m, round(max_m,5) as max_m, round(cm,5) as corner_mean_m, round(cx,5) as corner_max_m, n as corners_matched from m join k using (i) join lattice_fx using (i)""")
def _disagree(fx):
    d = sp.reading_disagreement(_two(fx), KEY)
    return d.select(*KEY, *[r(F.col(c), 5).alias(c) for c in ("mean_m", "p95_m", "max_m", "corner_mean_m", "corner_max_m")], "corners_matched")


@query("placement_errors", f"""with {_TWO}, cen as (select i, x0+sum((x-x0+nx-x0)*((x-x0)*(ny-y0)-(nx-x0)*(y-y0)))/(3*sum((x-x0)*(ny-y0)-(nx-x0)*(y-y0))) as cx, y0+sum((y-y0+ny-y0)*((x-x0)*(ny-y0)-(nx-x0)*(y-y0)))/(3*sum((x-x0)*(ny-y0)-(nx-x0)*(y-y0))) as cy, max(theta) as th
     from (select *, first_value(x) over (partition by i order by seq) as x0, first_value(y) over (partition by i order by seq) as y0 from ae) q group by i, x0, y0),
  sh as (select v.i, v.seq, v.x, v.y from ring_vertices_fx v where ring_no=0), se as (select a.*, b.x as nx, b.y as ny from sh a join sh b on b.i=a.i and b.seq=(a.seq+1)%4),
  cs as (select i, sum((x+nx)*(x*ny-nx*y))/(3*sum(x*ny-nx*y)) as cx, sum((y+ny)*(x*ny-nx*y))/(3*sum(x*ny-nx*y)) as cy from se group by i),
  ch as (select i, sum((x+nx)*(x*ny-nx*y))/(3*sum(x*ny-nx*y)) as cx, sum((y+ny)*(x*ny-nx*y))/(3*sum(x*ny-nx*y)) as cy from hb group by i),
  hd as (select i, max(d) as d from (select a.i, a.seq, min({_PD.format('a')}) as d from ra a join se e on e.i=a.i group by 1,2 union all select b.i, b.seq, min({_PD.format('b')}) from sh b join ae e on e.i=b.i group by 1,2) q group by 1)
  select village, survey, poly_id, round(sqrt((cen.cx-cs.cx)^2+(cen.cy-cs.cy)^2),3) as err_fmb_m, round(sqrt((cen.cx-ch.cx)^2+(cen.cy-ch.cy)^2),3) as err_hand_m, round(abs(th),3) as heading_err_deg, round(d,3) as max_vertex_err_m
  from cen join cs using (i) join ch using (i) join hd using (i) join lattice_fx using (i)""")
def _errors(fx):
    t = _two(fx)
    refs = plots(fx).select(*KEY, F.col("ring").alias("ring_fmb"), F.lit(0.0).alias("ref_theta")).join(t.select(*KEY, F.col("hand").alias("ring_hand")), KEY)
    return sp.placement_errors(t.select(*KEY, "ring", F.col("theta").alias("heading")), refs, KEY)


@query("corner_gcps", f"""
  with {EDGE}, {_FEATS}, t as (select e.i, e.village, e.survey, e.poly_id, e.seq, e.x, e.y, abs(((((degrees(atan2(e.ny-e.y,e.nx-e.x)-atan2(e.y-b.y,e.x-b.x))+180)%360)+360)%360)-180) as turn from edge e join edge b on b.i=e.i and b.ring_no=0 and b.seq=(e.seq+3)%4 where e.ring_no=0),
  c as (select *, row_number() over (partition by i order by seq) as corner_id from t where turn>=20),
  pts as (select c.i, c.village, c.survey, c.poly_id, corner_id, cos(radians(theta))*x-sin(radians(theta))*y+tx as x, sin(radians(theta))*x+cos(radians(theta))*y+ty as y from c join near_poses_fx p on p.village=c.village and p.survey=c.survey),
  {_near('pts', 'p.i, p.corner_id')}
  select pts.village, survey, poly_id, pts.corner_id, round(x,4)+0.0 as map_x, round(y,4)+0.0 as map_y, case when sqrt(m.d)<=1.5 then 1 else 0 end as matched, round(sqrt(m.d),5) as residual_m from pts left join near n on n.i=pts.i and n.corner_id=pts.corner_id""")
def _gcps(fx):
    g = sp.corner_gcps(plots(fx), fx.near_poses_fx.select("village", "survey", "theta", "tx", "ty"), fx.features_fx, KEY)
    return g.select(*KEY, "corner_id", r(F.col("x"), 4).alias("map_x"), r(F.col("y"), 4).alias("map_y"), "matched", r(F.col("dist"), 5).alias("residual_m"))


_SURV_GAP = """ pp as (select distinct village, survey, other from (select village, survey, number as other from printed_fx union all select a.village, a.survey, b.survey from near_poses_fx a join near_poses_fx b on b.village=a.village and cast(b.survey as int)=cast(a.survey as int)+9) q),
  bo as materialized (select v.i, v.village, v.survey, v.seq, cos(radians(theta))*x-sin(radians(theta))*y+tx as x, sin(radians(theta))*x+cos(radians(theta))*y+ty as y from ring_vertices_fx v join near_poses_fx p on p.village=v.village and p.survey=v.survey where ring_no=0),
  bo_e as materialized (select a.*, b.x as nx, b.y as ny from bo a join bo b on b.i=a.i and b.seq=(a.seq+1)%4),
  w as (select village, survey, other, survey as s, other as o from pp union all select village, survey, other, other, survey from pp),
  g as (select w.village, w.survey, w.other, min(sqrt((v.x-(e.x+greatest(0,least(1,((v.x-e.x)*(e.nx-e.x)+(v.y-e.y)*(e.ny-e.y))/((e.nx-e.x)^2+(e.ny-e.y)^2)))*(e.nx-e.x)))^2+(v.y-(e.y+greatest(0,least(1,((v.x-e.x)*(e.nx-e.x)+(v.y-e.y)*(e.ny-e.y))/((e.nx-e.x)^2+(e.ny-e.y)^2)))*(e.ny-e.y)))^2)) as gap
     from w join bo v on v.village=w.village and v.survey=w.s join bo_e e on e.village=w.village and e.survey=w.o group by 1,2,3)"""


@query("printed_contradictions", f"with {_SURV_GAP} select village, survey, count(*) as n_far, string_agg(other, ',' order by cast(other as int)) as printed_far from g where gap>10 group by 1,2")
def _far(fx):
    p = fx.near_poses_fx.select("village", "survey")
    nine = p.withColumn("other", (F.col("survey").cast("int") + 9).cast("string")).join(p.withColumnRenamed("survey", "other"), ["village", "other"], "left_semi")
    pairs = fx.printed_fx.select("village", "survey", F.col("number").alias("other")).unionByName(nine).distinct()
    bodies = ms.place(plots(fx), fx.near_poses_fx, ["village", "survey"]).select("village", "survey", F.col("ground")[0].alias("ring"))
    return nb.printed_contradictions(pairs, bodies)


@query("strip_parcels", f"""
  with {EDGE}, l as (select village, concat(village,'-',cast(k as varchar)) as line_id, 0.0::double as ax, min(y1)+k*21.5::double+3 as ay, 1990.0::double as bx, min(y1)+k*23.5::double+7 as b_y from lattice_fx, range(1,9) g(k) group by village, k),
  c as (select l.village, line_id, e.i, ((e.x-ax)*(e.ny-e.y)-(e.y-ay)*(e.nx-e.x))/((bx-ax)*(e.ny-e.y)-(b_y-ay)*(e.nx-e.x)) as t, ((e.x-ax)*(b_y-ay)-(e.y-ay)*(bx-ax))/((bx-ax)*(e.ny-e.y)-(b_y-ay)*(e.nx-e.x)) as u from l join edge e on e.village=l.village and ring_no=0),
  h as (select village, line_id, i, t from c where t>1e-9 and t<1-1e-9 and u>1e-9 and u<1-1e-9 union all select distinct village, line_id, i, unnest([0.0::double,1.0::double]) from c),
  s as (select *, lead(t) over (partition by line_id, i order by t) as t2 from h),
  m as (select s.village, s.i, s.line_id, s.t2-s.t as dt, ax+(bx-ax)*(t+t2)/2 as mx, ay+(b_y-ay)*(t+t2)/2 as my, sqrt((bx-ax)^2+(b_y-ay)^2) as len from s join l on l.line_id=s.line_id where t2>t),
  k as (select m.village, m.i, m.line_id, dt, len, count(*)%2 as inside from m join edge e on e.i=m.i and ring_no=0 and (e.y>my)<>(e.ny>my) and e.x+(my-e.y)*(e.nx-e.x)/(e.ny-e.y)>mx group by all)
  select village, i, round(sum(dt*len),5) as line_m from k where inside=1 group by 1,2 having sum(dt*len)>=50""")
def _strips(fx):
    k = F.explode(F.sequence(F.lit(1), F.lit(8)))
    base = fx.lattice_fx.groupBy("village").agg(F.min("y1").alias("y")).withColumn("k", k)
    lines = base.select("village", F.concat_ws("-", "village", F.col("k").cast("string")).alias("line_id"), F.lit(0.0).alias("ax"), (F.col("y") + F.col("k") * 21.5 + 3).alias("ay"),
                        F.lit(1990.0).alias("bx"), (F.col("y") + F.col("k") * 23.5 + 7).alias("b_y"))
    return sp.strip_parcels(plots(fx), lines, ["village"], ["i"]).select("village", "i", r(F.col("line_m"), 5).alias("line_m"))
