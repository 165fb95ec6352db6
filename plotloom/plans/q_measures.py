"""Geometry expression queries."""

from pyspark.sql import functions as F

from plotloom.functions import geo
from plotloom.operators import measures as ms
from plotloom.plans.catalog import query
from plotloom.plans.shapes import plots, r

KEY = ["village", "survey", "poly_id"]
_NXT = """nx as (select *, coalesce(lead(x) over w, first_value(x) over w) as nx, coalesce(lead(y) over w, first_value(y) over w) as ny,
  coalesce(lag(x) over w, last_value(x) over (partition by i, ring_no order by seq rows between unbounded preceding and unbounded following)) as px,
  coalesce(lag(y) over w, last_value(y) over (partition by i, ring_no order by seq rows between unbounded preceding and unbounded following)) as py
  from ring_vertices_fx window w as (partition by i, ring_no order by seq rows between unbounded preceding and unbounded following))"""
_NXT = _NXT.replace("coalesce(lead(x) over w, first_value(x) over w)", "coalesce(lead(x) over (partition by i, ring_no order by seq), first_value(x) over w)"
  ).replace("coalesce(lead(y) over w, first_value(y) over w)", "coalesce(lead(y) over (partition by i, ring_no order by seq), first_value(y) over w)"
  ).replace("lag(x) over w", "lag(x) over (partition by i, ring_no order by seq)").replace("lag(y) over w", "lag(y) over (partition by i, ring_no order by seq)")


@query("segment_length", "select edge_id, round(sqrt((bx-ax)^2+(b_y-ay)^2),4) as length_m from lattice_edges_fx")
def _length(fx):
    return fx.lattice_edges_fx.select("edge_id", r(geo.length(F.col("ax"), F.col("ay"), F.col("bx"), F.col("b_y")), 4).alias("length_m"))


@query("line_bearing", """
  with m as (select edge_id, (((degrees(atan2(b_y-ay, bx-ax)))%180)+180)%180 as m, ((degrees(atan2(bx-ax, b_y-ay))%360)+360)%360 as g from lattice_edges_fx)
  select edge_id, round(m,6)+0.0 as math_deg, round((((90-m)%180)+180)%180,6)+0.0 as compass_deg, round(g,6)+0.0 as grid_deg from m""")
def _bearing(fx):
    dx, dy = F.col("bx") - F.col("ax"), F.col("b_y") - F.col("ay")
    m = geo.bearing_math(dx, dy)
    return fx.lattice_edges_fx.select("edge_id", r(m).alias("math_deg"), r(geo.bearing_compass(m)).alias("compass_deg"), r(geo.bearing_grid(dx, dy)).alias("grid_deg"))


@query("angle_difference", """
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, abs((((theta-support*9+180)%360)+360)%360-180) as directed,
    least((((theta-support*9)%180)+180)%180, 180-(((theta-support*9)%180)+180)%180) as undirected from candidates_fx""")
def _gap(fx):
    a, b = F.col("theta"), F.col("support") * 9
    return fx.candidates_fx.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", geo.turn_gap(a, b).alias("directed"), geo.line_gap(a, b).alias("undirected"))


@query("turn_angles", f"""
  with {_NXT}, t as (select *, ((((degrees(atan2(ny-y,nx-x)-atan2(y-py,x-px))+180)%360)+360)%360)-180 as s from nx)
  select village, survey, poly_id, ring_no, seq, round(s,6)+0.0 as signed_deg, round(abs(s),6) as turn_deg from t""")
def _turns(fx):
    return ms.turn_angles(plots(fx, True), KEY).select(*KEY, "ring_no", "seq", r(F.col("signed_deg")).alias("signed_deg"), r(F.col("turn_deg")).alias("turn_deg"))


@query("point_segment_projection", """
  with j as (select label_id, x, y, x1, y1, x2, y2, ((x-x1)*(x2-x1)+(y-y1)*(y2-y1))/((x2-x1)^2+(y2-y1)^2) as t from label_points_fx join lattice_fx on i=label_id%1000000)
  select label_id, round(t,6)+0.0 as t, round(sqrt((x-(x1+t*(x2-x1)))^2+(y-(y1+t*(y2-y1)))^2),6) as dist,
    round(sqrt((x-(x1+greatest(0,least(1,t))*(x2-x1)))^2+(y-(y1+greatest(0,least(1,t))*(y2-y1)))^2),6) as clamped from j""")
def _project(fx):
    j = fx.label_points_fx.join(fx.lattice_fx.drop("village"), F.col("i") == F.col("label_id") % 1000000)
    args = [F.col(n) for n in ("x", "y", "x1", "y1", "x2", "y2")]
    t = geo.param_on_segment(*args)
    return j.select("label_id", r(t).alias("t"), r(geo.distance_at(*args, t)).alias("dist"), r(geo.point_segment_distance(*args)).alias("clamped"))


@query("segment_intersection", """
  with d as (select i, x1 as ax, y1 as ay, x3-x1 as ux, y3-y1 as uy, x2 as cx, y2 as cy, x4-x2 as vx, y4-y2 as vy, 'diagonals' as what from lattice_fx
    union all select i, x1, y1, x2-x1, y2-y1, x1, y1, x4-x1, y4-y1, 'sides' from lattice_fx
    union all select i, x1, y1, x2-x1, y2-y1, x4, y4+1000, x3-x4, y3-y4, 'apart' from lattice_fx),
  p as (select *, ux*vy-uy*vx as den, ((cx-ax)*vy-(cy-ay)*vx)/nullif(ux*vy-uy*vx,0) as t, ((cx-ax)*uy-(cy-ay)*ux)/nullif(ux*vy-uy*vx,0) as u from d),
  q as (select *, abs(den)>=1e-12 and t>1e-9 and t<1-1e-9 and u>1e-9 and u<1-1e-9 as hit from p)
  select i, what, case when hit then round(ax+t*ux,6) end as x, case when hit then round(ay+t*uy,6) end as y from q""")
def _crossing(fx):
    def c(*names):
        return [F.col(n) if isinstance(n, str) else n for n in names]
    base = c("x1", "y1", "x2", "y2")
    pairs = {"diagonals": (c("x1", "y1", "x3", "y3"), c("x2", "y2", "x4", "y4")), "sides": (base, c("x1", "y1", "x4", "y4")),
             "apart": (base, c("x4", F.col("y4") + 1000, "x3", F.col("y3") + 1000))}
    hits = F.array(*[F.struct(F.lit(k).alias("what"), geo.crossing(p, q).alias("h")) for k, (p, q) in pairs.items()])
    return fx.lattice_fx.select("i", F.explode(hits).alias("e")).select("i", "e.what", r(F.col("e.h.x")).alias("x"), r(F.col("e.h.y")).alias("y"))


@query("ring_area", f"""
  with {_NXT}, a as (select village, survey, poly_id, ring_no, sum(x*ny-nx*y)/2 as a from nx group by 1,2,3,4)
  select village, survey, poly_id, max(case when ring_no=0 then round(a,6) end) as outer_area, round(sum(case when ring_no=0 then abs(a) else -abs(a) end),6) as net_area from a group by 1,2,3""")
def _area(fx):
    return plots(fx, True).select(*KEY, r(geo.ring_area(F.col("rings")[0])).alias("outer_area"), r(geo.net_area(F.col("rings"))).alias("net_area"))


_RM = f"""with {_NXT}, a as (select village, survey, poly_id, ring_no, abs(sum(x*ny-nx*y)/2) as a, sum(sqrt((nx-x)^2+(ny-y)^2)) as per, count(*) as n from nx group by 1,2,3,4),
  m as (select village, survey, poly_id, sum(case when ring_no=0 then a else -a end) as area_sqm, sum(per) filter (where ring_no=0) as perimeter_m,
    (max(n) filter (where ring_no=0)) as n_vertices, count(*)-1 as n_holes from a group by 1,2,3)"""


@query("ring_measures", _RM + "select village, survey, poly_id, round(area_sqm,6) as area_sqm, round(perimeter_m,6) as perimeter_m, n_vertices, n_holes, round(area_sqm/100,6) as area_are, round(area_sqm/10000,6) as area_hect from m")
def _measures(fx):
    m = ms.ring_measures(plots(fx, True), KEY)
    u = geo.land_units(F.col("area_sqm"))
    return m.select(*KEY, r(F.col("area_sqm")).alias("area_sqm"), r(F.col("perimeter_m")).alias("perimeter_m"), "n_vertices", "n_holes",
                    r(u["area_are"]).alias("area_are"), r(u["area_hect"]).alias("area_hect"))


@query("land_units", _RM + "select village, survey, poly_id, round(area_sqm/100,4) as area_are, round(area_sqm/10000,6) as area_hect, round(area_sqm*0.000247105381::double,5) as area_acre, round(area_sqm*0.000247105381::double*100,3) as area_cent from m")
def _land(fx):
    m = ms.ring_measures(plots(fx, True), KEY)
    u = geo.land_units(F.col("area_sqm"))
    return m.select(*KEY, *[r(u[k], n).alias(k) for k, n in (("area_are", 4), ("area_hect", 6), ("area_acre", 5), ("area_cent", 3))])


@query("polygon_centroid", f"""
  with {_NXT} select village, survey, poly_id, round(sum((x+nx)*(x*ny-nx*y))/(3*sum(x*ny-nx*y)),6) as cx, round(sum((y+ny)*(x*ny-nx*y))/(3*sum(x*ny-nx*y)),6) as cy,
    round(avg(x),6) as mx, round(avg(y),6) as my from nx where ring_no=0 group by 1,2,3""")
def _centroid(fx):
    c, m = geo.ring_centroid(F.col("ring")), geo.vertex_mean(F.col("ring"))
    return plots(fx).select(*KEY, r(c["x"]).alias("cx"), r(c["y"]).alias("cy"), r(m["x"]).alias("mx"), r(m["y"]).alias("my"))


_PLACED = """(select v.village, v.survey, poly_id, ring_no, seq, cos(radians(theta))*x-sin(radians(theta))*y+tx as gx, sin(radians(theta))*x+cos(radians(theta))*y+ty as gy
  from ring_vertices_fx v join poses_fx p on p.village=v.village and p.survey=v.survey)"""


@query("rigid_transform", f"select village, survey, poly_id, ring_no, seq, round(gx,3) as x, round(gy,3) as y from {_PLACED} g")
def _move(fx):
    placed = ms.place(plots(fx, True), fx.poses_fx, ["village", "survey"]).withColumn("rings", F.col("ground"))
    return ms.ring_vertices(placed, KEY).select(*KEY, "ring_no", "seq", r(F.col("x"), 3).alias("x"), r(F.col("y"), 3).alias("y"))


@query("rigid_inverse", """
  with p as (select *, cast(392000+8*cast(survey as int) as double) as tx, cast(1413000+4*cast(survey as int) as double) as ty from control_points_fx)
  select survey, l_orderkey, l_linenumber, l_partkey, round(cos(radians(true_theta))*(mx-tx)+sin(radians(true_theta))*(my-ty),5)+0.0 as x,
    round(cos(radians(true_theta))*(my-ty)-sin(radians(true_theta))*(mx-tx),5)+0.0 as y from p""")
def _back(fx):
    k = F.col("survey").cast("int")
    x, y = geo.rigid_back(F.col("mx"), F.col("my"), F.col("true_theta"), (k * 8 + 392000).cast("double"), (k * 4 + 1413000).cast("double"))
    return fx.control_points_fx.select("survey", "l_orderkey", "l_linenumber", "l_partkey", r(x, 5).alias("x"), r(y, 5).alias("y"))


@query("placed_bodies", f"""
  with h as (select village, survey, poly_id, ring_no, seq, x+1000 as x, y+2000 as y from ring_vertices_fx where cast(survey as int)%10=0 and poly_id<4 and ring_no=0)
  select village, survey, poly_id, ring_no, seq, x, y from h
  union all select g.village, g.survey, g.poly_id, g.ring_no, g.seq, round(gx,3), round(gy,3) from {_PLACED} g where ring_no=0 and not exists
    (select 1 from h where h.village=g.village and h.survey=g.survey and h.poly_id=g.poly_id)""")
def _bodies(fx):
    p = plots(fx)
    hand = p.filter("cast(survey as int) % 10 = 0 and poly_id < 4").withColumn(
        "rings", F.transform("rings", lambda ring: F.transform(ring, lambda q: geo.pt(q["x"] + 1000, q["y"] + 2000))))
    b = ms.placed_bodies(p, fx.poses_fx, hand, ["village", "survey"]).withColumn("rings", F.col("ground"))
    return ms.ring_vertices(b, KEY).select(*KEY, "ring_no", "seq", r(F.col("x"), 3).alias("x"), r(F.col("y"), 3).alias("y"))


@query("rigidity_assertion", "select count(*)-count(*) as violations, count(*) as plots from lattice_fx")
def _rigid(fx):
    placed = ms.place(plots(fx), fx.poses_fx, ["village", "survey"])
    bad = ms.rigidity_violations(placed, KEY).withColumn("bad", F.lit(1))
    return placed.select(*KEY).join(bad, KEY, "left").agg(F.count("bad").alias("violations"), F.count("*").alias("plots"))


@query("page_to_ground", """
  select sheet_id, seg_id, round(x0*(25.4::double/72.0::double*500/1000),4) as x0, round((page_h-y0)*(25.4::double/72.0::double*500/1000),4) as y0 from segments_raw_fx""")
def _page(fx):
    m = geo.metres_per_point(F.lit(500))
    return fx.segments_raw_fx.select("sheet_id", "seg_id", r(F.col("x0") * m, 4).alias("x0"), r((F.col("page_h") - F.col("y0")) * m, 4).alias("y0"))


_OPS = """path as (select i, k, op, px, py, qx, qy,
   max(case when op<>'h' then k end) over (partition by i order by k rows between unbounded preceding and 1 preceding) as kc from path_ops_fx)"""


@query("flatten_curves", f"""
  with {_OPS}, c as (select p.*, case when q.op='v' then q.qx else q.px end as cx, case when q.op='v' then q.qy else q.py end as cy from path p left join path q on q.i=p.i and q.k=p.kc),
  e as (select i, k, 0 as j, px as x, py as y from c where op in ('m','l') union all select i, k, 0, px, py from c where op='h'
    union all select i, k, j, (1-j/8.0::double)^3*cx+3*(1-j/8.0::double)^2*(j/8.0::double)*cx+3*(1-j/8.0::double)*(j/8.0::double)^2*px+(j/8.0::double)^3*qx,
      (1-j/8.0::double)^3*cy+3*(1-j/8.0::double)^2*(j/8.0::double)*cy+3*(1-j/8.0::double)*(j/8.0::double)^2*py+(j/8.0::double)^3*qy from c, range(1,9) s(j) where op='v')
  select i, row_number() over (partition by i order by k, j)-1 as pos, round(x,6)+0.0 as x, round(y,6)+0.0 as y from e""")
def _flatten(fx):
    ops = fx.path_ops_fx.groupBy("i").agg(F.array_sort(F.collect_list(F.struct(
        "k", "op", F.col("px").alias("x1"), F.col("py").alias("y1"), F.col("qx").alias("x2"), F.col("qy").alias("y2")))).alias("ops"))
    return ops.select("i", F.posexplode(geo.flatten_path(F.col("ops"))).alias("pos", "p")).select("i", "pos", r(F.col("p.x")).alias("x"), r(F.col("p.y")).alias("y"))


@query("outline_samples", f"""
  with {_NXT}, e as (select *, greatest(1, round_even(sqrt((nx-x)^2+(ny-y)^2)/1.0,0)) as n from nx where ring_no=0)
  select village, survey, poly_id, seq as edge_no, k, round(x+(nx-x)*(k+0.5::double)/n+1.3e-6,4)+0.0 as x, round(y+(ny-y)*(k+0.5::double)/n+1.3e-6,4)+0.0 as y, round(atan2(ny-y,nx-x),6)+0.0 as bearing
  from e, range(0,60) g(k) where k<n""")
def _samples(fx):
    s = ms.outline_samples(plots(fx), KEY, 1.0)
    return s.select(*KEY, "edge_no", "k", r(F.col("x") + 1.3e-6, 4).alias("x"), r(F.col("y") + 1.3e-6, 4).alias("y"), r(F.col("bearing")).alias("bearing"))


@query("segment_samples", """
  with e as (select *, greatest(2, floor(sqrt((bx-ax)^2+(b_y-ay)^2)/0.5)) as n from features_fx)
  select edge_id, k, round(ax+(bx-ax)*k/n,6)+0.0 as x, round(ay+(b_y-ay)*k/n,6)+0.0 as y, round(((atan2(b_y-ay,bx-ax)%pi())+pi())%pi(),6) as bearing from e, range(0,120) g(k) where k<=n""")
def _segsamples(fx):
    s = ms.segment_samples(fx.features_fx, ["edge_id"])
    return s.select("edge_id", "k", r(F.col("x")).alias("x"), r(F.col("y")).alias("y"), r(F.col("bearing")).alias("bearing"))


_CONV = """degrees(atan((tau+sg*tan(xp)*tanh(ep))/(sg-tau*tan(xp)*tanh(ep))))"""
_B = "(select f/(2-f) as n from (select 1/298.257223563::double as f) q)"


def _series(src: str) -> str:
    return f"""k0 as (select n, 6378137.0::double/(1+n)*(1+n^2/4+n^4/64) as big, n/2-2*n^2/3+37*n^3/96 as b1, n^2/48+n^3/15 as b2, 17*n^3/480 as b3 from {_B} z),
  xe as (select s.*, yy/(0.9996::double*big) as xi, (xx-500000)/(0.9996::double*big) as eta, b1, b2, b3 from {src} s, k0),
  cv as (select *, xi-b1*sin(2*xi)*cosh(2*eta)-b2*sin(4*xi)*cosh(4*eta)-b3*sin(6*xi)*cosh(6*eta) as xp, eta-b1*cos(2*xi)*sinh(2*eta)-b2*cos(4*xi)*sinh(4*eta)-b3*cos(6*xi)*sinh(6*eta) as ep,
     1-2*b1*cos(2*xi)*cosh(2*eta)-4*b2*cos(4*xi)*cosh(4*eta)-6*b3*cos(6*xi)*cosh(6*eta) as sg, 2*b1*sin(2*xi)*sinh(2*eta)+4*b2*sin(4*xi)*sinh(4*eta)+6*b3*sin(6*xi)*sinh(6*eta) as tau from xe)"""


@query("grid_convergence", f"with src as (select survey, l_orderkey, l_linenumber, l_partkey, mx as xx, my as yy from control_points_fx), {_series('src')} select survey, l_orderkey, l_linenumber, l_partkey, round({_CONV},6) as conv_deg from cv")
def _converge(fx):
    return fx.control_points_fx.select("survey", "l_orderkey", "l_linenumber", "l_partkey", r(geo.grid_convergence(F.col("mx"), F.col("my"))).alias("conv_deg"))


@query("edge_table", f"""
  with cw as (select i, village, survey, poly_id, case seq when 0 then 0 else 4-seq end as s, x+392000 as x, y+1413000 as y from ring_vertices_fx where ring_no=0),
  st as (select i, arg_min(s, struct_pack(a:=-y, b:=s)) as s0 from cw group by i),
  e as (select a.village, a.survey, a.poly_id, (a.s-s0+4)%4+1 as edge_no, a.x as x0, a.y as y0, b.x as x1, b.y as y1 from cw a join st on st.i=a.i join cw b on b.i=a.i and b.s=(a.s+1)%4),
  src as (select *, (x0+x1)/2 as xx, (y0+y1)/2 as yy, ((degrees(atan2(x1-x0,y1-y0))%360)+360)%360 as gb from e), {_series('src')}
  select village, survey, poly_id, edge_no, round(sqrt((x1-x0)^2+(y1-y0)^2),3) as length_m, round(gb,2) as bearing_grid_deg, round((gb+{_CONV}+360)%360,2) as bearing_true_deg, round({_CONV},3) as grid_convergence_deg from cv""")
def _edges(fx):
    moved = plots(fx).withColumn("ring", F.transform("ring", lambda p: geo.pt(p["x"] + 392000, p["y"] + 1413000)))
    e = ms.edge_table(moved, KEY)
    return e.select(*KEY, "edge_no", r(F.col("length_m"), 3).alias("length_m"), r(F.col("bearing_grid_deg"), 2).alias("bearing_grid_deg"),
                    r(F.col("bearing_true_deg"), 2).alias("bearing_true_deg"), r(F.col("grid_convergence_deg"), 3).alias("grid_convergence_deg"))


@query("fingerprint_geometry", """
  with r as (select village, survey, poly_id, ring_no, string_agg(concat(cast(floor(x*1000+0.5::double) as bigint), ',', cast(floor(y*1000+0.5::double) as bigint)), ';' order by seq) as t from ring_vertices_fx group by 1,2,3,4),
  h as (select village, survey, poly_id, sha256(string_agg(t, '|' order by ring_no)) as h from r group by 1,2,3)
  select village, survey, sha256(concat(cast(sum(cast('0x'||substr(h,1,15) as bigint)) as varchar), ':', cast(sum(cast('0x'||substr(h,16,15) as bigint)) as varchar), ':', cast(count(*) as varchar))) as fingerprint from h group by 1,2""")
def _fingerprint(fx):
    return ms.fingerprint_geometry(plots(fx, True), ["village", "survey"])


@query("min_rotated_rectangle", """
  with v as (select i, village, survey, poly_id, seq, x, y from ring_vertices_fx where ring_no=0),
  d as (select a.i, a.seq as s1, b.seq as s2, (b.x-a.x)/sqrt((b.x-a.x)^2+(b.y-a.y)^2) as ux, (b.y-a.y)/sqrt((b.x-a.x)^2+(b.y-a.y)^2) as uy from v a join v b on b.i=a.i and b.seq>a.seq),
  e as (select d.i, s1, s2, max(x*ux+y*uy)-min(x*ux+y*uy) as w, max(y*ux-x*uy)-min(y*ux-x*uy) as h from d join v on v.i=d.i group by 1,2,3),
  m as (select i, arg_min(greatest(w,h), w*h) as long_m, arg_min(least(w,h), w*h) as short_m from e group by i)
  select village, survey, poly_id, round(long_m,5) as long_m, round(short_m,5) as short_m from m join lattice_fx using (i)""")
def _rectangle(fx):
    return ms.min_rotated_rectangle(plots(fx), KEY).select(*KEY, r(F.col("long_m"), 5).alias("long_m"), r(F.col("short_m"), 5).alias("short_m"))


@query("glyph_bitmap", f"""
  with {_NXT}, b as (select i, min(x) as x0, min(y) as y0, max(x)-min(x) as w, max(y)-min(y) as h from ring_vertices_fx group by i),
  rows_y as (select i, x0, y0, w, h, r, y0+h*(20-0.5::double-r)/20 as yy from b, range(0,20) g(r)),
  xs as (select a.i, r, n.x+(yy-n.y)*(n.nx-n.x)/(n.ny-n.y) as xx from rows_y a join nx n on n.i=a.i and (n.y>yy)<>(n.ny>yy)),
  bits as (select a.i, a.r, c, count(xs.xx)%2 as bit from rows_y a cross join range(0,14) g(c) left join xs on xs.i=a.i and xs.r=a.r and xs.xx < a.x0+a.w*(c+0.5::double)/14 group by 1,2,3)
  select bits.i, string_agg(cast(bit as varchar), '' order by r, c) as bits, round(max(w/h),6) as aspect from bits join b using (i) group by 1""")
def _glyph(fx):
    return ms.glyph_bitmap(plots(fx, True), ["i"]).select("i", F.array_join("bits", "").alias("bits"), r(F.col("ar")).alias("aspect"))
