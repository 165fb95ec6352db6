"""Candidate ranking queries."""

from pyspark.sql import functions as F

from plotloom.operators import ranking as rk
from plotloom.plans.catalog import query

TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_T = ", ".join(TIE)
_ORDER = f"contradictions, support desc, sides_ok desc, partners desc, {_T}"
_RANKED = f"(select *, row_number() over (partition by survey order by {_ORDER}) as rank from candidates_fx)"


@query("rank_poses", f"select survey, {_T}, rank from {_RANKED} r")
def _rank(fx):
    return rk.rank_poses(fx.candidates_fx, ["survey"], TIE).select("survey", *TIE, "rank")


@query("runner_up_support", f"""
  with r as materialized {_RANKED}, b as materialized (select * from r where rank=1),
  n as (select r.survey, arg_min(r.support, r.rank) as nxt from r join b on b.survey=r.survey where sqrt((r.land_x-b.land_x)^2+(r.land_y-b.land_y)^2)>=5
     or abs(((((r.theta-b.theta+180)%360)+360)%360)-180)>=3 group by 1)
  select b.survey, b.support as support_m, coalesce(nxt, 0.0::double) as support_next_m from b left join n on n.survey=b.survey""")
def _runner(fx):
    return rk.runner_up_support(fx.candidates_fx, ["survey"], TIE)


@query("topn_per_group", f"select survey, {_T}, rank from {_RANKED} r where rank<=3")
def _top(fx):
    return rk.top_n(fx.candidates_fx, ["survey"], rk.pose_order(TIE), 3).select("survey", *TIE, "rank")


@query("choose_pose", f"""
  with img as (select survey, max(theta) as theta, max(land_x) as land_x, max(land_y) as land_y, max(support)-1 as support, 0 as contradictions, 0 as sides_ok, max(partners) as partners,
       0 as l_orderkey, 0 as l_linenumber, 0 as l_partkey, 0 as l_suppkey from candidates_fx where cast(survey as int)%3=0 group by survey),
  u as (select survey, theta, land_x, land_y, support, contradictions, sides_ok, partners, {_T}, 0 as from_image from candidates_fx
     union all select *, 1 from img),
  r as (select u.*, row_number() over (partition by u.survey order by case when cast(u.survey as int)%3=0 then 0 else contradictions end, support desc,
      case when cast(u.survey as int)%3=0 then 0 else -sides_ok end, partners desc, from_image, {_T}) as k from u),
  n as (select survey, support as nxt from r where k=2)
  select r.survey, theta, land_x, land_y, support, from_image, case when nxt>0 then printf('neighbour support %.0f m, next best %.0f m', support, nxt)
    else printf('neighbour support %.0f m', support) end as note from r left join n on n.survey=r.survey where k=1""")
def _choose(fx):
    c = fx.candidates_fx
    zero = F.lit(0)
    img = (c.filter(F.col("survey").cast("int") % 3 == 0).groupBy("survey").agg(
        F.max("theta").alias("theta"), F.max("land_x").alias("land_x"), F.max("land_y").alias("land_y"), (F.max("support") - 1).alias("support"),
        F.max("partners").alias("partners")).withColumns({"contradictions": zero, "sides_ok": zero, **{t: zero for t in TIE}}))
    return rk.choose_pose(c, img, ["survey"], TIE)


@query("competitor_margin", """
  with s as (select survey, theta%24 as theta, land_x/8 as tx, land_y/4 as ty, support/64 as share, l_orderkey, l_linenumber, l_partkey, l_suppkey from candidates_fx),
  r as materialized (select *, row_number() over (partition by survey order by share desc, l_orderkey, l_linenumber, l_partkey, l_suppkey) as k from s), b as materialized (select * from r where k=1),
  j as materialized (select r.*, b.theta as bt, b.tx as bx, b.ty as b_y, b.share as bs, sqrt((r.tx-b.tx)^2+(r.ty-b.ty)^2) as off, abs(((((r.theta-b.theta+180)%360)+360)%360)-180) as turn from r join b on b.survey=r.survey),
  o as (select survey, arg_min(struct_pack(s:=share, dx:=tx-bx, dy:=ty-b_y), k) as alt from j where off>3 or turn>3 group by survey),
  p as (select survey, count(*) filter (where share>=bs*0.75 and off>3) as peaks from j group by survey)
  select b.survey, b.theta, b.tx, b.ty, b.share, b.share-coalesce(alt.s,0) as margin, peaks, case when b.share-coalesce(alt.s,0)<0.15 or peaks>0 then 1 else 0 end as ambiguous,
   round(sqrt(alt.dx^2+alt.dy^2),6) as alt_m, round((degrees(atan2(alt.dx, alt.dy))+360)%360, 6) as alt_bearing
  from b join p on p.survey=b.survey left join o on o.survey=b.survey""")
def _margin(fx):
    s = fx.candidates_fx.select("survey", (F.col("theta") % 24).alias("theta"), (F.col("land_x") / 8).alias("tx"), (F.col("land_y") / 4).alias("ty"),
                                (F.col("support") / 64).alias("share"), *TIE)
    out = rk.competitor_margin(s, ["survey"], TIE)
    return out.withColumns({"alt_m": F.round("alt_m", 6), "alt_bearing": F.round("alt_bearing", 6)})
