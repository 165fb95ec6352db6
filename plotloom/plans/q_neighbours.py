"""Printed-neighbour queries."""

from pyspark.sql import functions as F

from plotloom.functions import text as tx
from plotloom.operators import neighbours as nb
from plotloom.plans.catalog import query

NORM = """(select *, case when up not like '%V.NO%' and regexp_full_match(bare,'[0-9]+[A-Z]?') then bare end as other from
  (select *, split_part(replace(regexp_replace(upper(trim(number)),'^S\\.?\\s*NO\\.?\\s*',''),' ',''),'/',1) as bare, upper(trim(number)) as up from neighbours_fx) q)"""
TRUST = f"(select distinct village, survey, other from {NORM} n where other is not null and other<>survey and (readers>=2 or confidence='high'))"
SIDE = f"""(select village, survey, other, case when upper(s) in ('N','NE','E','SE','S','SW','W','NW') then upper(s) end as side from
  (select village, survey, other, arg_min(side, struct_pack(a:=l_orderkey, b:=l_linenumber, c:=l_partkey)) as s from {NORM} n where other is not null group by 1,2,3) q)"""
POS = ["l_orderkey", "l_linenumber", "l_partkey"]


@query("trusted_neighbours", f"select * from {TRUST} t")
def _trusted(fx):
    return nb.trusted_neighbours(fx.neighbours_fx)


@query("printed_side", f"select * from {SIDE} s")
def _side(fx):
    return nb.printed_side(fx.neighbours_fx, POS)


@query("mutual_adjacency", f"""
  with t as {TRUST}, p as (select distinct cast(l_suppkey%10 as varchar) as village, cast(l_suppkey as varchar) as a, cast(l_partkey%150 as varchar) as b from lineitem),
  rd as (select distinct village, survey from neighbours_fx where cast(survey as int)%4<>0),
  tt as (select t.* from t join rd on rd.village=t.village and rd.survey=t.survey)
  select p.village, a, b, case when not exists (select 1 from rd where rd.village=p.village and rd.survey in (a,b)) then null
    else exists (select 1 from tt where tt.village=p.village and ((tt.survey=a and tt.other=b) or (tt.survey=b and tt.other=a))) end as adjacent from p""")
def _adjacent(fx):
    pairs = fx.lineitem.select((F.col("l_suppkey") % 10).cast("string").alias("village"), F.col("l_suppkey").cast("string").alias("a"),
                               (F.col("l_partkey") % 150).cast("string").alias("b")).distinct()
    return nb.mutual_adjacency(pairs, fx.neighbours_fx.filter(F.col("survey").cast("int") % 4 != 0))


@query("compass_side_vector", """
  select distinct side, case upper(side) when 'NE' then 0.7071::double when 'E' then 1.0::double when 'SE' then 0.7071::double when 'SW' then -0.7071::double when 'W' then -1.0::double when 'NW' then -0.7071::double else 0.0::double end as vx,
    case upper(side) when 'N' then 1.0::double when 'NE' then 0.7071::double when 'SE' then -0.7071::double when 'S' then -1.0::double when 'SW' then -0.7071::double when 'NW' then 0.7071::double else 0.0::double end as vy,
    l_partkey%360 as deg, (array['N','NE','E','SE','S','SW','W','NW'])[cast(floor(((l_partkey%360+22.5)%360)/45) as int)+1] as letter from neighbours_fx""")
def _vector(fx):
    v = nb.side_vector(F.col("side"))
    deg = F.col("l_partkey") % 360
    return fx.neighbours_fx.select("side", v["x"].alias("vx"), v["y"].alias("vy"), deg.alias("deg"), nb.bearing_letter(deg.cast("double")).alias("letter")).distinct()


@query("two_reader_consensus", """
  with s as (select sheet, number, upper(side) as sd, count(*) as c from readings_fx where side<>'' group by 1,2,3), m as (select sheet, number, arg_max(sd, struct_pack(c:=c, s:=sd)) as side from s group by 1,2),
  r as (select sheet, number, count(distinct reader) as readers, max(case when confidence='high' then 1 else 0 end) as hi from readings_fx group by 1,2)
  select r.sheet, r.number, coalesce(m.side,'') as side, readers, case when readers>=2 and hi=1 then 'high' when readers>=2 or hi=1 then 'medium' else 'low' end as confidence
  from r left join m on m.sheet=r.sheet and m.number=r.number""")
def _consensus(fx):
    return nb.two_reader_consensus(fx.readings_fx)


@query("ring_growth", """
  with recursive b as (select village, survey as x, number as y from printed_fx union select village, number, survey from printed_fx),
  w as (select village, survey as s, 0 as ring from near_poses_fx where rms=0 union select w.village, b.y, ring+1 from w join b on b.village=w.village and b.x=w.s where ring<3)
  select village, s as survey, min(ring) as ring from w group by 1,2 having min(ring)>0""")
def _ring(fx):
    return nb.ring_growth(nb.trusted_neighbours(fx.printed_fx), fx.near_poses_fx.filter("rms = 0"), 3)


_CENTRES = "(select distinct village, survey, cast((cast(survey as int)*37)%360 as double) as theta, cast((cast(survey as int)*11)%70 as double) as cx, cast((cast(survey as int)*29)%90 as double) as cy from neighbours_fx)"


@query("side_checks", f"""
  with c as {_CENTRES}, s as {SIDE}, t as {TRUST},
  v as (select s.village, s.survey, s.other, a.theta, b.cx-a.cx as dx, b.cy-a.cy as dy,
     case side when 'NE' then 0.7071::double when 'E' then 1.0::double when 'SE' then 0.7071::double when 'SW' then -0.7071::double when 'W' then -1.0::double when 'NW' then -0.7071::double else 0.0::double end as vx,
     case side when 'N' then 1.0::double when 'NE' then 0.7071::double when 'SE' then -0.7071::double when 'S' then -1.0::double when 'SW' then -0.7071::double when 'NW' then 0.7071::double else 0.0::double end as vy
     from s join c a on a.village=s.village and a.survey=s.survey join c b on b.village=s.village and b.survey=s.other where side is not null and s.survey<>s.other),
  k as (select *, case when ((cos(radians(theta))*vx-sin(radians(theta))*vy)*dx+(sin(radians(theta))*vx+cos(radians(theta))*vy)*dy)/sqrt(dx*dx+dy*dy)>=0.38 then 1 else 0 end as ok from v where sqrt(dx*dx+dy*dy)>=1),
  votes as (select k.village, k.survey, ok from k join t on t.village=k.village and t.survey=k.survey and t.other=k.other union all select village, other, ok from k)
  select village, survey, sum(ok)::bigint as side_ok, sum(1-ok)::bigint as side_bad from votes group by 1,2""")
def _sides(fx):
    n = F.col("survey").cast("int")
    centres = fx.neighbours_fx.select("village", "survey", ((n * 37) % 360).cast("double").alias("theta"), ((n * 11) % 70).cast("double").alias("cx"),
                                      ((n * 29) % 90).cast("double").alias("cy")).distinct()
    return nb.side_checks(nb.printed_side(fx.neighbours_fx, POS), nb.trusted_neighbours(fx.neighbours_fx), centres)


@query("disputed_reasons", """
  with c as (select l_orderkey%50 as v, l_suppkey, l_partkey%100 as o, l_orderkey, l_linenumber from lineitem),
  r as (select cast(s_nationkey as varchar) as village, cast(s_suppkey as varchar) as survey, 0 as src, 0 as p1, 0 as p2, 'Puvi and the portal describe different parcels' as reason from supplier where s_nationkey%3=0
    union all select cast(v as varchar), cast(l_suppkey as varchar), 1, l_orderkey, 0, concat('railway land conflict with ', o) from c
    union all select cast(v as varchar), cast(o as varchar), 1, l_orderkey, 1, concat('railway land conflict with ', l_suppkey) from c where o<>l_suppkey
    union all select cast(s_nationkey as varchar), cast(s_suppkey as varchar), 2, 0, 0, case when s_nationkey%2=0 then 'team doubts it' else 'listed in disputed.csv' end from supplier where s_nationkey%7=0)
  select village, survey, string_agg(reason, '; ' order by src, p1, p2, reason) as reason from r group by village, survey""")
def _disputed(fx):
    from plotloom.operators import inventory_audit as au
    s = fx.supplier
    village = F.col("s_nationkey").cast("string").alias("village")
    audit = s.select(village, F.col("s_suppkey").cast("string").alias("survey"), F.when(F.col("s_nationkey") % 3 == 0, "identity mismatch (area)").otherwise("agree").alias("verdict"))
    conflicts = fx.lineitem.select(
        (F.col("l_orderkey") % 50).cast("string").alias("village"), F.col("l_suppkey").cast("string").alias("survey_a"), (F.col("l_partkey") % 100).cast("string").alias("survey_b"), F.col("l_orderkey").alias("pos"))
    manual = s.filter("s_nationkey % 7 = 0").select(village, F.col("s_suppkey").cast("string").alias("survey"),
                                                   F.when(F.col("s_nationkey") % 2 == 0, "team doubts it").otherwise("").alias("reason"))
    return au.disputed_reasons(audit, conflicts, manual)


@query("todo_surveys", """
  with s as (select distinct village, survey from lattice_fx), a as (select village, survey from near_poses_fx where cast(survey as int)%10=0), o as (select village, survey from near_poses_fx where rms>0.1)
  select * from s where (village, survey) not in (select (village, survey) from a) and (village, survey) in (select (village, survey) from o)""")
def _todo(fx):
    from plotloom.operators import inventory_audit as au
    return au.todo_surveys(fx.lattice_fx.select("village", "survey").distinct(), fx.near_poses_fx.filter("cast(survey as int) % 10 = 0"),
                           fx.near_poses_fx.filter("rms > 0.1"))


@query("frozen_anchor_select", """
  with f as (select village, base, o_orderkey, mtime, md5(cast(o_orderkey%97 as varchar)) as fp from files_fx), t as (select md5(cast(n_nationkey as varchar)) as fp from nation)
  select village, base, arg_max(o_orderkey, struct_pack(m:=mtime, k:=o_orderkey)) as o_orderkey from f where fp not in (select fp from t) group by 1,2""")
def _frozen(fx):
    from plotloom.operators import inventory_audit as au
    f = fx.files_fx.select("village", "base", "o_orderkey", "mtime", F.md5((F.col("o_orderkey") % 97).cast("string")).alias("fingerprint"))
    tool = fx.nation.select(F.md5(F.col("n_nationkey").cast("string")).alias("fp"))
    return au.frozen_anchor_select(f, tool, ["village", "base"], ["mtime", "o_orderkey"]).select("village", "base", "o_orderkey")


@query("anchors_table", """
  with c as (select l_orderkey%25 as v, l_suppkey as a, l_partkey%100 as b, round(min(l_quantity)/8+0.001::double,3) as gap from lineitem where l_suppkey<l_partkey%100 group by 1,2,3),
  e as (select v, a as s, b as o, gap from c union all select v, b, a, gap from c),
  cf as (select v, s, string_agg(printf('%d (%.2f m)', o, gap), ';' order by o) as conflicts from e group by v, s),
  old as (select o_orderkey%25 as v, o_custkey%100 as s, string_agg(concat('f', o_orderkey, '.gpkg'), ';' order by o_orderkey desc) as sup from orders group by 1,2)
  select cast(s_nationkey as varchar) as village, cast(s_suppkey as varchar) as survey, round(cast((s_suppkey*37)%360 as double),3) as heading_deg, substr(sha256(cast(s_suppkey as varchar)),1,16) as fingerprint,
    coalesce(sup,'') as superseded_files, coalesce(conflicts,'') as conflicts from supplier left join cf on cf.s=s_suppkey and cf.v=s_nationkey left join old on old.s=s_suppkey and old.v=s_nationkey""")
def _anchors(fx):
    from plotloom.operators import inventory_audit as au
    k = F.col("s_suppkey")
    v = (F.col("o_orderkey") % 25).cast("string").alias("village")
    anchors = fx.supplier.select(F.col("s_nationkey").cast("string").alias("village"), k.cast("string").alias("survey"), ((k * 37) % 360).cast("double").alias("theta"), F.sha2(k.cast("string"), 256).alias("fingerprint"))
    sup = fx.orders.select(v, (F.col("o_custkey") % 100).cast("string").alias("survey"),
                                                        F.concat(F.lit("f"), "o_orderkey", F.lit(".gpkg")).alias("file"), F.col("o_orderkey").alias("mtime"))
    conf = (fx.lineitem.filter("l_suppkey < l_partkey % 100").groupBy((F.col("l_orderkey") % 25).cast("string").alias("village"), F.col("l_suppkey").cast("string").alias("a"), (F.col("l_partkey") % 100).cast("string").alias("b"))
            .agg(F.round(F.min("l_quantity") / 8 + 0.001, 3).alias("p90_gap_m")))
    return au.anchors_table(anchors, sup, conf).select("village", "survey", "heading_deg", "fingerprint", "superseded_files", "conflicts")


@query("plot_key_join", """
  with o as (select survey, poly_id, coalesce(plot_no,'') as pn, row_number() over (partition by survey order by poly_id) as k from lattice_fx),
  e as (select survey, poly_id+case when cast(survey as int)%5=0 then 10 else 0 end as poly_id, coalesce(plot_no,'') as pn, row_number() over (partition by survey order by poly_id) as k, i from lattice_fx where cast(survey as int)%7<>0 or poly_id<>2),
  n as (select o.survey, count(*) as n from o group by 1), m as (select survey, count(*) as m from e group by 1)
  select o.survey, o.poly_id, coalesce(a.i, case when n=m then b.i end) as new_i, case when a.i is not null then 'key' when n=m and b.i is not null then 'position' else 'unmatched' end as how
  from o join n on n.survey=o.survey left join m on m.survey=o.survey left join e a on a.survey=o.survey and a.poly_id=o.poly_id and a.pn=o.pn left join e b on b.survey=o.survey and b.k=o.k""")
def _plot_key(fx):
    from plotloom.operators import inventory_audit as au
    stored = fx.lattice_fx.select("survey", "poly_id", "plot_no", F.col("poly_id").alias("pos"))
    edited = (fx.lattice_fx.filter("cast(survey as int) % 7 <> 0 or poly_id <> 2")
              .select("survey", (F.col("poly_id") + F.when(F.col("survey").cast("int") % 5 == 0, 10).otherwise(0)).alias("poly_id"),
                      F.coalesce("plot_no", F.lit("")).alias("plot_no"), F.col("poly_id").alias("pos"), F.col("i").alias("new_i")))
    return au.plot_key_join(stored, edited, ["survey"], "new_i").select("survey", "poly_id", "new_i", "how")


@query("in_window_flag", """
  with w as (select village, min(x1)+30 as wx0, min(y1)+20 as wy0, max(x3)-30 as wx1, max(y3)-20 as wy1 from lattice_fx group by 1)
  select village, survey, poly_id, case when least(x1,x2,x3,x4)>=wx0 and least(y1,y2,y3,y4)>=wy0 and greatest(x1,x2,x3,x4)<=wx1 and greatest(y1,y2,y3,y4)<=wy1 then 1 else 0 end as in_window
  from lattice_fx join w using (village)""")
def _window(fx):
    from plotloom.operators import inventory_audit as au
    w = fx.lattice_fx.groupBy("village").agg((F.min("x1") + 30).alias("wx0"), (F.min("y1") + 20).alias("wy0"), (F.max("x3") - 30).alias("wx1"), (F.max("y3") - 20).alias("wy1"))
    b = fx.lattice_fx.select("village", "survey", "poly_id", F.least("x1", "x2", "x3", "x4").alias("minx"), F.least("y1", "y2", "y3", "y4").alias("miny"),
                             F.greatest("x1", "x2", "x3", "x4").alias("maxx"), F.greatest("y1", "y2", "y3", "y4").alias("maxy"))
    return au.in_window_flag(b, w).select("village", "survey", "poly_id", "in_window")
