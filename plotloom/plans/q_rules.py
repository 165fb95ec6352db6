"""Rule verdict queries."""

from pyspark.sql import functions as F

from plotloom.functions import text as tx
from plotloom.operators import rules
from plotloom.plans.catalog import query

_TYPED = """(select *, case when lower(trim(observable)) in ('true','1','yes') then 1 else 0 end as obs, case when lower(trim(ambiguous)) in ('true','1','yes') then 1 else 0 end as amb,
   len(list_filter(string_split(printed_far, ','), lambda x: x<>'')) as pf from status_fx)"""


def typed(fx):
    return fx.status_fx.withColumns({"observable": tx.lenient_flag(F.col("observable")), "ambiguous": tx.lenient_flag(F.col("ambiguous")),
                                     "printed_far_n": tx.list_count(F.col("printed_far"))})


@query("colour_verdict", f"""
  with t as (select *, coalesce(contradictions, coalesce(pf,0)+coalesce(side_bad,0)) as contra, coalesce(boundary_rms_m <= coalesce(anchor_rms_m,0)+0.30::double, false) as anch,
     share>=0.85 and obs=1 as strong, share>=0.45 and obs=1 as weak, coalesce(support_m,0)>0 and coalesce(support_next_m,0)<=support_m*0.80::double as dec from {_TYPED} s),
  c as (select *, case when method='puvi-only' then 'red' when contra>=2 then 'red' when boundary_rms_m>5 then 'red' when amb=1 and boundary_rms_m is null then 'red'
     when n_neighbours<=1 and not (strong or weak) then 'red' when contra<>0 then case when anch or strong or weak then 'amber' else 'red' end
     when anch and coalesce(anchor_partners,n_neighbours)>=1 and ((strong and n_neighbours>=2) or (dec and n_neighbours>=3)) then 'green'
     when anch or strong or weak then 'amber' else 'red' end as colour from t)
  select id, colour, case colour when 'green' then 90 when 'amber' then 60 else 30 end as confidence from c""")
def _colour(fx):
    t = typed(fx)
    names = ("method contradictions printed_far_n side_bad boundary_rms_m ambiguous anchor_rms_m share observable support_m "
             "support_next_m n_neighbours anchor_partners").split()
    c = t.select("id", rules.colour_verdict({n: F.col(n) for n in names}).alias("colour"))
    return c.withColumn("confidence", rules.confidence_of(F.col("colour")))


@query("decisive_flag", "select id, case when support_m>0 and coalesce(support_next_m,0)<=support_m*0.80::double then 1 else 0 end as decisive from status_fx")
def _decisive(fx):
    return fx.status_fx.select("id", rules.decisive(F.col("support_m"), F.col("support_next_m")).cast("int").alias("decisive"))


@query("label_rule", "select village, survey, run_id, within_3m from rows_fx")
def _label(fx):
    return fx.rows_fx.select("village", "survey", "run_id", rules.label_rule(
        F.col("err_fmb_m"), F.col("stretched"), F.col("disputed"), F.lit(True)).alias("within_3m"))


_STRETCH = """(select o_orderkey as k, 1+cast(o_orderkey%65-32 as double)/128 as sc, cast(o_orderkey%51-25 as double)/2 as lp, cast(o_orderkey%37-18 as double)/2 as sp,
   cast(o_orderkey%33 as double)/8 as rms, cast(o_orderkey%41 as double)/8 as dm, cast(o_orderkey%29 as double)/8 as cm from orders)"""


def _stretch_in(fx):
    k = F.col("o_orderkey")
    return fx.orders.select(k.alias("k"), (((k % 65) - 32).cast("double") / 128 + 1).alias("sc"), (((k % 51) - 25).cast("double") / 2).alias("lp"),
                            (((k % 37) - 18).cast("double") / 2).alias("sp"), ((k % 33).cast("double") / 8).alias("rms"),
                            ((k % 41).cast("double") / 8).alias("dm"), ((k % 29).cast("double") / 8).alias("cm"))


@query("stretch_rule", f"""
  select k, case when rms>3 then 1 when abs(sc-1)*100>10 then 1 else 0 end as by_pct, case when rms>3 then 1 when greatest(abs(lp),abs(sp))>10 then 1 else 0 end as by_axis,
    case when rms>3 then 1 when greatest(dm,cm)>3 then 1 else 0 end as by_move,
    case when rms>3 or greatest(dm,cm)<=3 then case when rms>3 then concat('rms ', cast(rms as varchar)) else '' end
     else printf('FMB-exact and hand placement disagree by %.2f m mean (outline %.2f, corners %.2f; limit 3.0 m)', greatest(dm,cm)+0.001::double, dm+0.001::double, cm+0.001::double) end as reason from {_STRETCH} s""")
def _stretch(fx):
    d = _stretch_in(fx)
    # a thousandth keeps the printed two decimals away from exact halves, where printf and Java disagree
    s = {r: rules.stretch_rule(r, F.col("sc"), F.col("lp"), F.col("sp"), F.col("rms"), F.col("dm") + e, F.col("cm") + e)
         for r, e in (("pct", 0), ("axis", 0), ("displacement", 0.001))}
    why = F.when(F.col("rms") > 3, F.concat(F.lit("rms "), F.col("rms").cast("string"))).otherwise(s["displacement"]["reason"])
    exact = rules.stretch_rule("displacement", F.col("sc"), F.col("lp"), F.col("sp"), F.col("rms"), F.col("dm"), F.col("cm"))
    return d.select("k", s["pct"]["stretched"].alias("by_pct"), s["axis"]["stretched"].alias("by_axis"), exact["stretched"].alias("by_move"),
                    F.when(exact["stretched"] == 1, why).otherwise("").alias("reason"))


@query("stretch_band", f"select k, case when abs(sc-1)*100<=5 then '<=5%' when abs(sc-1)*100<=10 then '5-10%' else '>10%' end as band from {_STRETCH} s")
def _band(fx):
    return _stretch_in(fx).select("k", rules.stretch_band(F.col("sc")).alias("band"))


@query("confidence_score", f"""
  with s as (select k, case when k%7=0 then null else rms end as rms, lp+13 as m, k%4 as nn, k%5 as np, cast(k%300 as double) as far, k%9=0 as seed from {_STRETCH} s),
  a as (select *, case when rms is null then 40.0::double else 40*greatest(0.0::double, least(1.0::double, (1.5::double-rms)/(1.5::double-0.3::double))) + 30*least(1.0::double, m/20) + 15*least(2, nn) end as c from s),
  b as (select *, case when rms is not null and np<=2 then least(c, 79) else c end as c1 from a), d as (select *, case when seed then greatest(c1, 80) else c1 end as c2 from b)
  select k, cast(round_even(case when far>150 then least(c2, 60) else c2 end, 0) as int) as confidence from d""")
def _confidence(fx):
    k = F.col("k")
    return _stretch_in(fx).select("k", rules.confidence_score(F.when(k % 7 != 0, F.col("rms")), F.col("lp") + 13, (k % 4).cast("int"), k % 5,
                                                              (k % 300).cast("double"), k % 9 == 0).alias("confidence"))
