"""Evaluation queries: metrics, folds, rows, work lists."""

from pyspark.sql import functions as F

from plotloom import schemas
from plotloom.operators import evaluation as ev
from plotloom.operators import inventory as inv
from plotloom.plans.catalog import query
from plotloom.plans.q_text import cause_case

_M = """count(*) as rows, count(within_3m) as labelled,
  round(100.0::double*count(*) filter (where within_3m=1)/nullif(count(within_3m),0),1) as within_pct,
  count(*) filter (where colour='green' and within_3m is not null) as green,
  round(100.0::double*count(*) filter (where colour='green' and within_3m=1)/nullif(count(*) filter (where colour='green' and within_3m is not null),0),1) as green_within_pct,
  count(*) filter (where colour='red' and within_3m is not null) as red,
  round(100.0::double*count(*) filter (where colour='red' and within_3m=0)/nullif(count(*) filter (where colour='red' and within_3m is not null),0),1) as red_beyond_pct,
  round(100.0::double*count(*) filter (where colour in ('green','amber') and within_3m=1)/nullif(count(*) filter (where within_3m=1),0),1) as recall_green_amber_pct,
  round(quantile_cont(err_fmb_m,0.5),2) as err_fmb_median_m, round(quantile_cont(err_fmb_m,0.9),2) as err_fmb_p90_m,
  round(quantile_cont(err_hand_m,0.5),2) as err_hand_median_m, round(quantile_cont(err_hand_m,0.9),2) as err_hand_p90_m"""


@query("metrics", f"select run_id, {_M} from rows_fx group by run_id")
def _metrics(fx):
    return ev.metrics(fx.rows_fx, ["run_id"])


@query("comparison_table", f"""
  with s as (select *, 'all rows incl. backfilled' as row_set from rows_fx
    union all select *, 'current code, all labelled' from rows_fx where backfilled=0
    union all select *, 'current code, without 5-10 % tier' from rows_fx where backfilled=0 and stretch_band not like '5-%')
  select village, row_set, 'rule-based' as method, {_M} from s group by village, row_set""")
def _comparison(fx):
    return ev.comparison_table(fx.rows_fx)


@query("worst10", f"""select village, survey, run_id, err_fmb_m, err_hand_m, colour, stretched, {cause_case('notes')} as cause
  from rows_fx where backfilled=0 order by err_fmb_m desc, village, survey, run_id limit 10""")
def _worst(fx):
    return ev.worst10(fx.rows_fx)


@query("split_by_village", "select village, survey, run_id, case when village='7' then 'test' else 'train' end as part from rows_fx")
def _split(fx):
    return ev.split_by_village(fx.rows_fx, "7").select("village", "survey", "run_id", "part")


@query("leave_one_village_out", """
  with v as (select distinct village as fold from rows_fx where within_3m is not null)
  select fold, count(*) filter (where village=fold) as test_rows, count(within_3m) filter (where village=fold) as test_labelled,
    (sum(within_3m) filter (where village=fold))::bigint as test_within, count(*) filter (where village<>fold) as train_rows,
    count(within_3m) filter (where village<>fold) as train_labelled, (sum(within_3m) filter (where village<>fold))::bigint as train_within
  from v, rows_fx group by fold""")
def _lovo(fx):
    return ev.fold_sizes(fx.rows_fx)


@query("leave_one_out_inputs", """
  with s as (select distinct village, survey as fold from lattice_fx)
  select s.village, fold, count(distinct survey) as n_surveys, count(*) as n_inputs, sum(x1) as total
  from s join lattice_fx l on l.village=s.village and l.survey<>fold group by 1,2""")
def _loo(fx):
    return ev.leave_one_out_inputs(fx.lattice_fx, "x1")


@query("seed_inputs", """select village, survey, poly_id from lattice_fx where (village, survey) in
  (select (village, survey) from near_poses_fx where rms=0.25)""")
def _seeds(fx):
    return ev.seed_inputs(fx.lattice_fx.select("village", "survey", "poly_id"), fx.near_poses_fx.filter("rms = 0.25"))


@query("tolerance_per_parcel", """
  select survey, run_id, round(greatest(1.5, err_hand_m/4),6) as tolerance_m, round(greatest(1.5, err_fmb_m/3),6) as tolerance_deg,
   case when err_hand_m/4<=3 then 1 else 0 end as counted,
   case when err_fmb_m<=greatest(1.5, err_hand_m/4) and err_hand_m/2<=greatest(1.5, err_fmb_m/3) then 1 else 0 end as passed from rows_fx""")
def _tol(fx):
    t = fx.rows_fx.select("survey", "run_id", (F.col("err_hand_m") / 4).alias("rms"), (F.col("err_fmb_m") / 3).alias("heading_spread"),
                          F.col("err_fmb_m").alias("error_m"), (F.col("err_hand_m") / 2).alias("error_deg"))
    return ev.tolerance_per_parcel(t).select("survey", "run_id", F.round("tolerance_m", 6).alias("tolerance_m"),
                                             F.round("tolerance_deg", 6).alias("tolerance_deg"), "counted", "passed")


@query("calibrate_thresholds", """
  with w as (select share*0.8::double as s from status_fx where contradictions=1),
  g as (select round(least(max(s)+0.05::double, 0.95::double),3) as green_share, median(s) as mid from w)
  select green_share, round(least(mid, green_share-0.05::double),3) as amber_share from g""")
def _calibrate(fx):
    return ev.calibrate_thresholds(fx.status_fx.select(F.when(F.col("contradictions") == 1, F.col("share") * 0.8).alias("share_best_wrong")))


@query("verdict_counts", """select village, count(*) filter (where colour='green') as green, count(*) filter (where colour='amber') as amber,
  count(*) filter (where colour='red') as red from rows_fx group by village""")
def _counts(fx):
    return ev.verdict_counts(fx.rows_fx)


@query("worklist", """
  with r as (select l_suppkey%20 as village, concat(l_partkey, 'A') as survey, l_orderkey as pos, l_linenumber, l_suppkey, method from (select *, case when l_orderkey%3=0 then 'image' else 'anchors' end as method from lineitem) l)
  select cast(village as varchar) as village, survey, arg_max(method, struct_pack(a:=pos, b:=l_linenumber, c:=l_suppkey)) as method from r group by 1,2""")
def _worklist(fx):
    r = fx.lineitem.select((F.col("l_suppkey") % 20).cast("string").alias("village"), F.concat(F.col("l_partkey"), F.lit("A")).alias("survey"),
                           F.col("l_orderkey").alias("pos"), "l_linenumber", "l_suppkey",
                           F.when(F.col("l_orderkey") % 3 == 0, "image").otherwise("anchors").alias("method"))
    return ev.worklist(r, ["pos", "l_linenumber", "l_suppkey"]).select("village", "survey", "method")


@query("batch_totals", """
  with s as (select stem, village_code, case when min(i)%11=0 then 'error' when min(i)%7=0 then 'no-polygons' else 'ok' end as status, count(*) as polygons, count(plot_no) as numbered from attr_plots_fx group by 1,2)
  select count(*) as sheets, count(*) filter (where status='ok') as ok, count(*) filter (where status='no-polygons') as no_polygons, count(*) filter (where status='error') as errors,
   (sum(polygons) filter (where status='ok'))::bigint as polygons, (sum(numbered) filter (where status='ok'))::bigint as numbered,
   round(100.0::double*(sum(numbered) filter (where status='ok'))/(sum(polygons) filter (where status='ok')),0) as numbered_pct from s""")
def _batch(fx):
    i = F.min("i")
    s = fx.attr_plots_fx.groupBy("village_code", "stem").agg(
        F.when(i % 11 == 0, "error").when(i % 7 == 0, "no-polygons").otherwise("ok").alias("status"),
        F.count("*").alias("polygons"), F.count("plot_no").alias("numbered"))
    return ev.batch_totals(s)


@query("tool_fingerprints", """select distinct fp from (select nullif(printed_far,'') as fp from status_fx union all select nullif(neighbours,'') from status_fx) f where fp is not null""")
def _fps(fx):
    from plotloom.operators import neighbours as nb
    return nb.tool_fingerprints(fx.status_fx, ["printed_far", "neighbours"])


@query("common_plots", """
  with a as (select village, cast(cast(survey as int)%50 as varchar) as survey, i as poly_id, x1 as area_a from lattice_fx),
  b as (select village, cast(cast(survey as int)%50 as varchar) as survey, case when cast(survey as int)%3=0 then i+1000000 when p_size%5=0 then i+2000000 else i end as poly_id, y1 as area_b from lattice_fx),
  shared as (select a.village, a.survey, a.poly_id, b.poly_id as other_id from a join b on a.village=b.village and a.survey=b.survey and a.poly_id=b.poly_id),
  ra as (select *, row_number() over (partition by village, survey order by area_a desc, poly_id) as k from a where (village, survey) not in (select (village, survey) from shared)),
  rb as (select *, row_number() over (partition by village, survey order by area_b desc, poly_id) as k from b)
  select village, survey, poly_id, other_id, 'id' as how from shared
  union all select ra.village, ra.survey, ra.poly_id, rb.poly_id, 'area' from ra join rb on ra.village=rb.village and ra.survey=rb.survey and ra.k=rb.k""")
def _common(fx):
    from plotloom.operators import neighbours as nb
    n = F.col("survey").cast("int")
    key = ["village", (n % 50).cast("string").alias("survey")]
    a = fx.lattice_fx.select(*key, F.col("i").alias("poly_id"), F.col("x1").alias("area"))
    other = F.when(n % 3 == 0, F.col("i") + 1000000).when(F.col("p_size") % 5 == 0, F.col("i") + 2000000).otherwise(F.col("i"))
    b = fx.lattice_fx.select(*key, other.alias("poly_id"), F.col("y1").alias("area"))
    return nb.common_plots(a, b)


_REF = """reference_rows as (select cast(c_custkey%10 as varchar) as village, cast(c_custkey as varchar) as survey, case when c_custkey%2=0 then 'points' else 'geometry' end as ref_source,
   cast(c_custkey%33 as double)/8 as ref_rms_m, 1+cast(c_custkey%65-32 as double)/256 as ref_area_scale, case when c_custkey%11=0 then 1 else 0 end as stretched,
   case when c_custkey%13=0 then 1 else 0 end as disputed from customer)"""


def _refs(fx):
    k = F.col("c_custkey")
    null = F.lit(None).cast("double")
    return fx.customer.select(
        (k % 10).cast("string").alias("village"), k.cast("string").alias("survey"),
        F.when(k % 2 == 0, "points").otherwise("geometry").alias("ref_source"), ((k % 33).cast("double") / 8).alias("ref_rms_m"),
        (((k % 65) - 32).cast("double") / 256 + 1).alias("ref_area_scale"), null.alias("ref_stretch_long_pct"), null.alias("ref_stretch_short_pct"),
        null.alias("ref_disagree_mean_m"), null.alias("ref_disagree_p95_m"), null.alias("ref_disagree_corner_mean_m"),
        F.lit("<=5%").alias("stretch_band"), F.when(k % 11 == 0, 1).otherwise(0).alias("stretched"), F.lit("").alias("stretched_reason"),
        F.when(k % 13 == 0, 1).otherwise(0).alias("disputed"), F.lit("").alias("disputed_reason"))


def _sql_rows(given: str, source: str, joins: str) -> str:
    cols = []
    have = dict(kv.split("=", 1) for kv in given.split(";;"))
    for f in schemas.FEATURE_ROW.fields:
        kind = {"string": "varchar", "integer": "int", "double": "double"}[f.dataType.typeName()]
        default = "''" if f.name in ("run_at", "tool_git_sha", "seeds", "imagery_source", "window_sha256", "stretched_reason",
                                     "disputed_reason") else "null"
        cols.append(f"cast({have.get(f.name, default).strip()} as {kind}) as {f.name}")
    return f"with {_REF} select {', '.join(cols)} from {source} {joins}"


@query("feature_rows", _sql_rows(
    "run_id='r1';;mode='full';;backfilled=0;;village=s.village;;survey=s.survey;;method=s.method;;support_m=sup;;support_next_m=nxt;;"
    "runner_up_ratio=case when sup<>0 then round(nxt/sup,4) end;;boundary_rms_m=rms;;n_neighbours=nn;;printed_far_n=pf;;"
    "observable=obs;;notes=note;;topo_clipped=case when contains(note,'clipped') then 1 else 0 end;;"
    "topo_max_move_m=try_cast(nullif(regexp_extract(note,'conform max ([0-9.]+) m',1),'') as double);;colour='amber';;"
    "confidence_rule=60;;ref_source=coalesce(r.ref_source,'none');;ref_rms_m=r.ref_rms_m;;ref_area_scale=r.ref_area_scale;;"
    "stretch_band=case when r.survey is null then '' else '<=5%' end;;stretched=r.stretched;;disputed=r.disputed;;err_fmb_m=ef;;err_hand_m=eh;;heading_err_deg=hd;;max_vertex_err_m=mv;;"
    "within_3m=case when r.survey is not null and r.stretched=0 and r.disputed=0 then case when ef<=3 then 1 else 0 end end",
    """(select cast(o_orderkey%10 as varchar) as village, cast(o_orderkey%10 + 10*o_orderkey as varchar) as survey0, cast(o_orderkey as varchar) as survey,
        case when o_orderkey%3=0 then 'image' else 'anchors' end as method, cast(o_orderkey%50 as double) as sup, cast(o_orderkey%40 as double)/2 as nxt, cast(o_orderkey%64 as double)/8 as rms,
        case o_orderkey%3 when 0 then 0 when 1 then 1 else 3 end as nn, case o_orderkey%2 when 0 then 0 else 2 end as pf, case o_orderkey%3 when 0 then 1 when 1 then 0 end as obs,
        case o_orderkey%4 when 0 then 'topology: conform max 0.41 m,clipped' when 1 then '' else 'clipped' end as note,
        cast(o_orderkey%2048 as double)/128 as ef, cast(o_orderkey%1024 as double)/128 as eh, cast(o_orderkey%360 as double)/4 as hd, cast(o_orderkey%512 as double)/16 as mv from orders where o_orderkey%5<>0) s""",
    "left join reference_rows r on r.village=s.village and r.survey=s.survey"))
def _features(fx):
    k = F.col("o_orderkey")
    status = fx.orders.select(
        (k % 10).cast("string").alias("village"), k.cast("string").alias("survey"), F.when(k % 5 == 0, "waiting").otherwise("placed").alias("status"),
        F.when(k % 3 == 0, "image").otherwise("anchors").alias("method"), (k % 50).cast("double").alias("support_m"),
        ((k % 40).cast("double") / 2).alias("support_next_m"), ((k % 64).cast("double") / 8).alias("boundary_rms_m"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, "41").otherwise("9,40A,,171").alias("neighbours"),
        F.when(k % 2 == 0, "").otherwise("12,13").alias("printed_far"), F.when(k % 3 == 0, "True").when(k % 3 == 1, "False").otherwise("").alias("observable"),
        F.when(k % 4 == 0, "topology: conform max 0.41 m,clipped").when(k % 4 == 1, "").otherwise("clipped").alias("notes"),
        F.lit("amber").alias("colour"), F.lit("60").alias("confidence"))
    errors = fx.orders.select((k % 10).cast("string").alias("village"), k.cast("string").alias("survey"), ((k % 2048).cast("double") / 128).alias("err_fmb_m"),
                              ((k % 1024).cast("double") / 128).alias("err_hand_m"), ((k % 360).cast("double") / 4).alias("heading_err_deg"),
                              ((k % 512).cast("double") / 16).alias("max_vertex_err_m"))
    return ev.feature_rows(status, _refs(fx), errors, {"run_id": "r1", "mode": "full"})


@query("backfill_rows", _sql_rows(
    "run_id='loo_old';;mode='loo';;backfilled=1;;village=s.village;;survey=s.survey;;method='anchors';;colour=s.colour;;n_neighbours=2;;printed_far_n=0;;topo_clipped=0;;share=sh;;observable=1;;"
    "notes='backfilled from old.csv';;ref_source=coalesce(r.ref_source,'none');;ref_rms_m=r.ref_rms_m;;ref_area_scale=r.ref_area_scale;;"
    "stretch_band=case when r.survey is null then '' else '<=5%' end;;stretched=r.stretched;;disputed=r.disputed;;err_fmb_m=ef;;heading_err_deg=hd;;"
    "within_3m=case when r.survey is not null and r.stretched=0 and r.disputed=0 and ef is not null then case when ef<=3 then 1 else 0 end end",
    """(select cast(o_orderkey%10 as varchar) as village, cast(o_orderkey as varchar) as survey, case when o_orderstatus='F' then 'green' else 'red' end as colour,
        cast(o_orderkey%100 as double)/128 as sh, case when o_orderkey%6=0 then null else cast(o_orderkey%2048 as double)/128 end as ef, cast(o_orderkey%90 as double)/4 as hd from orders) s""",
    "left join reference_rows r on r.village=s.village and r.survey=s.survey"))
def _backfill(fx):
    k = F.col("o_orderkey")
    old = fx.orders.select((k % 10).cast("string").alias("village"), k.cast("string").alias("survey"),
                           F.when(F.col("o_orderstatus") == "F", "green").otherwise("red").alias("colour"), F.lit("anchors").alias("method"),
                           ((k % 100).cast("double") / 128).cast("string").alias("share"), F.lit("True").alias("observable"), F.lit("41,42").alias("neighbours"),
                           F.when(k % 6 == 0, "").otherwise(((k % 2048).cast("double") / 128).cast("string")).alias("centroid_error_m"),
                           ((k % 90).cast("double") / 4).cast("string").alias("heading_error_deg"), F.lit("backfilled from old.csv").alias("notes"))
    return ev.backfill_rows(old, _refs(fx), {"run_id": "loo_old", "mode": "loo"})
