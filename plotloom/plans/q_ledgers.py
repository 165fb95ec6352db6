"""Inventory, coverage and merge queries."""

from pyspark.sql import functions as F

from plotloom.functions import text as tx
from plotloom.operators import inventory as inv
from plotloom.plans.catalog import query


@query("newest_file_per_key", """
  select village, base, o_orderkey, case when row_number() over (partition by village, base order by mtime desc, o_orderkey desc)=1 then 1 else 0 end as is_current
  from files_fx""")
def _newest(fx):
    f = fx.files_fx.select("village", "base", "mtime", "o_orderkey")
    return inv.newest_file_per_key(f, ["village", "base"], ["mtime", "o_orderkey"], "o_orderkey").drop("mtime")


_COARSE = """(select village, base as plain, arg_max(stem, coalesce(try_cast(nullif(regexp_extract(stem, '_s([0-9]+)$', 1),'') as int),500)) as stem,
    max(coalesce(try_cast(nullif(regexp_extract(stem, '_s([0-9]+)$', 1),'') as int),500)) as scale from files_fx group by village, base)"""


@query("pick_coarsest_version", f"select * from {_COARSE} c")
def _coarse(fx):
    return inv.pick_coarsest_version(fx.files_fx)


@query("scale_override", f"""
  select c.village, c.plain, c.stem, coalesce(o.scale, c.scale) as scale from {_COARSE} c
  left join scale_table_fx o on o.village=c.village and o.survey_no=c.stem""")
def _override(fx):
    return inv.scale_override(inv.pick_coarsest_version(fx.files_fx), fx.scale_table_fx)


@query("last_error_per_key", """
  select giscode, coalesce((array_agg(api_error order by pos desc) filter (where status<>'saved'))[1], '') as api_error from log_fx group by giscode""")
def _last(fx):
    return inv.last_error_per_key(fx.log_fx)


_BASE = """base as (select concat('35_',lpad(taluk,2,'0'),'_',lpad(village,3,'0')) as village_code, concat('S35',lpad(taluk,2,'0'),lpad(village,3,'0')) as pre,
      village_name, survey_no, vector_pieces from batch_fx),
  disk as (select distinct village as village_code, unit as survey_unit from files_fx where size>1000)"""
_TRIED = """tried as (
    select village_code, survey_no, unit from (select village_code, survey_no, unnest(string_split(regexp_replace(vector_pieces,'\\s+','','g'),';')) as unit from base) p
      where regexp_matches(unit,'[A-Za-z]')
    union select village_code, survey_no, concat(survey_no, s) from base, (select unnest(['A','B','C','D','E','F']) as s) l
      where concat(pre, survey_no, s) in (select giscode from download_log_fx))"""
_COVER = f"""with {_BASE}, {_TRIED},
  plain as (select b.* from base b where exists (select 1 from disk d where d.village_code=b.village_code and d.survey_unit=b.survey_no)),
  letters as (select b.*, d.survey_unit from base b join disk d on d.village_code=b.village_code and regexp_full_match(d.survey_unit, concat(b.survey_no,'[A-Za-z]+'))
     where not exists (select 1 from plain p where p.village_code=b.village_code and p.survey_no=b.survey_no)),
  err as (select giscode, arg_max(api_error, pos) as api_error from download_log_fx where status<>'saved' group by giscode),
  absent as (select * from base b where not exists (select 1 from plain p where p.village_code=b.village_code and p.survey_no=b.survey_no)
     and not exists (select 1 from letters p where p.village_code=b.village_code and p.survey_no=b.survey_no)),
  cover as (
  select village_name as village, village_code, survey_no as survey_unit, survey_no as base_survey, 'plain number' as unit_kind, 'saved' as sketch, '' as api_error, vector_pieces from plain
  union all select village_name, village_code, survey_unit, survey_no, 'letter form', 'saved', '', vector_pieces from letters
  union all select village_name, a.village_code, a.survey_no, a.survey_no, 'plain number', 'missing',
     concat(coalesce(nullif(e.api_error,''),'not available'), ' | also tried: ',
       coalesce((select string_agg(unit, ', ' order by unit) from tried t where t.village_code=a.village_code and t.survey_no=a.survey_no),'-')), vector_pieces
     from absent a left join err e on e.giscode=concat(pre, survey_no)
  union all select coalesce((select min(village_name) from base b where b.village_code=d.village_code), d.village_code), d.village_code, survey_unit,
     coalesce(nullif(regexp_extract(survey_unit,'^[0-9]+',0),''), survey_unit), case when regexp_matches(survey_unit,'[A-Za-z]') then 'letter form' else 'plain number' end,
     'saved','','(added manually)' from disk d
     where not exists (select 1 from plain p where p.village_code=d.village_code and p.survey_no=d.survey_unit)
       and not exists (select 1 from letters p where p.village_code=d.village_code and p.survey_unit=d.survey_unit))"""


def _coverage(fx):
    return inv.coverage_status(fx.batch_fx, fx.files_fx, fx.download_log_fx)


query("coverage_status", _COVER + " select * from cover")(_coverage)


@query("missing_histogram", _COVER + """ select village, count(*) as n_units, count(*) filter (where sketch='missing') as n_missing,
   count(distinct base_survey) filter (where sketch='missing') as n_bases from cover group by village""")
def _hist(fx):
    return inv.missing_histogram(_coverage(fx))


@query("tried_units", f"with {_BASE}, {_TRIED} select * from tried")
def _tried(fx):
    base = fx.batch_fx.select(tx.village_code(F.col("taluk"), F.col("village")).alias("village_code"), "survey_no", "vector_pieces")
    return inv.tried_units(base, fx.download_log_fx)


@query("unclaimed_units", f"with {_BASE} select * from disk where (village_code, survey_unit) not in (select (village_code, survey_no) from base)")
def _unclaimed(fx):
    claimed = fx.batch_fx.select(tx.village_code(F.col("taluk"), F.col("village")).alias("village_code"),
                                 F.col("survey_no").alias("survey_unit"))
    return inv.unclaimed_units(fx.files_fx, claimed)


@query("enrich_attributes", """
  with v as (select concat('35_',lpad(taluk,2,'0'),'_',lpad(cast(cast(village as int)-100 as varchar),3,'0')) as village_code, min(village_name) as village_name from batch_fx group by 1),
  n as (select village_code, stem, count(*) as n from attr_plots_fx group by 1,2)
  select p.village_code, p.stem, i, poly_id, regexp_replace(p.stem,'_s[0-9]+$','') as survey_no, coalesce(v.village_name, p.village_code) as village,
    case split_part(p.village_code,'_',2) when '04' then 'Chengalpattu' when '05' then 'Tambaram' when '15' then 'Vandalur' else split_part(p.village_code,'_',2) end as taluk,
    cast(split_part(p.village_code,'_',2) as int) as taluk_code,
    concat('S35',split_part(p.village_code,'_',2),split_part(p.village_code,'_',3),regexp_replace(p.stem,'_s[0-9]+$','')) as giscode,
    concat(p.village_code,'_',regexp_replace(p.stem,'_s[0-9]+$','')) as sketch_id,
    case when n=1 and plot_no is null then regexp_replace(p.stem,'_s[0-9]+$','') else plot_no end as plot_no,
    case when n=1 and plot_no is null then 'whole_survey_no_subdivision' else 'glyph_outline' end as label_source
  from attr_plots_fx p join n on n.village_code=p.village_code and n.stem=p.stem left join v on v.village_code=p.village_code""")
def _enrich(fx):
    code = tx.village_code(F.col("taluk"), (F.col("village").cast("int") - 100).cast("string"))
    names = fx.batch_fx.groupBy(code.alias("village_code")).agg(F.min("village_name").alias("village_name"))
    return inv.enrich_attributes(fx.attr_plots_fx, names)


@query("per_sketch_rollup", """select village_code, stem, count(*) as polygons, count(plot_no) as numbered, sum(review)::bigint as review_needed
  from attr_plots_fx group by 1,2""")
def _rollup(fx):
    return inv.per_sketch_rollup(fx.attr_plots_fx)


@query("survey_area_totals", """select village, regexp_extract(unit,'^[0-9]+',0) as base, round(sum(coalesce(area,0)),2) as area from sheet_areas_fx group by 1,2""")
def _areas(fx):
    return inv.survey_area_totals(fx.sheet_areas_fx).withColumn("area", F.round("area", 2))


_LOOK = """select s.village, s.unit, s.o_orderkey, s.area, s.cx, s.cy, case when e.ukey is not null then e.area else p.area end as ref_area,
   case when e.ukey is not null then e.cx else p.cx end as ref_cx, case when e.ukey is not null then e.cy else p.cy end as ref_cy,
   case when e.ukey is not null then 'exact' when p.ukey is not null then 'parent' else '' end as match
   from sheet_areas_fx s left join independent_fx e on e.village=s.village and e.ukey=upper(s.unit)
   left join independent_fx p on p.village=s.village and p.ukey=regexp_extract(s.unit,'^[0-9]+',0)"""


def looked_up(fx):
    return inv.lookup_exact_then_parent(fx.sheet_areas_fx, fx.independent_fx, F.col("unit"), ["area", "cx", "cy"])


query("lookup_exact_then_parent", _LOOK)(looked_up)


@query("area_identity_gate", f"""select o_orderkey, case when area>0 then round(ref_area/area, 6) end as ratio,
   case when area>0 and ref_area/area between 1/3.0::double and 3.0::double then 1 else 0 end as trusted from ({_LOOK}) k""")
def _gate(fx):
    from plotloom.operators import rules
    return looked_up(fx).select("o_orderkey", F.round(rules.area_ratio(F.col("ref_area"), F.col("area")), 6).alias("ratio"),
                                rules.area_trusted(F.col("ref_area"), F.col("area")).cast("int").alias("trusted"))


@query("reference_distance", f"""select o_orderkey, match, round(sqrt((cx-ref_cx)*(cx-ref_cx)+(cy-ref_cy)*(cy-ref_cy)),6) as dist from ({_LOOK}) k""")
def _refdist(fx):
    return looked_up(fx).select("o_orderkey", "match", F.round(F.hypot(F.col("cx") - F.col("ref_cx"), F.col("cy") - F.col("ref_cy")), 6).alias("dist"))


@query("area_identity_audit", f"""select village, case when area<150 then 'fragment' when area is null or ref_area is null or match='' then 'no reference'
   when greatest(ref_area/area, area/ref_area)<=1.5 then 'agree' when greatest(ref_area/area, area/ref_area)<=3 then 'partial' else 'mismatch' end as verdict, count(*) as n
   from ({_LOOK}) k group by 1,2""")
def _audit(fx):
    from plotloom.operators import rules
    return looked_up(fx).groupBy("village", rules.identity_verdict(F.col("area"), F.col("ref_area")).alias("verdict")).agg(F.count("*").alias("n"))


@query("sink_upsert_by_key", """
  select village, survey, run_id, colour, err_fmb_m from rows_fx where backfilled=0 and survey not in (select survey from rows_fx where backfilled=1 or stretched=1)
  union all select village, survey, 'new', 'red', err_hand_m from rows_fx where backfilled=1 or stretched=1""")
def _upsert(fx):
    r = fx.rows_fx
    old = r.filter("backfilled=0").select("village", "survey", "run_id", "colour", "err_fmb_m")
    new = r.filter("backfilled=1 or stretched=1").select("village", "survey", F.lit("new").alias("run_id"), F.lit("red").alias("colour"), F.col("err_hand_m").alias("err_fmb_m"))
    return inv.upsert_by_key(old, new, ["village", "survey"])


@query("sink_protect_owner_rows", """
  with stored as (select l_suppkey as survey, l_partkey as corner_id, min(l_quantity) as map_x, case when min(l_linenumber)=1 then 'team' else 'auto' end as source from lineitem group by 1,2),
  fresh as (select l_suppkey as survey, l_partkey as corner_id, max(l_quantity) as map_x, 'auto' as source from lineitem where l_linenumber>=2 group by 1,2)
  select f.survey, f.corner_id, case when s.source='team' then s.map_x else f.map_x end as map_x, case when s.source='team' then 'team' else 'auto' end as source
  from fresh f left join stored s on s.survey=f.survey and s.corner_id=f.corner_id""")
def _protect(fx):
    g = fx.lineitem.groupBy(F.col("l_suppkey").alias("survey"), F.col("l_partkey").alias("corner_id"))
    stored = g.agg(F.min("l_quantity").alias("map_x"), F.when(F.min("l_linenumber") == 1, "team").otherwise("auto").alias("source"))
    fresh = (fx.lineitem.filter("l_linenumber >= 2").groupBy(F.col("l_suppkey").alias("survey"), F.col("l_partkey").alias("corner_id"))
             .agg(F.max("l_quantity").alias("map_x"), F.lit("auto").alias("source")))
    return inv.protect_owner_rows(stored, fresh, ["survey", "corner_id"])
