"""Text, cast and code expressions on the derived tables."""

from pyspark.sql import functions as F

from plotloom.functions import text as tx
from plotloom.plans.catalog import query


@query("normalise_survey", """
  with u as (select l_orderkey, l_linenumber, l_partkey, survey, number, upper(trim(number)) as up from neighbours_fx),
  b as (select *, split_part(replace(regexp_replace(up, '^S\\.?\\s*NO\\.?\\s*', ''), ' ', ''), '/', 1) as bare from u)
  select l_orderkey, l_linenumber, l_partkey, survey, number,
         case when up not like '%V.NO%' and up not like '%VILLAGE%' and regexp_full_match(bare, '[0-9]+[A-Z]?') then bare end as norm
  from b""")
def _normalise(fx):
    return fx.neighbours_fx.select("l_orderkey", "l_linenumber", "l_partkey", "survey", "number",
                                   tx.normalise_survey(F.col("number")).alias("norm"))


@query("natural_sort_key", """
  select distinct survey, coalesce(try_cast(nullif(regexp_extract(survey, '^[0-9]+', 0), '') as int), 1000000000) as num,
         survey as txt from status_fx
  union select distinct source, coalesce(try_cast(nullif(regexp_extract(source, '^[0-9]+', 0), '') as int), 1000000000), source from notes_fx""")
def _natural(fx):
    ids = fx.status_fx.select("survey").unionByName(fx.notes_fx.select(F.col("source").alias("survey"))).distinct()
    return ids.select("survey", tx.survey_order(F.col("survey")).alias("num"), F.col("survey").alias("txt"))


@query("base_survey", """
  select distinct stem, unit, regexp_replace(stem, '_s[0-9]+$', '') as plain, nullif(regexp_extract(unit, '^[0-9]+', 0), '') as digits,
         regexp_replace(unit, '[^0-9].*$', '') as head from files_fx""")
def _base(fx):
    return fx.files_fx.select("stem", "unit").distinct().select(
        "stem", "unit", tx.strip_scale_suffix(F.col("stem")).alias("plain"),
        tx.leading_digits(F.col("unit")).alias("digits"), tx.strip_tail(F.col("unit")).alias("head"))


@query("compose_codes", """
  select taluk, village, survey_no, concat('35_', lpad(taluk,2,'0'), '_', lpad(village,3,'0')) as village_code,
         concat('S35', lpad(taluk,2,'0'), lpad(village,3,'0'), survey_no) as giscode,
         concat('35_', lpad(taluk,2,'0'), '_', lpad(village,3,'0'), '_', survey_no) as sketch_id from batch_fx""")
def _codes(fx):
    code = tx.village_code(F.col("taluk"), F.col("village"))
    return fx.batch_fx.select("taluk", "village", "survey_no", code.alias("village_code"),
                              tx.giscode(code, F.col("survey_no")).alias("giscode"),
                              tx.sketch_id(code, F.col("survey_no")).alias("sketch_id"))


@query("lenient_cast", """
  select id, raw_num, try_cast(nullif(trim(raw_num), '') as double) as num,
         cast(round_even(try_cast(nullif(trim(raw_num), '') as double)/4, 0) as bigint) as whole,
         case when observable is null or observable='' then null when lower(trim(observable)) in ('true','1','yes') then 1 else 0 end as obs,
         case when ambiguous is null or ambiguous='' then null when lower(trim(ambiguous)) in ('true','1','yes') then 1 else 0 end as amb
  from status_fx""")
def _casts(fx):
    quarter = (tx.lenient_number(F.col("raw_num")) / 4).cast("string")
    return fx.status_fx.select("id", "raw_num", tx.lenient_number(F.col("raw_num")).alias("num"),
                               tx.lenient_int(quarter).alias("whole"), tx.lenient_flag(F.col("observable")).alias("obs"),
                               tx.lenient_flag(F.col("ambiguous")).alias("amb"))


@query("list_count", """
  select id, case when neighbours is not null then len(list_filter(string_split(neighbours, ','), lambda x: x<>'')) end as n_neigh,
         len(list_filter(string_split(printed_far, ','), lambda x: x<>'')) as n_far from status_fx""")
def _lists(fx):
    return fx.status_fx.select("id", tx.list_count(F.col("neighbours")).alias("n_neigh"),
                               tx.list_count(F.col("printed_far")).alias("n_far"))


@query("parse_notes", """
  select doc_id, try_cast(nullif(regexp_extract(notes, 'conform max ([0-9.]+) m', 1), '') as double) as moved,
         case when contains(notes, 'clipped') then 1 else 0 end as clipped from notes_fx""")
def _parse(fx):
    return fx.notes_fx.select("doc_id", tx.conform_move(F.col("notes")).alias("moved"),
                              tx.clipped_flag(F.col("notes")).alias("clipped"))


_CAUSE_CASE = " ".join(f"when contains(lower(coalesce({{0}},'')), '{k}') then '{v}'" for k, v in tx.CAUSES)


def cause_case(col: str) -> str:
    return "case " + _CAUSE_CASE.replace("{0}", col) + " else 'see notes' end"


@query("cause_of_error", f"""
  select doc_id, {cause_case('notes')} as cause, {cause_case('text')} as text_cause from notes_fx""")
def _cause(fx):
    return fx.notes_fx.select("doc_id", tx.cause_of_error(F.col("notes")).alias("cause"),
                              tx.cause_of_error(F.col("text")).alias("text_cause"))


@query("append_note", """
  select doc_id, case when notes='' then lang when lang='' then notes else concat(notes, ' | ', lang) end as joined,
         concat(split_part(notes, ' | topology:', 1), ' | topology: ', source) as retopo from notes_fx""")
def _append(fx):
    n = F.col("notes")
    return fx.notes_fx.select("doc_id", tx.append_note(n, F.col("lang")).alias("joined"),
                              tx.replace_topology_note(n, F.col("source")).alias("retopo"))


@query("verdict_text", """
  select sheet, count(*) as n,
    case when count(*)<150 then concat('unverified (', cast(count(*) as varchar), ' dimensions read)')
         when abs(min(ratio)-1)<=0.06 then printf('verified (n=%d, ratio=%.3f)', count(*), min(ratio))
         else concat('MISMATCH - check manually (n=', cast(count(*) as varchar), ', ratio=', cast(min(ratio) as varchar), ')') end as verdict
  from dimensions_fx group by sheet""")
def _verdict(fx):
    g = fx.dimensions_fx.groupBy("sheet").agg(F.count("*").alias("n"), F.min("ratio").alias("r"))
    return g.select("sheet", "n", tx.verdict_text(F.when(F.col("n") < 150, "low").otherwise("high"),
                                                  F.col("n"), F.col("r")).alias("verdict"))
