"""Survey-shaped tables derived from the base tables, in SQL that Spark and DuckDB both read.

Coordinates are built from integers and dyadic fractions, so both engines hold the same doubles
before any operator runs. Casts to double come before divisions on purpose: a decimal literal
would make Spark divide in DECIMAL.
"""

import re

BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations").split()


def _corner(c: str, r: str) -> tuple[str, str]:
    x = f"(cast(40*({c}) as double) + cast((7*({c})+13*({r}))%9-4 as double)/8)"
    y = f"(cast(25*({r}) as double) + cast((11*({c})+5*({r}))%7-3 as double)/8)"
    return x, y


def _lattice() -> str:
    corners = [("c", "r"), ("c+1", "r"), ("c+1", "r+1"), ("c", "r+1")]
    xy = ", ".join(f"{_corner(*k)[0]} as x{n}, {_corner(*k)[1]} as y{n}" for n, k in enumerate(corners, 1))
    return f"""
      select i, c, r, cast(cast(floor(r/10.0) as int) as string) as village,
             cast(cast(floor(i/4.0) as int) as string) as survey, i%4+1 as poly_id,
             case when p_size%10=0 then null else cast(p_size as string) end as plot_no, p_size, {xy}
      from (select cast(p_partkey as int) as i, cast(p_partkey%50 as int) as c,
                   cast(floor(p_partkey/50.0) as int) as r, p_size from part) g"""


def _edges() -> str:
    def side(kind, c, r):
        return f"select '{kind}' as kind, {c} as ec, {r} as er, i, p_size, village from lattice_fx"
    sides = " union all ".join([side("h", "c", "r"), side("v", "c+1", "r"), side("h", "c", "r+1"), side("v", "c", "r")])
    x0, y0 = _corner("ec", "er")
    xh, yh = _corner("ec+1", "er")
    xv, yv = _corner("ec", "er+1")
    return f"""
      select kind, ec, er, concat(kind, '-', cast(ec as string), '-', cast(er as string)) as edge_id,
             {x0} as ax, {y0} as ay,
             case when kind='h' then {xh} else {xv} end as bx,
             case when kind='h' then {yh} else {yv} end as b_y,
             village, p_size, n_owners,
             case when n_villages>1 or n_owners=1 then 2.0e0 else 0.5e0 end as width,
             case when p_size%7=0 then 6 else 0 end as dash_n,
             case when p_size%11=0 then 1 else 0 end as is_blue
      from (select kind, ec, er, min(village) as village, min(p_size) as p_size,
                   count(*) as n_owners, count(distinct village) as n_villages
            from ({sides}) s group by kind, ec, er) e"""


def _ring_vertices() -> str:
    outer = " union all ".join(
        f"select village, survey, poly_id, i, 0 as ring_no, {n - 1} as seq, x{n} as x, y{n} as y from lattice_fx"
        for n in (1, 2, 3, 4))
    hx = [("15", "10"), ("15", "15"), ("25", "15"), ("25", "10")]
    hole = " union all ".join(
        f"select village, survey, poly_id, i, 1 as ring_no, {n} as seq, cast(40*c+{x} as double) as x, "
        f"cast(25*r+{y} as double) as y from lattice_fx where i%5=0" for n, (x, y) in enumerate(hx))
    return outer + " union all " + hole


DERIVED: dict[str, str] = {
    "lattice_fx": _lattice(),
    "ring_vertices_fx": _ring_vertices(),
    "lattice_edges_fx": _edges(),
    # one sheet per survey: its four plots' edges, a dangle per supplier, a diagonal per nation
    "sheet_segments_fx": f"""
      select survey as sheet, concat('h-', cast(cc as string), '-', cast(rr as string)) as seg_id,
             {_corner('cc', 'rr')[0]} as ax, {_corner('cc', 'rr')[1]} as ay,
             {_corner('cc+1', 'rr')[0]} as bx, {_corner('cc+1', 'rr')[1]} as b_y
      from (select distinct survey, c as cc, r as rr from lattice_fx
            union select distinct survey, c as cc, r+1 as rr from lattice_fx) h
      union all
      select survey, concat('v-', cast(cc as string), '-', cast(rr as string)),
             {_corner('cc', 'rr')[0]}, {_corner('cc', 'rr')[1]},
             {_corner('cc', 'rr+1')[0]}, {_corner('cc', 'rr+1')[1]}
      from (select distinct survey, c as cc, r as rr from lattice_fx
            union select distinct survey, c+1 as cc, r as rr from lattice_fx) v
      union all
      select survey, concat('dangle-', cast(s_suppkey as string)), x1, y1, x1+3, y1+4
      from supplier join lattice_fx on i = s_suppkey*17
      union all
      select survey, concat('diag-', cast(n_nationkey as string)), x1, y1, x3, y3
      from nation join lattice_fx on i = n_nationkey*40+3""",
    "crossing_segments_fx": """
      select * from sheet_segments_fx
      union all select survey, concat('mid-', cast(i as string)), x1+(x2-x1)/4, y1+(y2-y1)/4, x4+(x3-x4)/4, y4+(y3-y4)/4 from lattice_fx
      union all select survey, concat('back-', cast(i as string)), x2, y2, x4, y4 from lattice_fx""",
    "label_points_fx": """
      select i as label_id, village, cast(p_size as string) as label,
             cast(40*c+(i*7)%40 as double) as x, cast(25*r+(i*5)%25 as double) as y from lattice_fx
      union all
      select 1000000+i, village, cast(p_size as string),
             cast(40*c+5 as double) + 0.5e0, cast(25*r+20 as double) + 0.25e0 from lattice_fx where p_size%3=0
      union all
      select 2000000+i, village, 'far', cast(-40*c-100 as double), cast(25*r as double) from lattice_fx where p_size%13=0""",
    # imagery-like edges: the lattice edges moved by up to half a metre
    "features_fx": """
      select edge_id, village, ax + cast((ec+er)%9-4 as double)/8 as ax, ay + cast((ec*3+er)%9-4 as double)/8 as ay,
             bx + cast((ec+er)%9-4 as double)/8 as bx, b_y + cast((ec*3+er)%9-4 as double)/8 as b_y
      from lattice_edges_fx""",
    "control_points_fx": """
      select cast(l_suppkey as string) as survey, l_orderkey, l_partkey, l_linenumber,
             l_quantity*4 as sx, l_linenumber*10 + l_discount*100 as sy,
             cast((l_suppkey*37)%360 as double) as true_theta,
             cos(radians(cast((l_suppkey*37)%360 as double)))*(l_quantity*4)
               - sin(radians(cast((l_suppkey*37)%360 as double)))*(l_linenumber*10+l_discount*100)
               + cast(392000+8*l_suppkey as double) + cast(l_orderkey%7-3 as double)/8 as mx,
             sin(radians(cast((l_suppkey*37)%360 as double)))*(l_quantity*4)
               + cos(radians(cast((l_suppkey*37)%360 as double)))*(l_linenumber*10+l_discount*100)
               + cast(1413000+4*l_suppkey as double) + cast(l_partkey%5-2 as double)/8 as my,
             case when l_returnflag='N' then '0' else '1' end as enable
      from lineitem""",
    "poses_fx": """
      select village, survey, cast((cast(survey as int)*37)%360 as double) as theta,
             cast(392000+8*cast(survey as int) as double) as tx,
             cast(1413000+4*cast(survey as int) as double) as ty,
             cast(cast(survey as int)%16 as double)/32 as rms
      from (select distinct village, survey from lattice_fx) s""",
    # almost where the grid has them: small turns and shifts, for jobs that need real neighbours
    "near_poses_fx": """
      select village, survey, cast(cast(survey as int)%5-2 as double)/64 as theta,
             cast(cast(survey as int)%9-4 as double)/8 as tx, cast(cast(survey as int)%7-3 as double)/8 as ty,
             cast(cast(survey as int)%16 as double)/32 as rms
      from (select distinct village, survey from lattice_fx) s""",
    "rows_fx": """
      select village, survey, run_id, colour, err_fmb_m, err_hand_m, stretched, disputed, backfilled, stretch_band,
             case when stretched=1 or disputed=1 then null when err_fmb_m<=3 then 1 else 0 end as within_3m, notes
      from (select cast(c_nationkey as string) as village, cast(o_orderkey as string) as survey,
                   o_orderpriority as run_id,
                   case when o_orderstatus='F' then 'green' when o_orderstatus='O' then 'amber' else 'red' end as colour,
                   cast((o_orderkey*31)%2048 as double)/128 as err_fmb_m,
                   cast((o_orderkey*31)%2048 as double)/128 + cast(o_custkey%9 as double)/8 as err_hand_m,
                   case when o_orderkey%11=0 then 1 else 0 end as stretched,
                   case when o_orderkey%17=0 then 1 else 0 end as disputed,
                   case when o_orderkey%13=0 then 1 else 0 end as backfilled,
                   case when o_orderkey%3=0 then '<=5%' when o_orderkey%3=1 then '5-10%' else '>10%' end as stretch_band,
                   case o_orderkey%8 when 0 then 'neighbour support 120 m, next best 118 m'
                     when 1 then '2 printed side(s) contradicted' when 2 then 'does not reach printed neighbour(s) 40A'
                     when 3 then 'clipped against Railway land 171' when 4 then 'outside the satellite window'
                     when 5 then 'topology: conform max 0.41 m,clipped' when 6 then ''
                     else 'No placed neighbour shares a boundary' end as notes
            from orders join customer on o_custkey=c_custkey) o""",
    "log_fx": """
      select cast(user_id as string) as giscode, event_id as pos, ts,
             case when event_type='purchase' then 'saved' else event_type end as status, props as api_error
      from events""",
    "status_fx": """
      select concat(cast(l_suppkey as string),'/',cast(l_partkey as string),'/',cast(l_orderkey as string),'/',
                    cast(l_linenumber as string)) as id,
             cast(l_suppkey%20 as string) as village,
             concat(cast(l_partkey as string), case l_partkey%4 when 0 then '' when 1 then 'A' when 2 then 'B' else 'C' end) as survey,
             case when l_orderkey%29=0 then 'puvi-only' when l_orderkey%3=0 then 'image' else 'anchors' end as method,
             l_quantity*8 as support_m, l_quantity*8*(cast(l_partkey%5 as double)/4) as support_next_m,
             case when l_orderkey%5=0 then null else cast(l_orderkey%64 as double)/8 end as boundary_rms_m,
             l_linenumber%5 as n_neighbours, cast(l_partkey%128 as double)/128 as share,
             case when l_orderkey%3=0 then 'False' when l_orderkey%3=1 then 'True' else '' end as observable,
             case when l_partkey%4=0 then 'true' when l_partkey%4=1 then '0' else '' end as ambiguous,
             case when l_partkey%7<5 then null else l_partkey%7-4 end as side_bad,
             case l_suppkey%5 when 0 then '' when 1 then '40A' when 2 then '40A,42,,9' when 3 then '7,' end as printed_far,
             case when l_suppkey%3=0 then null else l_partkey%3 end as contradictions,
             cast(l_suppkey%8 as double)/4 as anchor_rms_m,
             case when l_orderkey%4=0 then null else l_orderkey%4-1 end as anchor_partners,
             case when l_suppkey%5=0 then null when l_suppkey%5=1 then '' when l_suppkey%5=2 then '41,42A' else '9,,10,' end as neighbours,
             concat(cast(l_quantity as string), case l_linenumber%3 when 0 then '' when 1 then 'x' else '0' end) as raw_num,
             l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity
      from lineitem""",
    "candidates_fx": """
      select cast(l_orderkey%500 as string) as survey, l_orderkey, l_linenumber, l_partkey, l_suppkey,
             cast(l_partkey%360 as double) as theta, cast(l_suppkey*2 as double) as land_x,
             cast(l_linenumber*3 as double) as land_y, l_quantity as support,
             l_linenumber%3 as contradictions, l_partkey%4 as sides_ok, l_orderkey%6 as partners
      from lineitem""",
    "neighbours_fx": """
      select cast(l_suppkey%10 as string) as village, cast(l_suppkey as string) as survey,
             l_orderkey, l_linenumber, l_partkey,
             case l_linenumber%4 when 0 then concat(cast(n as string),'/5A') when 1 then concat('S.No ',cast(n as string))
               when 2 then concat('V.No. ',cast(n as string)) else concat(' ', cast(n as string)) end as number,
             case l_partkey%9 when 0 then 'N' when 1 then 'NE' when 2 then 'E' when 3 then 'SE' when 4 then 'S'
               when 5 then 'sw' when 6 then 'W' when 7 then 'NW' else 'left' end as side,
             1+l_orderkey%2 as readers,
             case l_returnflag when 'A' then 'high' when 'N' then 'low' else 'medium' end as confidence
      from (select l.*, l_partkey % 100 as n from lineitem l) l""",
    "files_fx": """
      select concat('35_', case when o_custkey%20<5 then '04' when o_custkey%20<10 then '05' else '15' end, '_',
                    cast(100+o_custkey%20 as string)) as village,
             cast(o_orderkey%700 as string) as base,
             concat(cast(o_orderkey%700 as string), case o_orderkey%4 when 0 then '' when 1 then 'A' when 2 then '' else 'B' end) as unit,
             concat(cast(o_orderkey%700 as string), case when o_orderkey%5=0 then '_s2000' when o_orderkey%5=1 then '_s1000' else '' end) as stem,
             o_orderdate as mtime, o_totalprice as size, o_orderkey
      from orders""",
    "batch_fx": """
      select case when k%20<5 then '4' when k%20<10 then '05' else '15' end as taluk, cast(100+k%20 as string) as village,
             concat('Village ', cast(k%20 as string)) as village_name, cast(floor(k/20.0) as int) as survey_n,
             cast(cast(floor(k/20.0) as int) as string) as survey_no,
             case k%3 when 0 then concat(cast(cast(floor(k/20.0) as int) as string), 'A; ', cast(cast(floor(k/20.0) as int) as string), ' B')
               when 1 then cast(cast(floor(k/20.0) as int) as string) else '' end as vector_pieces
      from (select distinct o_orderkey as k from orders) o""",
    "diameters_fx": """
      select cast(l_suppkey as string) as sheet,
             2 + cast(case when l_partkey%40<14 then l_partkey%40 when l_partkey%40<27 then l_partkey%40+9 else l_partkey%40+24 end as double)/8 as d
      from lineitem""",
    "dimensions_fx": """
      select cast(l_orderkey%300 as string) as sheet, l_orderkey, l_linenumber, l_partkey, l_suppkey,
             (1 + cast(l_partkey%17-8 as double)/128) * case (l_orderkey%300)%3 when 0 then 1 when 1 then 2 else 4 end as ratio
      from lineitem""",
    "notes_fx": """
      select doc_id, case doc_id%9 when 0 then concat('CONTRADICTED by ', source) when 1 then concat('does not reach printed ', lang)
               when 2 then 'no placed neighbour' when 3 then concat('outside the satellite window | ', lang)
               when 4 then concat('next best 40 m | ', source) when 5 then concat('Railway ', lang)
               when 6 then concat('base note | topology: clipped,conform max 0.', cast(doc_id%90+10 as string), ' m')
               when 7 then '' else concat('backfilled from ', source) end as notes, source, lang, text
      from documents""",
    "download_log_fx": """
      select concat('S35', case when user_id%20<5 then '04' when user_id%20<10 then '05' else '15' end,
                    cast(100+user_id%20 as string), cast((event_id*7)%750 as string),
                    case event_id%5 when 0 then 'A' when 1 then 'C' when 2 then 'F' when 3 then 'G' else '' end) as giscode,
             event_id as pos, case when event_type='purchase' then 'saved' else event_type end as status, props as api_error
      from events""",
    "attr_plots_fx": """
      select case when cast(village as int)%3=2 then '35_09_001' else concat('35_0', cast(4+cast(village as int)%2 as string), '_', lpad(village, 3, '0')) end as village_code,
             case when i%8<4 then survey else concat(survey, case poly_id when 1 then 'A' when 2 then 'B_s1000' when 3 then 'C' else 'D_s2000' end) end as stem,
             i, poly_id, plot_no, p_size, cast(1000+i%77 as double)/8 as area_sqm, case when i%10=0 then 1 else 0 end as review
      from lattice_fx""",
    "sheet_areas_fx": """
      select village, unit, o_orderkey, case when o_orderkey%9=0 then null else cast(o_orderkey%4096 as double)/4 end as area,
             cast(o_orderkey%1000 as double)/8 as cx, cast(o_orderkey%777 as double)/8 as cy
      from files_fx join (select o_orderkey as ok from orders) o on ok=o_orderkey""",
    "independent_fx": """
      select village, ukey, min(area) as area, min(cx) as cx, min(cy) as cy
      from (select village, case when o_orderkey%3>0 then concat('none-', cast(o_orderkey as string)) when o_orderkey%2=0 then unit else base end as ukey, cast(o_orderkey%2048+1 as double)/2 as area,
                   cast(o_orderkey%900 as double)/8 as cx, cast(o_orderkey%888 as double)/8 as cy from files_fx) k
      group by village, ukey""",
    "scale_table_fx": """
      select village, case when o_orderkey%6=0 then base else concat('none-', cast(o_orderkey as string)) end as survey_no, min(case o_orderkey%4 when 0 then 500 when 1 then 800 when 2 then 1000 else 2000 end) as scale
      from files_fx group by 1, 2""",
    "path_ops_fx": """
      select i, 1 as k, 'm' as op, x1 as px, y1 as py, x1 as qx, y1 as qy from lattice_fx
      union all select i, 2, 'l', x2, y2, x2, y2 from lattice_fx
      union all select i, 3, case when i%2=0 then 'v' else 'l' end, x3, y3, x3+4, y3+2 from lattice_fx
      union all select i, 4, 'v', x4-1, y4+3, x4, y4 from lattice_fx
      union all select i, 5, 'h', x1, y1, x1, y1 from lattice_fx""",
    "segments_raw_fx": """
      select cast(k%200 as string) as sheet_id, k*100000000 + l_partkey*10000 + l_suppkey*10 + l_linenumber as seg_id,
             case when k%2=0 then cast(2527.5 as double) else cast(1263 as double) end as page_w,
             case when k%2=0 then cast(3370 as double) else cast(1685 as double) end as page_h,
             cast((l_partkey*13)%1250 as double) as x0, cast((l_suppkey*17 + l_linenumber*191)%1680 as double) as y0,
             cast((l_partkey*13)%1250 + case when l_suppkey%5=0 then 0 else l_suppkey*7-200 end as double) as x1,
             cast((l_suppkey*17 + l_linenumber*191)%1680 + case when l_suppkey%7<2 then 0 else l_partkey%300-100 end as double) as y1,
             case l_linenumber when 5 then 0.0e0 when 6 then 0.5e0 else 0.0e0 end as red,
             case l_linenumber when 6 then 0.5e0 else 0.0e0 end as green,
             case l_linenumber when 5 then 1.0e0 when 6 then 0.5e0 else 0.0e0 end as blue,
             case when l_linenumber=7 then null else cast(l_partkey%5 as double)/2 end as linewidth,
             case k%4 when 0 then '' when 1 then '3,0' when 2 then '3,2' else '4,1,2,1,2,1' end as dash
      from (select *, l_orderkey as k from lineitem) l""",
    "printed_fx": """
      select village, survey, cast(other as string) as number, side, 2 as readers, 'high' as confidence, cast(other as int) as pos
      from (select distinct a.village, a.survey, b.survey as other,
                   case when b.r>a.r then 'N' when b.r<a.r then 'S' when b.c>a.c then 'E' else 'W' end as side
            from lattice_fx a join (select village, survey, r-1 as jr, c as jc, r, c from lattice_fx union all
                  select village, survey, r+1, c, r, c from lattice_fx union all select village, survey, r, c-1, r, c from lattice_fx
                  union all select village, survey, r, c+1, r, c from lattice_fx) b
              on b.village=a.village and b.jr=a.r and b.jc=a.c where a.survey<>b.survey) p""",
    "text_runs_fx": """
      select village as sheet, i*10+1 as run_id, cast(p_size as string) as txt, cast(40*c+4 as double) as x0, cast(40*c+8 as double) as x1,
             cast(25*r+10 as double) as cy, 4.0e0 as gd, cast((i%5-2)*3 as double) as ang from lattice_fx
      union all select village, i*10+2, cast(i%10 as string), cast(40*c+12 as double), cast(40*c+14 as double), cast(25*r+10 as double),
             4.0e0, cast((i%7-3)*2 as double) from lattice_fx where i%9<>0
      union all select village, i*10+3, '7', cast(40*c+5 as double), cast(40*c+7 as double), cast(25*r+11 as double), 4.0e0, 0.0e0 from lattice_fx where i%6=0""",
    "dots_fx": """
      select village as sheet, i as dot_id, cast(40*c+10 as double) as dx, cast(25*r+10 as double) + cast(i%3 as double)/4 as dy from lattice_fx""",
    "dim_text_fx": """
      select village as sheet, label_id as dim_id, x as px, y as py, cast(1+label_id%6 as double) as gd, cast((label_id*23)%360-180 as double) as ang from label_points_fx""",
    "glyphs_fx": """
      select vec_id as glyph_id, embedding, 0.25e0 + cast(vec_id%8 as double)/8 as ar, cast(label as string) as ch,
             cast(floor(vec_id/4.0) as int) as run_id, cast((vec_id%4)*8 as double) as cx, cast((vec_id*7)%3 as double)/8 as cy from embeddings""",
    # one sheet per plot on a grid whose corners are moved by up to six metres, so that no two boundaries are alike
    "village_fx": """
      select i, c, r, cast(cast(floor(r/10.0) as int) as string) as village, cast(i as string) as survey,
             cast(40*(c) as double) + cast(((7919)*(c)+(104729)*(r)+31*(c)*(r))%97-48 as double)/8 as x1, cast(25*(r) as double) + cast(((6101)*(c)+(15485)*(r)+53*(c)*(r))%97-48 as double)/8 as y1,
             cast(40*(c+1) as double) + cast(((7919)*(c+1)+(104729)*(r)+31*(c+1)*(r))%97-48 as double)/8 as x2, cast(25*(r) as double) + cast(((6101)*(c+1)+(15485)*(r)+53*(c+1)*(r))%97-48 as double)/8 as y2,
             cast(40*(c+1) as double) + cast(((7919)*(c+1)+(104729)*(r+1)+31*(c+1)*(r+1))%97-48 as double)/8 as x3, cast(25*(r+1) as double) + cast(((6101)*(c+1)+(15485)*(r+1)+53*(c+1)*(r+1))%97-48 as double)/8 as y3,
             cast(40*(c) as double) + cast(((7919)*(c)+(104729)*(r+1)+31*(c)*(r+1))%97-48 as double)/8 as x4, cast(25*(r+1) as double) + cast(((6101)*(c)+(15485)*(r+1)+53*(c)*(r+1))%97-48 as double)/8 as y4,
             cast((i*47)%360 as double) as turn, case when i%10=3 then 1 else 0 end as anchored
      from lattice_fx""",
    # two raw readings per (sheet, neighbour number)
    "readings_fx": """
      select cast(l_suppkey as string) as sheet, cast(l_partkey%40 as string) as number,
             case l_quantity when 1 then '' else case cast(l_quantity as int)%4 when 0 then 'n' when 1 then 'E' when 2 then 'S' else 'W' end end as side,
             concat('reader', cast(l_linenumber%3 as string)) as reader,
             case when l_returnflag='A' then 'high' else 'low' end as confidence
      from lineitem""",
}


def names_in(text: str) -> list[str]:
    known = list(DERIVED) + BASE
    return [n for n in known if re.search(rf"(?<![\w.']){n}(?![\w'])", text)]


def with_derivations(sql: str) -> str:
    """Prefix an oracle with the derivations it names, as common table expressions."""
    needed: list[str] = []

    def visit(name):
        if name in DERIVED and name not in needed:
            for d in names_in(DERIVED[name]):
                if d != name:
                    visit(d)
            needed.append(name)
    for n in names_in(sql):
        visit(n)
    body = sql.strip()
    recursive = bool(re.match(r"with\s+recursive\b", body, re.I))
    rest = re.sub(r"^with(\s+recursive)?\s+", "", body, flags=re.I) if re.match(r"with\b", body, re.I) else None
    ctes = ",\n".join(f"{n} as materialized ({DERIVED[n].strip()})" for n in needed)
    if not ctes:
        return body
    head = "with recursive " if recursive else "with "
    return f"{head}{ctes}{', ' + rest if rest is not None else ' ' + body}"
