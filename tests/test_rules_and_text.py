"""Verdict rules one step below, at and above each limit, with nulls; survey numbers; metrics by counting."""

import pytest
from pyspark.sql import functions as F

from plotloom.functions import text as tx
from plotloom.operators import evaluation as ev
from plotloom.operators import rules

STATUS = ("id string, method string, contradictions int, printed_far_n int, side_bad int, boundary_rms_m double, ambiguous int, anchor_rms_m double, "
          "share double, observable int, support_m double, support_next_m double, n_neighbours int, anchor_partners int")
NAMES = [c.split()[0] for c in STATUS.split(", ")]
#: A parcel that is green by its neighbours: nothing against it, fit within its anchors, decisive support.
SOUND = dict(method="anchors", contradictions=0, printed_far_n=0, boundary_rms_m=0.5, anchor_rms_m=0.5, share=0.1, observable=0, ambiguous=0,
             support_m=50.0, support_next_m=10.0, n_neighbours=rules.GREEN_MIN_NEIGHBOURS, anchor_partners=1)


def colours(spark, changes):
    rows = [dict(SOUND, **c) for c in changes]
    df = spark.createDataFrame([("%04d" % k, *(r.get(n) for n in NAMES[1:])) for k, r in enumerate(rows)], STATUS)
    cols = {n: F.col(n) for n in NAMES}
    return [r.c for r in df.withColumn("c", rules.colour_verdict(cols)).orderBy("id").select("c").collect()]


LIMITS = [
    ("contradictions", [(0, "green"), (1, "amber"), (2, "red"), (3, "red")]),
    ("boundary_rms_m", [(0.5 + rules.SIGMA_AUTO - 0.001, "green"), (0.5 + rules.SIGMA_AUTO + 0.001, "red"), (rules.MAX_RESIDUAL_M + 0.001, "red"), (None, "red")]),
    ("support_next_m", [(50 * rules.SUPPORT_MARGIN - 0.01, "green"), (50 * rules.SUPPORT_MARGIN + 0.01, "amber"), (None, "green")]),
    ("support_m", [(0.0, "amber"), (None, "amber")]),
    ("n_neighbours", [(rules.GREEN_MIN_NEIGHBOURS - 1, "amber"), (1, "red"), (0, "red"), (None, "red")]),
    ("anchor_partners", [(0, "amber"), (1, "green"), (None, "green")]),
    ("method", [("puvi-only", "red"), (None, "green")]),
    ("ambiguous", [(1, "green"), (None, "green")]),
]


@pytest.mark.parametrize("name,cases", LIMITS, ids=[n for n, _ in LIMITS])
def test_colour_around_a_limit(spark, name, cases):
    assert colours(spark, [{name: v} for v, _ in cases]) == [c for _, c in cases]


def test_colour_by_imagery_alone(spark):
    seen = dict(observable=1, boundary_rms_m=None, support_m=None)
    shares = [rules.GREEN_SHARE, rules.AMBER_SHARE, rules.AMBER_SHARE - 0.001, None]
    assert colours(spark, [dict(seen, share=s) for s in shares]) == ["amber", "amber", "red", "red"]
    strong = dict(observable=1, support_m=None, n_neighbours=2)
    assert colours(spark, [dict(strong, share=rules.GREEN_SHARE), dict(strong, share=rules.GREEN_SHARE - 0.001), dict(strong, share=1.0, observable=None)]) == ["green", "amber", "amber"]


def test_printed_names_count_where_contradictions_are_unknown(spark):
    unknown = dict(contradictions=None)
    cases = [dict(printed_far_n=None, side_bad=None), dict(printed_far_n=None, side_bad=1), dict(printed_far_n=None, side_bad=2), dict(printed_far_n=1, side_bad=None), dict(printed_far_n=1, side_bad=1)]
    assert colours(spark, [dict(unknown, **c) for c in cases]) == ["green", "amber", "red", "amber", "red"]


def test_survey_numbers(spark):
    cases = [("S.No 311", "311"), ("  77C ", "77C"), ("208/2B", "208"), ("V.No. 9 Somewhere", None), ("Canal", None), ("", None), (None, None)]
    d = spark.createDataFrame([(k, s) for k, (s, _) in enumerate(cases)], "k int, s string")
    assert [r.n for r in d.select("k", tx.normalise_survey(F.col("s")).alias("n")).orderBy("k").collect()] == [n for _, n in cases]
    order = ["2", "11", "11A", "11B", "20A", "100"]
    o = spark.createDataFrame([(s,) for s in sorted(order, reverse=True)], "s string").orderBy(tx.survey_order(F.col("s")), "s")
    assert [r.s for r in o.collect()] == order


def result_rows(spark):
    """Two villages: errors 0.5, 1.0, ... per colour in turn; every seventh row is backfilled, every fifth has no label."""
    colour = ("green", "amber", "red")
    rows = [("PQ"[k % 2], str(k), colour[k % 3], 0.5 + k / 2, 0.5 + k / 2, None if k % 5 == 4 else int(0.5 + k / 2 <= 3), "<=5%" if k % 4 else "5-10%", int(k % 7 == 6),
             "no placed neighbour" if k == 9 else "") for k in range(20)]
    d = spark.createDataFrame(rows, "village string, survey string, colour string, err_fmb_m double, err_hand_m double, within_3m int, stretch_band string, backfilled int, notes string")
    return rows, d.withColumns({"run_id": F.lit("r"), "stretched": F.lit(0)})


def test_comparison_table_by_counting(spark):
    rows, d = result_rows(spark)
    got = {(r.village, r.row_set): r for r in ev.comparison_table(d).collect()}
    for village in "PQ":
        for name, own in ((ev.ALL_ROWS, lambda r: True), (ev.CURRENT, lambda r: not r[7]), (ev.BAND_FREE, lambda r: not r[7] and r[6] == "<=5%")):
            mine = [r for r in rows if r[0] == village and own(r)]
            known = [r for r in mine if r[5] is not None]
            g = got[village, name]
            assert (g.rows, g.labelled, g.green) == (len(mine), len(known), sum(r[2] == "green" for r in known)), (village, name)


def test_worst_rows_by_sorting(spark):
    rows, d = result_rows(spark)
    want = sorted((r for r in rows if not r[7]), key=lambda r: -r[3])[:10]
    got = ev.worst10(d).collect()
    assert [(r.village, r.survey) for r in got] == [(r[0], r[1]) for r in want]
    assert {r.survey: r.cause for r in got}["9"] != {r.survey: r.cause for r in got}["19"]
    assert ev.worst10(d, include_backfilled=True).count() == 10
