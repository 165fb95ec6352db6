"""Labels, errors, per-village metrics, folds and work lists."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom import schemas
from plotloom.functions import text as tx
from plotloom.operators import rules

# The three overlapping row sets of the comparison table.
CURRENT, BAND_FREE, ALL_ROWS = ("current code, all labelled", "current code, without 5-10 % tier",
                                "all rows incl. backfilled")


def is_labelled() -> Column:
    return F.coalesce(F.col("within_3m").isin(0, 1), F.lit(False))


def _percent(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(num * 100.0, den), 1)


def metrics(rows: DataFrame, keys: list[str], weights: list[str] | None = None) -> DataFrame:
    """Counts, rates and error quantiles per key.

    Rows are first collapsed to small cells: counts per (key, marker) and value counts of the errors.
    ``weights`` names marker columns holding arrays of extra key values (row sets); they are unfolded
    after the collapse, so overlapping row sets do not multiply the input.
    """
    keys = list(keys)
    marker = list(weights or [])
    lab, within = is_labelled(), F.col("within_3m")

    def n(cond):
        return F.count_if(F.coalesce(cond, F.lit(False)))
    cells = rows.groupBy(*keys, *marker).agg(
        F.count("*").alias("rows"), n(lab).alias("labelled"), n(lab & (within == 1)).alias("w"),
        n(lab & (F.col("colour") == "green")).alias("green"),
        n(lab & (F.col("colour") == "green") & (within == 1)).alias("gw"),
        n(lab & (F.col("colour") == "red")).alias("red"),
        n(lab & (F.col("colour") == "red") & (within == 0)).alias("rb"),
        n(lab & (within == 1) & F.col("colour").isin("green", "amber")).alias("gaw"))
    errs = rows.select(*keys, *marker, F.explode(F.array(
        F.struct(F.lit("fmb").alias("k"), F.col("err_fmb_m").alias("v")),
        F.struct(F.lit("hand").alias("k"), F.col("err_hand_m").alias("v")))).alias("e")).select(
        *keys, *marker, "e.k", "e.v").filter("v is not null").groupBy(*keys, *marker, "k", "v").agg(F.count("*").alias("c"))
    for m in marker:
        cells, errs = cells.withColumn(m, F.explode(m)), errs.withColumn(m, F.explode(m))
    group = keys + marker
    sums = cells.groupBy(*group).agg(*[F.sum(c).alias(c) for c in
                                       ("rows", "labelled", "w", "green", "gw", "red", "rb", "gaw")])

    def q(kind, p):
        return F.round(F.percentile(F.when(F.col("k") == kind, F.col("v")), p, F.col("c")), 2)
    quant = errs.groupBy(*group).agg(
        q("fmb", 0.5).alias("err_fmb_median_m"), q("fmb", 0.9).alias("err_fmb_p90_m"),
        q("hand", 0.5).alias("err_hand_median_m"), q("hand", 0.9).alias("err_hand_p90_m"))
    joined = sums.join(quant, group, "left") if group else sums.join(quant, how="left")
    return joined.select(
        *group, "rows", "labelled", _percent(F.col("w"), F.col("labelled")).alias("within_pct"), "green",
        _percent(F.col("gw"), F.col("green")).alias("green_within_pct"), "red",
        _percent(F.col("rb"), F.col("red")).alias("red_beyond_pct"),
        _percent(F.col("gaw"), F.col("w")).alias("recall_green_amber_pct"),
        "err_fmb_median_m", "err_fmb_p90_m", "err_hand_median_m", "err_hand_p90_m")


def current_rows() -> Column:
    return F.coalesce(F.col("backfilled"), F.lit(0)) == 0


def comparison_table(rows: DataFrame) -> DataFrame:
    """One line per village and row set; a second ``candidate`` line where rows carry ``p_within``."""
    middle = F.coalesce(F.col("stretch_band").startswith("5-"), F.lit(False))
    sets = F.filter(F.array(F.when(current_rows(), CURRENT), F.when(current_rows() & ~middle, BAND_FREE), F.lit(ALL_ROWS)),
                    lambda s: s.isNotNull())
    marked = rows.withColumn("row_set", sets)
    table = metrics(marked, ["village"], ["row_set"])
    out = table.withColumn("method", F.lit("rule-based"))
    if "p_within" in rows.columns:
        scored = (marked.filter(F.col("p_within").isNotNull()).select("village", "row_set").distinct()
                  .withColumn("row_set", F.explode("row_set")).distinct())
        out = out.unionByName(table.join(scored, ["village", "row_set"], "left_semi").withColumn("method", F.lit("candidate")))
    return out


def worst10(rows: DataFrame, include_backfilled: bool = False, n: int = 10) -> DataFrame:
    kept = rows if include_backfilled else rows.filter(current_rows())
    return (kept.filter("err_fmb_m is not null")
            .orderBy(F.desc("err_fmb_m"), "village", "survey", "run_id").limit(n)
            .select("village", "survey", "run_id", "err_fmb_m", "err_hand_m", "colour", "stretched",
                    tx.cause_of_error(F.col("notes")).alias("cause")))


def split_by_village(rows: DataFrame, village: str) -> DataFrame:
    return rows.withColumn("part", F.when(F.col("village") == village, "test").otherwise("train"))


def fold_sizes(rows: DataFrame) -> DataFrame:
    """Leave-one-village-out, one line per fold; the train side is the total minus the village's own part."""
    own = rows.groupBy("village").agg(F.count("*").alias("test_rows"), F.count_if(is_labelled()).alias("test_labelled"),
                                      F.sum("within_3m").alias("test_within"))
    total = own.agg(F.sum("test_rows").alias("_r"), F.sum("test_labelled").alias("_l"), F.sum("test_within").alias("_w"))
    return (own.filter("test_labelled > 0").join(F.broadcast(total))       # one row, whatever the data
            .select(F.col("village").alias("fold"), "test_rows", "test_labelled", "test_within",
                    (F.col("_r") - F.col("test_rows")).alias("train_rows"),
                    (F.col("_l") - F.col("test_labelled")).alias("train_labelled"),
                    (F.col("_w") - F.coalesce("test_within", F.lit(0))).alias("train_within")))


def hide_survey(inputs: DataFrame, village: str, hidden: str) -> DataFrame:
    """The inputs of one leave-one-out run: the hidden survey keeps its sheet and loses its placement."""
    return inputs.filter((F.col("village") == village) & (F.col("survey") != hidden)).withColumn("fold", F.lit(hidden))


def leave_one_out_inputs(inputs: DataFrame, value: str) -> DataFrame:
    """Per hidden survey what is left of its village: counts and totals, by subtraction instead of copies."""
    own = inputs.groupBy("village", "survey").agg(F.count("*").alias("_n"), F.sum(value).alias("_v"))
    whole = own.groupBy("village").agg(F.count("*").alias("_s"), F.sum("_n").alias("_tn"), F.sum("_v").alias("_tv"))
    return own.join(whole, "village").select(
        "village", F.col("survey").alias("fold"), (F.col("_s") - 1).alias("n_surveys"),
        (F.col("_tn") - F.col("_n")).alias("n_inputs"), (F.col("_tv") - F.col("_v")).alias("total"))


def seed_inputs(inputs: DataFrame, seeds: DataFrame) -> DataFrame:
    return inputs.join(seeds.select("village", "survey").distinct(), ["village", "survey"], "left_semi")


def heading_gap(a: Column, b: Column) -> Column:
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def tolerance_per_parcel(t: DataFrame, report_only_rms: float = 3.0) -> DataFrame:
    """Tolerances never tighter than 1.5 m / 1.5 degrees, the counted flag and the pass flag."""
    tol_m, tol_deg = F.greatest(F.lit(1.5), F.col("rms")), F.greatest(F.lit(1.5), F.coalesce("heading_spread", F.lit(0.0)))
    return t.withColumns({"tolerance_m": tol_m, "tolerance_deg": tol_deg, "counted": (F.col("rms") <= report_only_rms).cast("int"),
                          "passed": F.coalesce((F.col("error_m") <= tol_m) & (F.col("error_deg") <= tol_deg), F.lit(False)).cast("int")})


def calibrate_thresholds(rows: DataFrame) -> DataFrame:
    """Green above the best wrong score, amber at the median wrong score, both capped."""
    counted = rows.filter("share_best_wrong is not null").groupBy("share_best_wrong").agg(F.count("*").alias("c"))
    g = counted.agg(F.max("share_best_wrong").alias("hi"), F.percentile("share_best_wrong", 0.5, F.col("c")).alias("mid"))
    green = F.round(F.least(F.coalesce(F.col("hi") + 0.05, F.lit(0.60)), F.lit(0.95)), 3)
    return g.select(green.alias("green_share"), F.round(F.least(F.coalesce("mid", F.lit(0.35)), green - 0.05), 3).alias("amber_share"))


def verdict_counts(status: DataFrame) -> DataFrame:
    return (status.groupBy("village").pivot("colour", ["green", "amber", "red"]).count().na.fill(0))


def latest_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
            .select(*keys, *[F.col("_r")[c].alias(c) for c in rest]))


def worklist(rows: DataFrame, order: list[str]) -> DataFrame:
    """Latest verdict per parcel of the corridor, by village and natural survey order."""
    return (latest_rows(rows, ["village", "survey"], order)
            .orderBy("village", tx.survey_order(F.col("survey")), "survey"))


def batch_totals(sheets: DataFrame) -> DataFrame:
    ok = F.col("status") == "ok"
    polys, numbered = F.sum(F.when(ok, F.col("polygons"))), F.sum(F.when(ok, F.col("numbered")))
    return sheets.agg(F.count("*").alias("sheets"), F.count_if(ok).alias("ok"),
                      F.count_if(F.col("status") == "no-polygons").alias("no_polygons"),
                      F.count_if(F.col("status") == "error").alias("errors"), polys.alias("polygons"),
                      numbered.alias("numbered"), F.round(numbered * 100.0 / F.greatest(polys, F.lit(1)), 0).alias("numbered_pct"))


def feature_rows(status: DataFrame, refs: DataFrame, errors: DataFrame, run: dict[str, str]) -> DataFrame:
    """The evaluation row of every placed parcel: status, reference, errors, label.

    ``status`` may be typed or still text; ``errors`` holds village, survey and the four errors.
    """
    s = status.filter("status = 'placed'") if "status" in status.columns else status

    def text(name):
        return F.col(name).cast("string") if name in s.columns else F.lit(None).cast("string")

    def num(name):
        return tx.lenient_number(text(name))

    def whole(name):
        return tx.lenient_int(text(name)).cast("int")

    def flag(name):
        return tx.lenient_flag(text(name))
    key = ["village", "survey"]
    j = (s.join(refs.withColumn("_has_ref", F.lit(True)), key, "left").join(errors, key, "left"))
    has = F.coalesce(F.col("_has_ref"), F.lit(False))
    sup, nxt = num("support_m"), num("support_next_m")
    notes = F.coalesce(text("notes"), F.lit(""))
    made = {
        **{k: F.lit(run.get(k, "")) for k in ("run_id", "run_at", "tool_git_sha", "mode", "seeds", "imagery_source", "window_sha256")},
        "backfilled": F.lit(int(run.get("backfilled", 0))), "pass_no": whole("pass"),
        "runner_up_ratio": F.when((sup != 0) & nxt.isNotNull(), F.round(nxt / sup, 4)),
        "n_neighbours": tx.list_count(text("neighbours")).cast("int"),
        "printed_far_n": F.coalesce(tx.list_count(text("printed_far")), F.lit(0)).cast("int"),
        "topo_max_move_m": tx.conform_move(notes), "topo_clipped": tx.clipped_flag(notes), "notes": notes,
        "confidence_rule": whole("confidence"),
        "ref_source": F.when(has, F.col("ref_source")).otherwise("none"),
        "within_3m": rules.label_rule(F.col("err_fmb_m"), F.col("stretched"), F.col("disputed"), has),
        **{k: F.coalesce(F.col(k), F.lit("")) for k in ("stretch_band", "stretched_reason", "disputed_reason")},
        **{k: F.coalesce(text(k), F.lit("")) for k in ("method", "colour")},
        **{k: num(k) for k in ("support_m", "support_next_m", "boundary_rms_m", "share", "margin", "sigma_pos_m",
                               "sigma_head_deg", "heading_deg", "pose_tx", "pose_ty")},
        **{k: whole(k) for k in ("n_candidates", "anchor_partners", "side_ok", "side_bad", "contradictions")},
        **{k: flag(k) for k in ("observable", "ambiguous", "in_window")},
    }
    return j.select(*[made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schemas.FEATURE_ROW.fields])


def backfill_rows(old: DataFrame, refs: DataFrame, run: dict[str, str]) -> DataFrame:
    """Old leave-one-out results as feature rows: what they never held stays null, the label is recomputed."""
    errors = old.select("village", "survey", tx.lenient_number(F.col("centroid_error_m").cast("string")).alias("err_fmb_m"),
                        F.lit(None).cast("double").alias("err_hand_m"),
                        tx.lenient_number(F.col("heading_error_deg").cast("string")).alias("heading_err_deg"),
                        F.lit(None).cast("double").alias("max_vertex_err_m"))
    status = old.drop("centroid_error_m", "heading_error_deg")
    return feature_rows(status, refs, errors, dict(run, backfilled=1))
