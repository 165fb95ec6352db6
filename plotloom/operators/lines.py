"""Drawing lines: page furniture, layers, off-page sheets, dimensions and scale."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.functions import geo
from plotloom.operators import cells

REFERENCE_HEIGHT = 3370.0
BOUNDARY_LAYERS = ("survey_boundary_main", "subdivision_line")
# Scales a sheet can be drawn at.
STANDARD_SCALES = (250, 400, 500, 800, 1000, 1250, 2000, 2500, 4000, 5000)


def _rgb(r, g, b) -> Column:
    same = [F.coalesce(F.round(F.col(c), 3), F.lit(0.0)) == v for c, v in zip(("red", "green", "blue"), (r, g, b))]
    return same[0] & same[1] & same[2]


def is_black() -> Column:
    return _rgb(0.0, 0.0, 0.0)


def is_blue() -> Column:
    return _rgb(0.0, 0.0, 1.0)


def is_frame_line() -> Column:
    """Page border, title or footer band; thresholds follow the sheet height. y grows downwards here."""
    w, h = F.col("page_w"), F.col("page_h")
    k = h / REFERENCE_HEIGHT
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    lo, hi, left, right = F.least(y0, y1), F.greatest(y0, y1), F.least(x0, x1), F.greatest(x0, x1)
    band = (hi < k * 150) | (lo > h - k * 150)
    long_one = geo.length(x0, y0, x1, y1) > k * 500
    level = (F.abs(y1 - y0) < 1.0) & ((lo < k * 80) | (hi > h - k * 80))
    upright = (F.abs(x1 - x0) < 1.0) & ((left < k * 80) | (right > w - k * 80))
    return ~(is_black() | is_blue()) | band | (long_one & (level | upright))


def stroke_width() -> Column:
    return F.round(F.coalesce(F.nullif(F.col("linewidth"), F.lit(0.0)), F.lit(1.0)), 1)


def dash_list(text) -> Column:
    return F.when(text == "", F.array().cast("array<double>")).otherwise(F.split(text, ",").cast("array<double>"))


def drop_frame_lines(raw: DataFrame) -> DataFrame:
    return raw.filter(~is_frame_line())


def clip_box(segs: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Segments with both ends inside (x0, x1, y0, y1), y counted from the bottom."""
    x_lo, x_hi, y_lo, y_hi = box

    def inside(x, y):
        return F.col(x).between(x_lo, x_hi) & (F.col("page_h") - F.col(y)).between(y_lo, y_hi)
    return segs.filter(inside("x0", "y0") & inside("x1", "y1"))


def classify_lines(raw: DataFrame, clip: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Layer per line, relative to the heaviest solid black stroke of its sheet; y flipped to bottom-left.

    The heaviest stroke is a grouped maximum joined back, not a window over the sheet.
    """
    lines = drop_frame_lines(raw).withColumns({"lw": stroke_width(), "n_dash": F.size("dash"),
                                               "black": is_black(), "blue_line": is_blue()})
    heavy = lines.groupBy("sheet_id").agg(F.coalesce(F.max(F.when(F.col("black") & (F.col("n_dash") <= 4), F.col("lw"))), F.lit(1.0)).alias("heavy"))
    kept = lines.filter(geo.length(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")) >= 1e-6)
    if clip is not None:
        kept = clip_box(kept, clip)
    layer = (F.when(F.col("n_dash") > 4, "tie_line").when(F.col("blue_line"), "blue_feature_line")
             .when((F.col("heavy") > 1.0) & (F.col("lw") >= F.col("heavy")), BOUNDARY_LAYERS[0]).otherwise(BOUNDARY_LAYERS[1]))
    dashed = (F.col("n_dash") > 1) & (F.coalesce(F.get("dash", F.lit(1)), F.lit(0.0)) != 0)
    return kept.join(heavy, "sheet_id").select(
        "sheet_id", "seg_id", "page_w", "page_h", "x0", (F.col("page_h") - F.col("y0")).alias("y0"), "x1",
        (F.col("page_h") - F.col("y1")).alias("y1"), layer.alias("layer"), "lw", dashed.cast("int").alias("dashed"))


def offpage_sheets(lines: DataFrame) -> DataFrame:
    """Sheets with boundary ends in the margin band (lines as classified, origin bottom-left)."""
    k = F.col("page_h") / REFERENCE_HEIGHT

    def hit(x, y):
        x, y = F.col(x), F.col(y)
        return ((y <= k * 155) | (y >= F.col("page_h") - k * 155) | (x <= k * 60) | (x >= F.col("page_w") - k * 60)).cast("int")
    b = lines.filter(F.col("layer").isin(*BOUNDARY_LAYERS))
    g = b.groupBy("sheet_id").agg(F.sum(hit("x0", "y0") + hit("x1", "y1")).alias("clipped_endpoints"), F.count("*").alias("boundary_segments"))
    return g.filter("clipped_endpoints > 0")


def scale_from_dimensions(ratios: DataFrame, nominal: int = 500) -> DataFrame:
    """Sheet scale from annotated/drawn ratios: nearest standard scale, share in agreement, confidence.

    Ratios are counted per distinct value first; medians and shares use those counts.
    """
    counted = ratios.groupBy("sheet", "ratio").agg(F.count("*").alias("c"))
    med = counted.groupBy("sheet").agg(F.sum("c").alias("n"), F.percentile("ratio", 0.5, F.col("c")).alias("r"))
    rel = F.col("ratio") / F.col("r")
    agree = counted.join(med, "sheet").groupBy("sheet", "n", "r").agg(
        (F.sum(F.when((rel > 0.85) & (rel < 1.15), F.col("c")).otherwise(0)).cast("double") / F.col("n")).alias("agree"))
    options = F.array(*[F.struct(F.abs(F.ln(F.lit(float(s)) / (F.col("r") * nominal))).alias("d"), F.lit(s).alias("s")) for s in STANDARD_SCALES])
    few = F.col("n") < 3
    return agree.select("sheet", "n", F.when(few, nominal).otherwise(F.array_min(options)["s"]).alias("scale"),
                        F.when(~few, F.round("r", 3)).alias("median_ratio"), F.when(~few, F.round("agree", 2)).alias("agree"),
                        F.when(few, "low").when((F.col("agree") >= 0.6) & (F.col("n") >= 5), "high").otherwise("medium").alias("confidence"))


def nearest_parallel_segment(dims: DataFrame, segs: DataFrame, cell: float, max_deg: float = 12.0, reach: float = 2.5) -> DataFrame:
    """Drawn length for each dimension text: the nearest segment running along it.

    ``dims``: sheet, dim_id, px, py, gd, ang. ``segs``: sheet, seg_id, ax, ay, bx, b_y. Distances go up to
    ``reach`` glyph sizes; the text is unfolded over that reach, the segments over the cells they cross.
    """
    d = F.col("gd") * reach
    probes = cells.over_box(dims, F.col("px") - d, F.col("py") - d, F.col("px") + d, F.col("py") + d, cell)
    args = [F.col(c) for c in ("ax", "ay", "bx", "b_y")]
    drawn = geo.length(*args)
    targets = cells.over_segment(segs.filter(drawn >= 1e-6), *args, cell)
    dist = geo.point_segment_distance(F.col("px"), F.col("py"), *args)
    along = geo.line_gap(geo.bearing_math(F.col("bx") - F.col("ax"), F.col("b_y") - F.col("ay")), F.pmod(F.col("ang"), F.lit(180.0))) <= max_deg
    t = targets.withColumn("drawn", drawn)
    return cells.nearest(probes, t, ["sheet"], ["dim_id"], dist, along & (dist <= d), ["seg_id", "drawn"], ["seg_id"])
