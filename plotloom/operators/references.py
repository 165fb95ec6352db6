"""The reference of every hand-placed sheet: which pose it rests on, how far the two readings differ, and whether it may be used."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.functions import geo, rings
from plotloom.operators import fits, rules

KEY = ["village", "survey"]


def reference_table(sheets: DataFrame, hand: DataFrame, points_pose: DataFrame, geometry_pose: DataFrame, disputed: DataFrame, rule: str = "displacement") -> DataFrame:
    """One row per sheet that is placed by hand and has a pose.

    ``sheets``: village, survey, ring (outline in sheet metres), area (all plots). ``hand``: village, survey, hand_file, ring (as
    saved on the ground), area. Poses: village, survey, theta, tx, ty, rms, n; a pose without rms counts as missing. The points'
    pose is taken unless it is missing or too loose, else that of the hand geometry. ``disputed``: village, survey, reason.
    """
    pose = fits.truth_source(points_pose, geometry_pose, KEY, rules.STRETCH_RMS_M, ("theta", "tx", "ty", "rms", "n")).filter("theta is not null")
    j = (pose.join(hand.select(*KEY, "hand_file", F.col("ring").alias("hand"), F.col("area").alias("hand_area")), KEY)
         .join(sheets.select(*KEY, F.col("ring").alias("local"), F.col("area").alias("sheet_area")), KEY).join(disputed.select(*KEY, "reason"), KEY, "left"))
    j = j.withColumn("exact", geo.rigid_ring(F.col("local"), F.col("theta"), F.col("tx"), F.col("ty")))
    c, h = geo.ring_centroid(F.col("exact")), geo.ring_centroid(F.col("hand"))
    j = j.withColumns({"a": rings.smallest_rectangle(F.col("exact")), "b": rings.smallest_rectangle(F.col("hand")), "d": rings.disagreement(F.col("exact"), F.col("hand")),
                       "scale": F.when(F.col("sheet_area") > 0, F.sqrt(F.col("hand_area") / F.col("sheet_area"))), "gap": F.hypot(c["x"] - h["x"], c["y"] - h["y"])})
    j = j.withColumns({k: (F.try_divide(F.col(f"b.{s}"), F.col(f"a.{s}")) - 1.0) * 100.0 for k, s in (("long_pct", "long_m"), ("short_pct", "short_m"))})
    j = j.withColumn("verdict", rules.stretch_rule(rule, F.col("scale"), F.col("long_pct"), F.col("short_pct"), F.col("rms"), F.col("d.mean_m"), F.col("d.corner_mean_m")))
    return j.select(
        *KEY, "hand_file", "source", "theta", "tx", "ty", F.round("rms", 3).alias("rms_m"), F.col("n").cast("int").alias("n_points"), F.round("scale", 4).alias("area_scale"),
        F.round("long_pct", 2).alias("stretch_long_pct"), F.round("short_pct", 2).alias("stretch_short_pct"), F.round("b.long_m", 2).alias("extent_m"),
        F.round("gap", 3).alias("centroid_gap_m"), *[F.round(f"d.{x}", 3).alias(f"disagree_{x}") for x in ("mean_m", "p95_m", "max_m", "corner_mean_m", "corner_max_m")],
        F.col("d.corners_matched").alias("corners_matched"), rules.stretch_band(F.col("scale")).alias("band"), F.col("verdict.stretched").alias("stretched"),
        F.col("verdict.reason").alias("stretched_reason"), F.col("reason").isNotNull().cast("int").alias("disputed"), F.coalesce("reason", F.lit("")).alias("disputed_reason"))


def for_features(refs: DataFrame) -> DataFrame:
    """The columns that ``evaluation.feature_rows`` takes from a reference."""
    return refs.select(
        *KEY, F.col("source").alias("ref_source"), F.col("rms_m").alias("ref_rms_m"), F.col("area_scale").alias("ref_area_scale"),
        F.col("stretch_long_pct").alias("ref_stretch_long_pct"), F.col("stretch_short_pct").alias("ref_stretch_short_pct"),
        *[F.col(f"disagree_{x}").alias(f"ref_disagree_{x}") for x in ("mean_m", "p95_m", "corner_mean_m")], F.col("band").alias("stretch_band"),
        "stretched", "stretched_reason", "disputed", "disputed_reason")
