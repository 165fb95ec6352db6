"""Which placements count: todo lists, frozen anchors, disputes, anchor reports, plot matching."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plotloom.functions import text as tx


def todo_surveys(sheets: DataFrame, anchors: DataFrame, only: DataFrame | None = None) -> DataFrame:
    key = ["village", "survey"]
    todo = sheets.join(anchors.select(*key), key, "left_anti")
    return todo if only is None else todo.join(only.select(*key), key, "left_semi")


def frozen_anchor_select(files: DataFrame, tool_written: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest file per key that the tool did not write itself."""
    mine = files.join(tool_written.select(F.col("fp").alias("fingerprint")).distinct(), "fingerprint", "left_anti")
    rest = [c for c in files.columns if c not in keys]
    return (mine.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_f"))
            .select(*keys, *[F.col("_f")[c].alias(c) for c in rest]))


def disputed_reasons(audit: DataFrame, conflicts: DataFrame, manual: DataFrame) -> DataFrame:
    """All reasons a survey cannot be a reference, in source order."""
    def rows(df, src, pos, side, reason):
        return df.select("village", "survey", F.struct(F.lit(src).alias("s"), pos.cast("bigint").alias("p"), F.lit(side).alias("d"), reason.alias("why")).alias("r"))
    zero = F.lit(0)
    mismatch = rows(audit.filter(F.col("verdict").contains("identity mismatch")), 0, zero, 0,
                    F.lit("Puvi and the portal describe different parcels"))
    a = rows(conflicts.withColumn("survey", F.col("survey_a")), 1, F.col("pos"), 0, F.concat(F.lit("railway land conflict with "), "survey_b"))
    b = rows(conflicts.filter("survey_a <> survey_b").withColumn("survey", F.col("survey_b")), 1, F.col("pos"), 1,
             F.concat(F.lit("railway land conflict with "), "survey_a"))
    listed = rows(manual, 2, zero, 0, F.coalesce(tx.blank_to_null(F.col("reason")), F.lit("listed in disputed.csv")))
    every = mismatch.unionByName(a).unionByName(b).unionByName(listed)
    return every.groupBy("village", "survey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["why"]), "; ").alias("reason"))


def anchors_table(anchors: DataFrame, superseded: DataFrame, conflicts: DataFrame) -> DataFrame:
    """One report row per anchor; a conflict shows on both of its ends."""
    key = ["village", "survey"]
    ends = conflicts.select("village", F.explode(F.array(F.struct(F.col("a").alias("survey"), F.col("b").alias("o")),
                                              F.struct(F.col("b").alias("survey"), F.col("a").alias("o")))).alias("e"), "p90_gap_m")
    text = F.format_string("%s (%.2f m)", F.col("e.o"), F.col("p90_gap_m"))
    item = F.struct(tx.survey_order(F.col("e.o")).alias("n"), F.col("e.o").alias("o"), text.alias("t"))
    listed = ends.groupBy("village", "e.survey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda e: e["t"]), ";").alias("conflicts"))
    old = superseded.groupBy(*key).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("mtime", "file")), asc=False), lambda e: e["file"]), ";").alias("superseded_files"))
    return (anchors.join(old, key, "left").join(listed, key, "left")
            .withColumns({"heading_deg": F.round("theta", 3), "fingerprint": F.substring("fingerprint", 1, 16),
                          "superseded_files": F.coalesce("superseded_files", F.lit("")), "conflicts": F.coalesce("conflicts", F.lit(""))})
            .orderBy("village", tx.survey_order(F.col("survey")), "survey"))


def plot_key_join(stored: DataFrame, edited: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Stored plots with the edited plot of the same (poly_id, plot_no); by position when the counts agree."""
    def keyed(df, *extra):
        w = W.partitionBy(*keys).orderBy("pos")                    # plots of one sheet
        number = F.coalesce(F.when(F.col("plot_no") != "NaN", F.col("plot_no")), F.lit(""))
        return df.select(*keys, "poly_id", number.alias("_pn"), F.row_number().over(w).alias("_k"),
                         F.count("*").over(W.partitionBy(*keys)).alias("_n"), *extra)
    s, e = keyed(stored), keyed(edited, value)
    exact = e.select(*keys, "poly_id", "_pn", F.col(value).alias("_exact"))
    place = e.select(*keys, "_k", F.col("_n").alias("_m"), F.col(value).alias("_place"))
    same = F.when(F.col("_n") == F.col("_m"), F.col("_place"))
    how = F.when(F.col("_exact").isNotNull(), "key").when(same.isNotNull(), "position").otherwise("unmatched")
    return (s.join(exact, [*keys, "poly_id", "_pn"], "left").join(place, [*keys, "_k"], "left")
            .select(*keys, "poly_id", F.coalesce("_exact", same).alias(value), how.alias("how")))


def in_window_flag(boxes: DataFrame, windows: DataFrame) -> DataFrame:
    inside = ((F.col("minx") >= F.col("wx0")) & (F.col("miny") >= F.col("wy0"))
              & (F.col("maxx") <= F.col("wx1")) & (F.col("maxy") <= F.col("wy1")))
    return boxes.join(windows, "village").withColumn("in_window", inside.cast("int"))
