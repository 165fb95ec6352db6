"""Sinks: features, tables, appended rows, replaced partitions, control points."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.functions import text as tx

POINTS_HEADER = "mapX,mapY,sourceX,sourceY,enable,dX,dY,residual"


def _closed(rings: Column) -> Column:
    return F.transform(rings, lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.array(p["x"], p["y"])))


def feature(properties: list[str], rings: str = "rings") -> Column:
    geometry = F.struct(F.lit("Polygon").alias("type"), _closed(F.col(rings)).alias("coordinates"))
    return F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))


def sink_features(plots: DataFrame, properties: list[str], path: str) -> None:
    """One GeoJSON feature per line, a folder per village. A village's lines are brought together first, else every task writes a file for
    every village it meets; a large village may still come in several files."""
    lines = plots.select("village", F.to_json(feature(properties)).alias("value")).hint("rebalance", "village")
    lines.write.mode("overwrite").partitionBy("village").text(path)


def sink_sheets(plots: DataFrame, properties: list[str], path: str) -> None:
    """One feature collection per sheet, each on a line of its own; a folder per village. A file per sheet would be millions of them, each
    listed and renamed by the driver."""
    doc = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.concat("survey", F.lit("_parcels")).alias("name"),
                             F.array_sort(F.collect_list(feature(properties))).alias("features")))
    sheets = plots.groupBy("village", "survey").agg(doc.alias("value")).select("village", "value")
    sheets.repartition("village").write.mode("overwrite").partitionBy("village").text(path)


def sink_sorted_table(rows: DataFrame, order: list[Column], path: str) -> None:
    rows.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def by_plot_number() -> list[Column]:
    return [F.coalesce(tx.blank_to_null(F.col("plot_no")), F.lit("zzz"))]


def by_survey() -> list[Column]:
    return [tx.survey_order(F.col("survey")), F.col("survey")]


def sink_append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("village").parquet(path)


def sink_replace_partition(rows: DataFrame, path: str) -> None:
    """Rewrite the villages present in ``rows``; every other village of the table stays."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("village").parquet(path)


def sink_control_points(points: DataFrame, crs_wkt: str, path: str) -> None:
    """Georeferencer text per sheet: CRS line, header, then the points with 17 decimals."""
    line = F.format_string("%.17f,%.17f,%.17f,%.17f,1,0,0,0", "map_x", "map_y", "source_x", "source_y")
    body = points.select("village", "survey", F.lit(2).alias("o"), "pos", line.alias("value"))
    head = points.select("village", "survey").distinct().select("village", "survey", F.posexplode(F.array(
        F.lit("#CRS: " + crs_wkt), F.lit(POINTS_HEADER))).alias("o", "value")).select("village", "survey", "o", F.lit(0).cast("bigint").alias("pos"), "value")
    rows = head.unionByName(body).repartition("village", "survey").sortWithinPartitions("village", "survey", "o", "pos")
    rows.select("village", "survey", "value").write.mode("overwrite").partitionBy("village", "survey").text(path)
