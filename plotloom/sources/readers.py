"""Readers for the files a survey project holds; schemas are fixed, nothing is inferred."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom import schemas
from plotloom.functions import geo
from plotloom.functions import text as tx

SHEET_PATH = r"([^/]+)/([^/]+)_parcels\.geojson$"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def scan_sheets(spark: SparkSession, path: str, pattern: str = SHEET_PATH, by_line: bool = False) -> DataFrame:
    """Plots of feature collections, one row per feature; village and survey come from the path.

    ``by_line``: many sheets a file, each on its line, as ``sink_sheets`` writes them; the survey comes from the collection's name.
    """
    docs = spark.read.schema(schemas.SHEET_COLLECTION).option("multiLine", not by_line).option("recursiveFileLookup", True).json(path)
    where = F.col("_metadata.file_path")
    survey = F.regexp_extract("name", r"^(.*)_parcels$", 1) if by_line else F.regexp_extract(where, pattern, 2)
    f = docs.select(F.regexp_extract(where, pattern, 1).alias("village"), survey.alias("survey"), F.explode("features").alias("f"))
    open_ring = F.transform("f.geometry.coordinates", lambda r: F.transform(F.slice(r, F.lit(1), F.size(r) - 1), lambda p: geo.pt(p[0], p[1])))
    return f.select("village", "survey", "f.properties.*", open_ring.alias("rings"))


def scan_csv_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a fixed schema; a path that is not there is an empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def scan_control_points(spark: SparkSession, path: str, key_pattern: str = r"([^/]+)/([^/]+)_parcels\.geojson\.points$") -> DataFrame:
    """Enabled points of georeferencer files: village, survey, map_x, map_y, source_x, source_y."""
    t = spark.read.option("recursiveFileLookup", True).text(path)
    where = F.col("_metadata.file_path")
    p = t.select(F.regexp_extract(where, key_pattern, 1).alias("village"), F.regexp_extract(where, key_pattern, 2).alias("survey"), F.trim("value").alias("line"))
    f = F.split("line", ",")
    rows = p.filter(~F.col("line").startswith("#") & ~F.col("line").startswith("mapX") & (F.size(f) >= 5) & F.trim(f[4]).isin("1", "true", "True"))
    return rows.select("village", "survey", *[f[i].cast("double").alias(n) for i, n in enumerate(("map_x", "map_y", "source_x", "source_y"))])


def scan_neighbours(spark: SparkSession, path: str, pattern: str = r"nb_override_([^/]+)\.json$") -> DataFrame:
    """Printed neighbours from per-village maps of arrays, with their place in the list."""
    t = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    m = t.select(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).alias("village"),
                 F.from_json("value", T.MapType(T.StringType(), schemas.NEIGHBOUR)).alias("m"))
    e = m.select("village", F.explode("m").alias("survey", "l")).select("village", "survey", F.posexplode("l").alias("pos", "e"))
    return e.select("village", "survey", "pos", "e.*")


def scan_glyph_library(spark: SparkSession, path: str) -> DataFrame:
    """Exemplars of a list of [char, bits, aspect] triples."""
    t = spark.read.option("wholetext", True).text(path)
    e = t.select(F.posexplode(F.from_json("value", "array<array<string>>")).alias("pos", "e"))
    return e.select("pos", F.col("e")[0].alias("ch"), F.from_json(F.col("e")[1], "array<int>").alias("bits"), F.col("e")[2].cast("double").alias("ar"))


def file_inventory(spark: SparkSession, path: str, glob: str, min_bytes: int = 1000) -> DataFrame:
    """Names and sizes of files; their content is never read."""
    f = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
         .select("path", "length", "modificationTime").filter(F.col("length") > min_bytes))
    return f.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("village"), F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("unit"),
                    "length", "modificationTime")


def typed_status(status: DataFrame) -> DataFrame:
    """Status text columns as numbers and flags."""
    num = "share margin boundary_rms_m support_m support_next_m heading_deg pose_tx pose_ty shift_m sigma_pos_m sigma_head_deg puvi_reference_m puvi_ratio".split()
    whole = "confidence n_candidates side_ok side_bad contradictions anchor_partners pass".split()
    flags = "observable certain in_window puvi_trusted".split()
    return status.withColumns({**{c: tx.lenient_number(F.col(c)) for c in num}, **{c: tx.lenient_int(F.col(c)) for c in whole},
                               **{c: tx.lenient_flag(F.col(c)) for c in flags}})
