"""Printed neighbours: trust, three-valued adjacency, sides, contradictions, growth by rings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plotloom.functions import text as tx
from plotloom.operators import spatial
from plotloom.session import cut_lineage

# Compass letters and their unit vectors.
SIDES = {"N": (0.0, 1.0), "NE": (0.7071, 0.7071), "E": (1.0, 0.0), "SE": (0.7071, -0.7071),
         "S": (0.0, -1.0), "SW": (-0.7071, -0.7071), "W": (-1.0, 0.0), "NW": (-0.7071, 0.7071)}
SIDE_COS = 0.38
PRINTED_REACH_M = 10.0


def tool_fingerprints(status: DataFrame, columns: list[str]) -> DataFrame:
    return (status.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("fp"))
            .filter("fp is not null and fp <> ''").distinct())


def common_plots(a: DataFrame, b: DataFrame) -> DataFrame:
    """Plots of two layers paired by id; surveys sharing no id are paired by descending area."""
    key = ["village", "survey"]
    shared = a.select(*key, "poly_id").join(b.select(*key, "poly_id"), [*key, "poly_id"])

    def ranked(df, name):
        w = W.partitionBy(*key).orderBy(F.desc("area"), "poly_id")      # plots of one sheet
        return df.select(*key, F.col("poly_id").alias(name), F.row_number().over(w).alias("k"))
    lone = a.join(shared.select(*key).distinct(), key, "left_anti")
    by_area = ranked(lone, "poly_id").join(ranked(b, "other_id"), [*key, "k"])
    return (shared.select(*key, "poly_id", F.col("poly_id").alias("other_id"), F.lit("id").alias("how"))
            .unionByName(by_area.select(*key, "poly_id", "other_id", F.lit("area").alias("how"))))


def side_vector(letters: Column) -> Column:
    """Unit vector of a compass letter as a struct; (0, 0) for anything else."""
    up = F.upper(letters)
    x, y = F.lit(0.0), F.lit(0.0)
    for k, (vx, vy) in SIDES.items():
        x, y = F.when(up == k, F.lit(vx)).otherwise(x), F.when(up == k, F.lit(vy)).otherwise(y)
    return F.struct(F.coalesce(x, F.lit(0.0)).alias("x"), F.coalesce(y, F.lit(0.0)).alias("y"))


def bearing_letter(deg: Column) -> Column:
    """Compass bearing in degrees to its eighth."""
    return F.element_at(F.array(*[F.lit(k) for k in SIDES]), (F.floor(F.pmod(deg + 22.5, F.lit(360.0)) / 45) + 1).cast("int"))


def normalised(entries: DataFrame) -> DataFrame:
    return entries.withColumn("other", tx.normalise_survey(F.col("number"))).filter("other is not null")


def trusted_neighbours(entries: DataFrame) -> DataFrame:
    """Distinct printed numbers with two readers or high confidence; a sheet never names itself."""
    sure = (F.coalesce("readers", F.lit(1)) >= 2) | F.coalesce(F.col("confidence") == "high", F.lit(False))
    return (normalised(entries).filter(sure & (F.col("other") != F.upper("survey")))
            .select("village", "survey", "other").distinct())


def printed_side(entries: DataFrame, position: list[str]) -> DataFrame:
    """First side letter a sheet prints for each number; letters outside the compass give null."""
    first = F.upper(F.min_by(F.struct("side"), F.struct(*position))["side"])
    return (normalised(entries).groupBy("village", "survey", "other").agg(first.alias("side"))
            .withColumn("side", F.when(F.col("side").isin(*SIDES), F.col("side"))))


def mutual_adjacency(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """``adjacent``: true when either prints the other, null when neither sheet was read, else false."""
    trusted = trusted_neighbours(entries)
    read = entries.select("village", "survey").distinct()

    def flag(df, on, name):
        return df.withColumns({**on, name: F.lit(True)})
    ab = trusted.select("village", F.col("survey").alias("a"), F.col("other").alias("_b"), F.lit(True).alias("_ab"))
    ba = trusted.select("village", F.col("survey").alias("b"), F.col("other").alias("_a"), F.lit(True).alias("_ba"))
    ra = read.select("village", F.col("survey").alias("a"), F.lit(True).alias("_ra"))
    rb = read.select("village", F.col("survey").alias("b"), F.lit(True).alias("_rb"))
    j = (pairs.withColumns({"_b": F.upper("b"), "_a": F.upper("a")})
         .join(ab, ["village", "a", "_b"], "left").join(ba, ["village", "b", "_a"], "left")
         .join(ra, ["village", "a"], "left").join(rb, ["village", "b"], "left"))
    known = F.col("_ra").isNotNull() | F.col("_rb").isNotNull()
    return (j.withColumn("adjacent", F.when(known, F.col("_ab").isNotNull() | F.col("_ba").isNotNull()))
            .drop("_ab", "_ba", "_ra", "_rb", "_a", "_b"))


def two_reader_consensus(readings: DataFrame) -> DataFrame:
    """Majority side, number of readers and confidence tier per printed number of a sheet."""
    key = ["sheet", "number"]
    sided = (readings.filter("side <> ''").groupBy(*key, F.upper("side").alias("s")).agg(F.count("*").alias("c"))
             .groupBy(*key).agg(F.max_by(F.col("s"), F.struct("c", "s")).alias("side")))
    per_reader = (readings.groupBy(*key, "reader").agg(F.max((F.col("confidence") == "high").cast("int")).alias("hi"))
                  .groupBy(*key).agg(F.count("*").alias("readers"), F.max("hi").alias("hi")))
    two, hi = F.col("readers") >= 2, F.col("hi") == 1
    return per_reader.join(sided, key, "left").select(
        *key, F.coalesce("side", F.lit("")).alias("side"), "readers",
        F.when(two & hi, "high").when(two | hi, "medium").otherwise("low").alias("confidence"))


def ring_growth(edges: DataFrame, seeds: DataFrame, rings: int) -> DataFrame:
    """Surveys reached from the seeds in ``rings`` steps along printed numbers, either direction, with the step."""
    both = edges.select("village", F.col("survey").alias("a"), F.col("other").alias("b"))
    both = both.unionByName(both.select("village", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    reached = seeds.select("village", "survey").distinct().withColumn("ring", F.lit(0))
    for step in range(1, rings + 1):
        front = reached.filter(F.col("ring") == step - 1).select("village", F.col("survey").alias("a"))
        fresh = (both.join(front, ["village", "a"], "left_semi").select("village", F.col("b").alias("survey")).distinct()
                 .join(reached, ["village", "survey"], "left_anti").withColumn("ring", F.lit(step)))
        reached = cut_lineage(reached.unionByName(fresh))
    return reached.filter("ring > 0")


def printed_contradictions(trusted: DataFrame, bodies: DataFrame, reach: float = PRINTED_REACH_M) -> DataFrame:
    """Per placement the printed, placed neighbours it stays away from, in natural order."""
    far = spatial.bodies_out_of_reach(trusted, bodies, reach)
    names = F.transform(F.array_sort(F.collect_list(F.struct(tx.survey_order(F.col("other")).alias("n"), F.col("other").alias("o")))),
                        lambda e: e["o"])
    return far.groupBy("village", "survey").agg(F.count("*").alias("n_far"), F.array_join(names, ",").alias("printed_far"))


def side_checks(sides: DataFrame, trusted: DataFrame, centres: DataFrame, min_cos: float = SIDE_COS) -> DataFrame:
    """Printed sides honoured and contradicted per survey, read from its own sheet and from its neighbours'.

    A survey's own sheet counts for its trusted numbers only; any neighbour's sheet that names the survey counts.
    ``sides``: village, survey, other, side. ``centres``: village, survey, theta (degrees), cx, cy on the ground.
    """
    own = centres.select("village", "survey", F.col("theta").alias("th"), F.col("cx").alias("sx"), F.col("cy").alias("sy"))
    oth = centres.select("village", F.col("survey").alias("other"), F.col("cx").alias("ox"), F.col("cy").alias("oy"))
    v = side_vector(F.col("side"))
    c, s = F.cos(F.radians("th")), F.sin(F.radians("th"))
    vx, vy = c * v["x"] - s * v["y"], s * v["x"] + c * v["y"]
    dx, dy = F.col("ox") - F.col("sx"), F.col("oy") - F.col("sy")
    dist = F.hypot(dx, dy)
    sure = trusted.select("village", "survey", "other", F.lit(True).alias("sure"))
    seen = (sides.filter("side is not null and survey <> other").join(own, ["village", "survey"]).join(oth, ["village", "other"])
            .filter(dist >= 1.0).join(sure, ["village", "survey", "other"], "left")
            .select("village", "survey", "other", "sure", ((vx * dx + vy * dy) / dist >= min_cos).cast("int").alias("ok")))
    votes = seen.select("village", "ok", F.explode(F.array(
        F.when(F.col("sure"), F.col("survey")), F.col("other"))).alias("survey")).filter("survey is not null")
    return votes.groupBy("village", "survey").agg(F.sum("ok").alias("side_ok"), F.sum(1 - F.col("ok")).alias("side_bad"))
