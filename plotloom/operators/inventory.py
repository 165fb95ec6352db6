"""What exists, what is missing and why: file versions, coverage, logs, lookups, table merges."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.functions import text as tx

LETTER_SUFFIXES = "ABCDEF"
MIN_FILE_BYTES = 1000
DEFAULT_SCALE = 500


def newest_file_per_key(files: DataFrame, keys: list[str], order: list[str], file_id: str) -> DataFrame:
    """Every file with ``is_current``: the newest per key, the rest are superseded.

    The newest is found by a map-side combined maximum and joined back, so a key holding a large
    share of all files is never sorted in one task.
    """
    newest = files.groupBy(*keys).agg(F.max_by(file_id, F.struct(*order)).alias("_newest"))
    return (files.join(newest, keys)
            .withColumn("is_current", (F.col(file_id) == F.col("_newest")).cast("int")).drop("_newest"))


def with_scale_of_name(files: DataFrame, stem: str = "stem") -> DataFrame:
    scale = tx.blank_to_null(F.regexp_extract(stem, r"_s([0-9]+)\z", 1)).cast("int")
    return files.withColumns({"plain": tx.strip_scale_suffix(F.col(stem)),
                              "scale": F.coalesce(scale, F.lit(DEFAULT_SCALE))})


def pick_coarsest_version(files: DataFrame, folder: str = "village") -> DataFrame:
    return (with_scale_of_name(files).groupBy(folder, "plain")
            .agg(F.max_by("stem", "scale").alias("stem"), F.max("scale").alias("scale")))


def scale_override(sheets: DataFrame, overrides: DataFrame) -> DataFrame:
    """Nominal scale unless the side table names the plainly named file."""
    o = overrides.select("village", F.col("survey_no").alias("stem"), F.col("scale").alias("_other"))
    return (sheets.join(o, ["village", "stem"], "left")
            .withColumn("scale", F.coalesce("_other", "scale")).drop("_other"))


def last_error_per_key(log: DataFrame) -> DataFrame:
    failed = F.col("status") != "saved"
    last = F.max_by(F.when(failed, F.struct("api_error")), F.when(failed, F.col("pos")))
    return log.groupBy("giscode").agg(F.coalesce(last["api_error"], F.lit("")).alias("api_error"))


def units_on_disk(files: DataFrame) -> DataFrame:
    return (files.filter(F.col("size") > MIN_FILE_BYTES)
            .select(F.col("village").alias("village_code"), F.col("unit").alias("survey_unit")).distinct())


def tried_units(base: DataFrame, log: DataFrame) -> DataFrame:
    """Per base number, the lettered pieces it has plus the suffix forms the log was asked for."""
    keyed = base.select("village_code", "survey_no", "vector_pieces")
    pieces = (keyed.select("village_code", "survey_no",
                           F.explode(F.split(F.regexp_replace("vector_pieces", r"\s+", ""), ";")).alias("unit"))
              .filter(F.col("unit").rlike("[A-Za-z]")))
    forms = keyed.select("village_code", "survey_no", F.explode(F.array(
        *[F.concat("survey_no", F.lit(s)) for s in LETTER_SUFFIXES])).alias("unit"))
    logged = log.select("giscode").distinct()
    asked = (forms.withColumn("giscode", tx.giscode(F.col("village_code"), F.col("unit")))
             .join(logged, "giscode", "left_semi").drop("giscode"))
    return pieces.unionByName(asked).distinct()


def coverage_status(batch: DataFrame, files: DataFrame, log: DataFrame) -> DataFrame:
    """One row per survey unit: saved plainly, saved in letter forms, missing with the reason, or unclaimed."""
    base = batch.select(tx.village_code(F.col("taluk"), F.col("village")).alias("village_code"), "village_name",
                        "survey_no", "vector_pieces")
    disk = units_on_disk(files)
    key = ["village_code", "survey_no"]
    plain = base.join(disk.select("village_code", F.col("survey_unit").alias("survey_no")), key, "left_semi")
    rest = base.join(plain.select(*key), key, "left_anti")
    lettered = disk.filter(F.col("survey_unit").rlike(r"\A[0-9]+[A-Za-z]+\z")).withColumn(
        "survey_no", tx.leading_digits(F.col("survey_unit")))
    letters = rest.join(lettered, key)
    absent = rest.join(letters.select(*key).distinct(), key, "left_anti")
    tried = tried_units(absent, log).groupBy(*key).agg(
        F.array_join(F.array_sort(F.collect_set("unit")), ", ").alias("tried"))
    reason = F.coalesce(tx.blank_to_null(F.col("api_error")), F.lit("not available"))
    missing = (absent.withColumn("giscode", tx.giscode(F.col("village_code"), F.col("survey_no")))
               .join(last_error_per_key(log), "giscode", "left").join(tried, key, "left")
               .withColumn("api_error", F.concat(reason, F.lit(" | also tried: "), F.coalesce("tried", F.lit("-")))))
    claimed = plain.select("village_code", F.col("survey_no").alias("survey_unit")).unionByName(
        letters.select("village_code", "survey_unit"))
    names = base.groupBy("village_code").agg(F.min("village_name").alias("village_name"))
    loose = (disk.join(claimed, ["village_code", "survey_unit"], "left_anti").join(names, "village_code", "left")
             .withColumn("village_name", F.coalesce("village_name", "village_code")))

    def row(df, unit, base_no, kind, state, error, pieces):
        return df.select(F.col("village_name").alias("village"), "village_code", unit.alias("survey_unit"),
                         base_no.alias("base_survey"), kind.alias("unit_kind"), F.lit(state).alias("sketch"),
                         error.alias("api_error"), pieces.alias("vector_pieces"))
    plain_kind, letter_kind = F.lit("plain number"), F.lit("letter form")
    no, unit, none, pieces = F.col("survey_no"), F.col("survey_unit"), F.lit(""), F.col("vector_pieces")
    loose_kind = F.when(unit.rlike("[A-Za-z]"), letter_kind).otherwise(plain_kind)
    return (row(plain, no, no, plain_kind, "saved", none, pieces)
            .unionByName(row(letters, unit, no, letter_kind, "saved", none, pieces))
            .unionByName(row(missing, no, no, plain_kind, "missing", F.col("api_error"), pieces))
            .unionByName(row(loose, unit, F.coalesce(tx.leading_digits(unit), unit), loose_kind, "saved", none,
                             F.lit("(added manually)"))))


def unclaimed_units(files: DataFrame, claimed: DataFrame) -> DataFrame:
    return units_on_disk(files).join(claimed, ["village_code", "survey_unit"], "left_anti")


def missing_histogram(coverage: DataFrame) -> DataFrame:
    return (coverage.groupBy("village").agg(
        F.count("*").alias("n_units"), F.count_if(F.col("sketch") == "missing").alias("n_missing"),
        F.count_distinct(F.when(F.col("sketch") == "missing", F.col("base_survey"))).alias("n_bases"))
        .orderBy(F.desc("n_missing"), "village"))


def enrich_attributes(plots: DataFrame, villages: DataFrame) -> DataFrame:
    """Location columns on every plot; the one plot of an undivided sheet takes the survey number."""
    survey = tx.strip_scale_suffix(F.col("stem"))
    code = F.col("village_code")
    sizes = plots.groupBy("village_code", "stem").agg(F.count("*").alias("_n"))
    whole = (F.col("_n") == 1) & F.coalesce(F.col("plot_no") == "", F.lit(True))
    return (plots.join(sizes, ["village_code", "stem"]).join(villages, "village_code", "left")
            .select("village_code", "stem", "i", "poly_id", survey.alias("survey_no"),
                    F.coalesce("village_name", code).alias("village"), tx.taluk_name(code).alias("taluk"),
                    F.split(code, "_")[1].cast("int").alias("taluk_code"),
                    tx.giscode(code, survey).alias("giscode"), tx.sketch_id(code, survey).alias("sketch_id"),
                    F.when(whole, survey).otherwise(F.col("plot_no")).alias("plot_no"),
                    F.when(whole, "whole_survey_no_subdivision").otherwise("glyph_outline").alias("label_source")))


def per_sketch_rollup(plots: DataFrame) -> DataFrame:
    return plots.groupBy("village_code", "stem").agg(
        F.count("*").alias("polygons"), F.count_if(F.coalesce(F.col("plot_no") != "", F.lit(False))).alias("numbered"),
        F.count_if(F.col("review") == 1).alias("review_needed"))


def survey_area_totals(areas: DataFrame) -> DataFrame:
    return (areas.withColumn("base", tx.leading_digits(F.trim("unit"))).filter("base is not null")
            .groupBy("village", "base").agg(F.sum(F.coalesce("area", F.lit(0.0))).alias("area")))


def lookup_exact_then_parent(sheets: DataFrame, table: DataFrame, survey: Column, values: list[str]) -> DataFrame:
    """``values`` of the row with the same key, else of the plain number; ``match`` says which."""
    def renamed(p):
        return table.select(F.col("village"), F.col("ukey").alias(f"_{p}"), F.struct(*values).alias(f"_{p}v"))
    keyed = sheets.withColumns({"_exact": F.upper(survey), "_parent": tx.leading_digits(survey)})
    both = keyed.join(renamed("exact"), ["village", "_exact"], "left").join(renamed("parent"), ["village", "_parent"], "left")
    got = F.coalesce("_exactv", "_parentv")
    kind = F.when(F.col("_exactv").isNotNull(), "exact").when(F.col("_parentv").isNotNull(), "parent").otherwise("")
    return (both.withColumns({**{f"ref_{v}": got[v] for v in values}, "match": kind})
            .drop("_exact", "_parent", "_exactv", "_parentv"))


def upsert_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def protect_owner_rows(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Fresh automatic rows, except where the owner has a row of the same key: that one stays."""
    owned = stored.filter(F.col("source") == "team")
    rest = fresh.join(owned.select(*keys).distinct(), keys, "left_anti")
    kept = owned.join(fresh.select(*keys).distinct(), keys, "left_semi")
    return kept.unionByName(rest)


def plots_by_position(df: DataFrame, keys: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    """1-based position inside each (sheet-sized) key."""
    from pyspark.sql import Window as W
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
