"""Survey numbers, codes, notes and lenient casts as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword -> cause, first match wins.
CAUSES = (
    ("contradict", "printed side or neighbour contradicted"),
    ("does not reach printed", "does not reach a printed neighbour"),
    ("no placed neighbour", "no placed neighbour"),
    ("outside the satellite window", "outside the satellite window"),
    ("next best", "runner-up pose close"),
    ("railway", "clipped by railway land"),
    ("backfilled", "backfilled row, features missing"),
)
# Fixed value: what stands where no keyword fits.
NO_CAUSE = "see notes"
UNNUMBERED = 1_000_000_000
# Code -> name.
TALUKS = {"04": "Chengalpattu", "05": "Tambaram", "15": "Vandalur"}


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def normalise_survey(number: Column) -> Column:
    """Bare survey number of a printed label; labels of whole villages and plain words give null."""
    up = F.upper(F.trim(number))
    bare = F.regexp_replace(up, r"^S\.?\s*NO\.?\s*", "")
    bare = F.split(F.regexp_replace(bare, " ", ""), "/")[0]
    is_village = up.contains("V.NO") | up.contains("VILLAGE")
    return F.when(~is_village & bare.rlike(r"\A[0-9]+[A-Z]?\z"), bare)


def leading_digits(c: Column) -> Column:
    return blank_to_null(F.regexp_extract(c, r"^[0-9]+", 0))


def survey_order(c: Column) -> Column:
    """Numeric part of the natural order; ties fall to the text itself."""
    return F.coalesce(leading_digits(c).try_cast("int"), F.lit(UNNUMBERED))


def strip_scale_suffix(stem: Column) -> Column:
    return F.regexp_replace(stem, r"_s[0-9]+\z", "")


def strip_tail(survey: Column) -> Column:
    """Everything before the first non-digit; text that starts with a letter becomes empty."""
    return F.regexp_replace(survey, r"(?s)[^0-9].*\z", "")


def village_code(taluk: Column, village: Column) -> Column:
    return F.concat(F.lit("35_"), F.lpad(taluk, 2, "0"), F.lit("_"), F.lpad(village, 3, "0"))


def giscode(code: Column, survey: Column) -> Column:
    p = F.split(code, "_")
    return F.concat(F.lit("S35"), p[1], p[2], survey)


def sketch_id(code: Column, survey: Column) -> Column:
    return F.concat_ws("_", code, survey)


def taluk_name(code: Column) -> Column:
    t = F.split(code, "_")[1]
    named = F.create_map(*[F.lit(x) for kv in TALUKS.items() for x in kv])
    return F.coalesce(F.try_element_at(named, t), t)


def lenient_number(c: Column) -> Column:
    return blank_to_null(F.trim(c)).try_cast("double")


def lenient_int(c: Column) -> Column:
    return F.rint(lenient_number(c)).cast("bigint")


def lenient_flag(c: Column) -> Column:
    yes = F.lower(F.trim(c)).isin("true", "1", "yes")
    return F.when(c.isNotNull() & (c != ""), yes.cast("int"))


def list_count(c: Column, sep: str = ",") -> Column:
    return F.when(c.isNotNull(), F.size(F.filter(F.split(c, sep), lambda x: x != "")))


def conform_move(notes: Column) -> Column:
    return blank_to_null(F.regexp_extract(notes, r"conform max ([0-9.]+) m", 1)).try_cast("double")


def clipped_flag(notes: Column) -> Column:
    return F.coalesce(notes.contains("clipped").cast("int"), F.lit(0))


def cause_of_error(notes: Column) -> Column:
    low = F.lower(F.coalesce(notes, F.lit("")))
    out = F.lit(NO_CAUSE)
    for key, label in reversed(CAUSES):
        out = F.when(low.contains(key), F.lit(label)).otherwise(out)
    return out


def append_note(*parts: Column) -> Column:
    return F.concat_ws(" | ", *[blank_to_null(p) for p in parts])


def replace_topology_note(notes: Column, edit: Column) -> Column:
    base = F.substring_index(F.coalesce(notes, F.lit("")), " | topology:", 1)
    return F.concat(base, F.lit(" | topology: "), edit)


def verdict_text(confidence: Column, n: Column, ratio: Column, limit: float = 0.06) -> Column:
    """Does the sheet's own scale check confirm the nominal scale?"""
    return (F.when(confidence == "low", F.format_string("unverified (%d dimensions read)", n))
            .when(F.abs(ratio - 1.0) <= limit, F.format_string("verified (n=%d, ratio=%.3f)", n, ratio))
            .otherwise(F.concat(F.format_string("MISMATCH - check manually (n=%d, ratio=", n),
                                F.coalesce(ratio.cast("string"), F.lit("None")), F.lit(")"))))
