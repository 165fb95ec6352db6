"""Quality rules with DataFrame functions only: repetition within a text, and lines that many documents of a host share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows, row_keys

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line goes if more distinct documents of its host hold it than this many, and than this share (in percent) of them.
MIN_DOCS, MAX_SHARE = 20, 8
#: A document is depleted if removed lines hold over this share (in percent) of its words, or fewer words than this are left.
MAX_REMOVED, MIN_LEFT = 70, 10


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often ``body`` and its lambdas use it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)


def repeated_words(ws: Column, window: int = 5) -> Column:
    """How many words stand in a window of so many words that the text holds twice or more."""
    def spans(wins: Column) -> Column:      # windows as hashes in text order
        ordered = F.sort_array(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            def twin(x: Column, j: Column) -> Column:
                return F.get(s, j - 1)["h"].eqNullSafe(x["h"]) | F.get(s, j + 1)["h"].eqNullSafe(x["h"])
            return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last"))
        step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n"), i.alias("last"))
        covered = F.aggregate(_let(ordered, positions), start, step, lambda acc: acc["n"])
        return F.when(F.size(F.array_distinct(wins)) == F.size(wins), F.lit(0).cast("long")).otherwise(covered)

    def windows(hs: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(hs) - window)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(hs, i + k) for k in range(window)]))
    some = _let(F.transform(ws, lambda w: F.xxhash64(w)), lambda hs: _let(windows(hs), spans))
    return F.when(F.size(ws) < window, F.lit(0).cast("long")).otherwise(some)


def measured(rows: DataFrame) -> DataFrame:
    """Replace ``text`` by what the base rules need: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    rest = [c for c in rows.columns if c != "text"]
    split = rows.select(*rest, words(F.col("text")).alias("ws"), lines(F.col("text")).alias("ls"),
                        (F.size(F.split(F.col("text"), r"[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"))
    counted = split.select(
        *rest, F.size("ws").cast("long").alias("n_words"), F.length(F.array_join("ws", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"), repeated_words(F.col("ws")).alias("n_repeat_words"))
    return counted.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))


def _line_rows(rows: DataFrame) -> DataFrame:
    """A row for each line with a word: its document, host, place, hash of the normalised line, words."""
    plain = lambda x: F.regexp_replace(F.regexp_replace(F.translate(F.btrim(x, F.lit(SPACE)), UPPER, LOWER), SPACES, " "), "[0-9]+", "0")
    each = F.posexplode(F.split(F.col("text"), "\n"))
    at = rows.select("k1", "k2", "host", "content", each.alias("pos", "line")).filter(F.length(F.btrim("line", F.lit(SPACE))) > 0)
    return at.select("k1", "k2", "host", "content", "pos", F.xxhash64(plain(F.col("line"))).alias("line"), F.size(words(F.col("line"))).alias("n"))


def shared_lines(rows: DataFrame) -> DataFrame:
    """(k1, k2, pos, n): the lines above the limits, by document. Copies of one text count as one document.

    Distinct (host, line, text) come first, so a line that a third of all documents share is summed up before it is counted.
    """
    each = _line_rows(rows)
    held = each.select("host", "line", "content").distinct().groupBy("host", "line").agg(F.count("*").alias("docs"))
    hosts = rows.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("of"))
    above = held.filter(F.col("docs") > MIN_DOCS).join(hosts, "host").filter(100 * F.col("docs") > MAX_SHARE * F.col("of"))
    return each.join(above.select("host", "line"), ["host", "line"]).groupBy("k1", "k2", "pos").agg(F.max("n").alias("n"))


def _keyed(docs: DataFrame) -> DataFrame:
    source = F.col("row.source")
    return as_rows(docs).select("row", *row_keys(), F.xxhash64(source, source.isNull()).alias("host"),
                                F.xxhash64("row.text").alias("content"), F.coalesce("row.text", F.lit("")).alias("text"))


def _removed(keyed: DataFrame) -> DataFrame:
    hits = shared_lines(keyed.select("k1", "k2", "host", "content", "text"))
    return hits.groupBy("k1", "k2").agg(F.sum("n").alias("removed"), F.collect_set("pos").alias("gone"))


def _judged(measures: DataFrame, removed: DataFrame) -> DataFrame:
    depleted = F.expr(f"100 * removed > {MAX_REMOVED} * n_words or n_words - removed < {MIN_LEFT}")
    both = measures.join(removed, ["k1", "k2"], "left").withColumn("removed", F.coalesce("removed", F.lit(0).cast("long")))
    return both.withColumn("kept", ~F.col("base_failed") & ~depleted)


def verdicts(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text, source, anything else) with its counts, base_failed and kept.

    Null and blank texts have no words and fail the base rules; a null source is a host of its own; repeated rows each get
    their row and count as one document of their host; an empty table gives an empty result.
    """
    keyed = _keyed(docs)
    rows = keyed.select("k1", "k2", F.col("row.doc_id").alias("doc_id"), "text")
    judged = _judged(measured(rows), _removed(keyed).drop("gone"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed")


def cleaned(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` without the lines above the limits, same columns; an n_chars column follows the new text."""
    keyed = _keyed(docs)
    judged = _judged(measured(keyed.select("k1", "k2", "row", "text")), _removed(keyed)).filter("kept")
    left = F.array_join(F.filter(F.split("row.text", "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(left)
    new = {"text": text, "n_chars": F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(F.length(text).cast("long"))
           if "n_chars" in docs.columns else None}
    return judged.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


SQL = f"""
with d as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as text, text as raw,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
l0 as (select rid, source, raw, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from d),
l as (select *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) as n,
    regexp_replace(translate(array_to_string(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), ' '), '{UPPER}', '{LOWER}'), '[0-9]+', '0', 'g') as norm
    from l0 where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup as (select rid, count(*) - count(distinct line) as n_dup_lines from l group by rid),
w as (select rid, unnest(ws) as word, unnest(range(len(ws))) as i from d),
five as (select rid, i, word || ' ' || lead(word, 1) over t || ' ' || lead(word, 2) over t || ' ' || lead(word, 3) over t || ' ' || lead(word, 4) over t as win
    from w window t as (partition by rid order by i)),
win as (select rid, i, count(*) over (partition by rid, win) as times from five where win is not null),
rep as (select rid, count(distinct p) as n_repeat_words from (select rid, unnest(range(i, i + 5)) as p from win where times > 1) group by rid),
hosts as (select source, count(distinct coalesce('t' || raw, 'n')) as docs from d group by source),
above as (select l.source, norm from l join hosts h on l.source is not distinct from h.source group by l.source, norm, docs
    having count(distinct raw) > {MIN_DOCS} and 100 * count(distinct raw) > {MAX_SHARE} * docs),
gone as (select rid, sum(n) as removed from l join above a on l.norm = a.norm and l.source is not distinct from a.source group by rid),
m as (select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(removed, 0)::bigint as removed
    from d left join dup using (rid) left join rep using (rid) left join gone using (rid)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and not (100 * removed > {MAX_REMOVED} * n_words or n_words - removed < {MIN_LEFT}) as kept, removed from b
"""
