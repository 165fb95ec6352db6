"""Sharding by extendible hashing: a bucket splits on the next bit of its hash prefix only while it is over the byte limit."""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows, ranked, saved

BITS = 60
LIMIT = 4 << 20


def _prefix(depth: int) -> Column:
    return F.shiftright("h", BITS - depth)


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, h, bytes): the first BITS bits of the md5 of doc_id and text, and the text's bytes (null: 0)."""
    key = F.concat(F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("row.text", F.lit("")))
    h = F.conv(F.substring(F.md5(key.cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    return as_rows(docs).select(F.col("row.doc_id").cast("long").alias("doc_id"), h.alias("h"), F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("bytes"))


def _sums(cells: DataFrame, depth: int) -> DataFrame:
    return cells.groupBy(_prefix(depth).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("h").alias("low"), F.max("h").alias("high"))


def buckets(cells: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(depth, prefix, bytes, n, low, high): buckets that fit the limit, or whose rows share one hash and can't be parted by bits.

    The depth at which the rounds begin is guessed from the total and then lowered until no bucket above it fits, so every
    bucket has the least depth that will do. Each round reads only the rows of buckets still above the limit.
    """
    total = cells.agg(F.sum("bytes")).first()[0] or 0
    depth = max(0, int(math.log2(max(1, total / limit))) - 1)
    while depth and not _sums(cells, depth - 1).filter(f"bytes <= {limit} or low = high").isEmpty():
        depth -= 1
    done, left = [], cells
    while True:
        sums = saved(_sums(left, depth), "buckets")
        done.append(sums.filter(f"bytes <= {limit} or low = high").select(F.lit(depth).alias("depth"), "*"))
        over = sums.filter(f"not (bytes <= {limit} or low = high)").select("prefix")
        if over.isEmpty():
            return reduce(DataFrame.unionByName, done)
        left = left.join(over, _prefix(depth) == F.col("prefix"), "left_semi")
        depth += 1


def sharded(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, depth, prefix, part, bytes for every row of ``docs``: (depth, prefix, part) names a shard of at most ``limit`` bytes.

    Rows that share one hash are copies of one row; those beyond the limit go to parts 0, 1, ... of their bucket, numbered over
    sub-keys so that no task holds them all. A text longer than the limit is alone in its part. Null texts weigh nothing; an
    empty table gives an empty result.
    """
    cells = saved(hashed(docs), "hashed")
    made = saved(buckets(cells, limit), "directory")
    depths = [r.depth for r in made.select("depth").distinct().collect()]      # a few: the least and those of splits
    at = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in depths])) if depths else F.explode(F.array(F.struct(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"))))
    placed = cells.select("*", at.alias("at")).select("doc_id", "h", F.col("bytes").alias("size"), "at.*")
    joined = placed.join(made.select("depth", "prefix", F.col("bytes").alias("all")), ["depth", "prefix"])
    fit = joined.filter(f"all <= {limit}").withColumn("part", F.lit(0).cast("long"))
    copies = ranked(joined.filter(f"all > {limit}"), "h", ["doc_id", "size"], "number")
    parted = copies.withColumn("part", F.expr(f"number div greatest(1, {limit} div greatest(size, 1))").cast("long"))
    cols = ["doc_id", "depth", "prefix", "part", F.col("size").alias("bytes")]
    return fit.select(*cols).unionByName(parted.select(*cols))


SQL = f"""
with c as (select row_number() over () as rid, doc_id, ('0x' || substr(md5(coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')), 1, {BITS // 4}))::bigint as h,
    coalesce(strlen(text), 0)::bigint as size from documents),
cells as (select c.*, d::integer as depth, h >> ({BITS} - d) as prefix from c, (select unnest(range(0, 41)) as d)),
s as (select depth, prefix, sum(size) as bytes, min(h) as low, max(h) as high from cells group by depth, prefix),
f as (select cells.*, bytes, row_number() over (partition by rid order by cells.depth) as k from cells join s using (depth, prefix) where bytes <= {LIMIT} or low = high),
n as (select *, row_number() over (partition by h order by rid) - 1 as number from f where k = 1)
select doc_id, depth, prefix, case when bytes <= {LIMIT} then 0 else number // greatest(1, {LIMIT} // greatest(size, 1)) end::bigint as part, size as bytes from n
"""
