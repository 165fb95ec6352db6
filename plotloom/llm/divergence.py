"""How far the sources of a language differ in their words: single-pass in-memory indexing, then exact sums over pairs of sources.

Tasks count words in memory until a block is full, and spill it as runs sorted by term, one for each hash shard. A shard's runs come
back in the order of their first terms and are merged through a heap, which yields each term's frequency in every source. All
numbers from there on are whole: a pair's distance is what it would be if the two sources shared no word, which sums per source
tell, plus a correction for each shared word, and the corrections are streamed term by term.
"""

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows, saved

#: A language keeps the terms of at least so many of its documents; a report lists so many terms of a source.
LEAST_DOCS, TOP = 30, 50
#: Probabilities are whole parts of SCALE, with SMOOTH added to each count.
SCALE, SMOOTH = 1_000_000_000, 5
#: Postings (a term in a source) that a block holds, terms in one piece of a run, and bytes of text split at once.
BLOCK, PIECE, SLICE = 500_000, 2_048, 1 << 20
#: Pair corrections that a task holds before it adds them up.
PAIRS = 2_000_000

#: Bytes that are no letter become blanks, A-Z become a-z; what is beyond ASCII stays.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def _terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time."""
    plain, at = text.encode().translate(_LETTERS), 0
    while at < len(plain):
        to = len(plain) if len(plain) - at <= SLICE else plain.find(b" ", at + SLICE)
        to = len(plain) if to < 0 else to
        yield plain[at:to].split()
        at = to


class Block:
    """Term counts and document counts by (lang, source), as many as memory allows."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.postings = 0

    def add(self, lang: str, source: str, text: str) -> None:
        times, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before, distinct = len(times), set()
        for terms in _terms(text):
            times.update(terms)
            distinct.update(terms)
        docs.update(distinct)
        self.postings += len(times) - before

    def runs(self, shards: int) -> Iterator[pa.RecordBatch]:
        """The block as pieces of runs (see RUN), by language and shard and sorted by term; the block is empty afterwards."""
        by_lang: dict[str, list[tuple[str, Counter, Counter]]] = {}
        for (lang, source), (times, docs) in self.groups.items():
            by_lang.setdefault(lang, []).append((source, times, docs))
        self.__init__()
        for lang, groups in by_lang.items():
            number: dict[bytes, int] = {}
            ids = np.fromiter((number.setdefault(t, len(number)) for _, times, _ in groups for t in times), np.int64)
            if not len(ids):
                continue
            n = np.concatenate([np.fromiter(times.values(), np.int64, len(times)) for _, times, _ in groups])
            docs = np.concatenate([np.fromiter(map(held.__getitem__, times), np.int64, len(times)) for _, times, held in groups])
            source = np.repeat(np.arange(len(groups), dtype=np.int32), [len(times) for _, times, _ in groups])
            salt = zlib.crc32(lang.encode())
            order = sorted((zlib.crc32(t, salt) % shards, t, k) for t, k in number.items())
            rank = np.empty(len(order), np.int64)
            rank[[k for _, _, k in order]] = np.arange(len(order))
            at = rank[ids]
            by_term = np.argsort(at, kind="stable")
            sizes, held = np.bincount(at), np.bincount(at, docs).astype(np.int64)
            shard = np.array([x for x, _, _ in order], np.int32)
            starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            cuts = np.unique(np.concatenate([starts, *(np.arange(a, b, PIECE) for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True))]))
            ends = np.append(cuts, len(order)).astype(np.int32)
            upto = np.append(0, np.cumsum(sizes))[ends].astype(np.int32)
            terms = pa.array([t for _, t, _ in order], pa.binary())
            parts = len(cuts)
            yield pa.RecordBatch.from_arrays([
                pa.array(shard[cuts]), pa.array([lang] * parts, pa.string()), terms.take(pa.array(cuts)), pa.ListArray.from_arrays(ends, terms),
                pa.ListArray.from_arrays(ends, pa.array(sizes.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(held)),
                pa.array([[g[0] for g in groups]] * parts, pa.list_(pa.string())), pa.ListArray.from_arrays(upto, pa.array(source[by_term])),
                pa.ListArray.from_arrays(upto, pa.array(n[by_term]))], _RUN_NAMES)


#: A piece of a run: its terms in order, how many sources each has here, how many documents; then the sources' names, and by
#: term and source a number of a name and a count.
RUN = ("shard int, lang string, first binary, terms array<binary>, sizes array<int>, held array<long>, names array<string>, "
       "sources array<int>, n array<long>")
_RUN_NAMES = [f.split(" ")[0] for f in RUN.split(", ")]


def spilled(rows: DataFrame, shards: int, most: int = BLOCK) -> DataFrame:
    """Runs of all blocks of ``rows`` (lang, source, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for lang, source, text in zip(*[batch.column(c) for c in ("lang", "source", "text")], strict=True):
                block.add(lang.as_py(), source.as_py(), text.as_py())
                if block.postings >= most:
                    yield from block.runs(shards)
        yield from block.runs(shards)
    return rows.select("lang", "source", "text").mapInArrow(run, RUN)


def pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch of RUN as (shard, lang, terms, ends, held, names, sources, n); the last two stay arrays."""
    def lists(name: str, plain: bool) -> list:
        column = batch.column(name)
        flat, ends = column.flatten(), np.append(0, np.cumsum(pa.compute.list_value_length(column).to_numpy()))
        flat = flat.to_pylist() if plain else flat.to_numpy()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]
    ends = [np.append(0, np.cumsum(x)).tolist() for x in lists("sizes", False)]
    yield from zip(batch.column("shard").to_pylist(), batch.column("lang").to_pylist(), lists("terms", True), ends, lists("held", True),
                   batch.column("names").to_pylist(), lists("sources", False), lists("n", False), strict=True)


def merged(runs: Iterator[tuple], least: int = 0) -> Iterator[tuple[str, bytes, dict[str, int]]]:
    """(lang, term, {source: n}) of terms that ``least`` documents hold, from pieces that come in the order of (shard, lang, first term).

    The heap holds the piece of each run that is open now: a piece joins when its first term is next, and leaves when it is used
    up. Counts by source are only looked at for terms that enough documents hold.
    """
    heap, opened = [], 0

    def until(limit: tuple | None) -> Iterator[tuple]:
        while heap and (limit is None or heap[0][:3] < limit):
            key, docs, found = heap[0][:3], 0, []
            while heap and heap[0][:3] == key:
                shard, lang, _, number, k, piece = heap[0]
                docs += piece[4][k]
                found.append((piece, k))
                if k + 1 < len(piece[2]):
                    heapq.heapreplace(heap, (shard, lang, piece[2][k + 1], number, k + 1, piece))
                else:
                    heapq.heappop(heap)
            if docs >= least:
                sums: dict[str, int] = {}
                for piece, k in found:
                    a, b = piece[3][k], piece[3][k + 1]
                    for source, n in zip(piece[6][a:b].tolist(), piece[7][a:b].tolist(), strict=True):
                        name = piece[5][source]
                        sums[name] = sums.get(name, 0) + n
                yield key[1], key[2], sums
    for piece in runs:
        first = (piece[0], piece[1], piece[2][0])
        yield from until(first)
        opened += 1
        heapq.heappush(heap, (*first, opened, 0, piece))
    yield from until(None)


def frequencies(rows: DataFrame, least: int = LEAST_DOCS, most: int = BLOCK) -> DataFrame:
    """(lang, term, sources, counts) of the terms that at least ``least`` documents of their language hold."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    runs = spilled(rows, 4 * parts, most).repartition(parts, "shard").sortWithinPartitions("shard", "lang", "first")

    def table(kept: list[tuple]) -> pa.RecordBatch:
        langs, terms, sources, counts = zip(*kept, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                                           pa.array(sources, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))], ["lang", "term", "sources", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for lang, term, sums in merged((p for b in batches for p in pieces(b)), least):
            kept.append((lang, term, list(sums), list(sums.values())))
            size += len(sums)
            if size > 50_000:
                yield table(kept)
                kept, size = [], 0
        if kept:
            yield table(kept)
    return runs.mapInArrow(run, "lang string, term string, sources array<string>, counts array<long>")


def _probability(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), whole numbers all the way."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({count} + {SMOOTH} as decimal(19, 0))) div cast({total} + {SMOOTH} * {terms} as decimal(19, 0))")


def corrections(points: DataFrame) -> DataFrame:
    """(lang, s, t, more): summed corrections of the pairs of sources s < t that share terms; ``points`` has a list for each term.

    For a shared term with shares p and q, whose sources give absent terms a and b: |p-q| - |p-b| - |q-a| + |a-b|.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[tuple[str, str], int] = {}
        keys, values, held = [], [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
            order = np.argsort(at, kind="stable")
            return pairs, np.add.reduceat(np.concatenate(values)[order], np.searchsorted(at[order], np.arange(len(pairs))))

        def out(pairs: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            names = list(number)
            told = [(names[x >> 32][0], *sorted((names[x >> 32][1], names[x & 0xFFFFFFFF][1]))) for x in pairs.tolist()]
            columns = [pa.array(c, pa.string()) for c in zip(*told, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(sums)], ["lang", "s", "t", "more"])
        for batch in batches:
            points = batch.column("points")
            sizes = pa.compute.list_value_length(points).to_numpy().astype(np.int64)
            first = np.append(0, np.cumsum(sizes))[:-1]
            flat = points.flatten()
            langs, codes = batch.column("lang").dictionary_encode(), flat.field("source").dictionary_encode()
            both = np.repeat(langs.indices.to_numpy().astype(np.int64), sizes) << 32 | codes.indices.to_numpy().astype(np.int64)
            pairs, back = np.unique(both, return_inverse=True)
            lang_names, source_names = langs.dictionary.to_pylist(), codes.dictionary.to_pylist()
            known = np.array([number.setdefault((lang_names[x >> 32], source_names[x & 0xFFFFFFFF]), len(number)) for x in pairs.tolist()], np.int64)
            ids, p, a = known[back], flat.field("p").to_numpy(), flat.field("absent").to_numpy()
            for k in np.unique(sizes).tolist():     # terms with the same number of sources go together
                rows = first[sizes == k]
                for left in range(k - 1):
                    step = max(1, PAIRS // (k - 1 - left))
                    for m in range(0, len(rows), step):
                        x = rows[m:m + step, None] + left
                        y = x + np.arange(1, k - left)
                        keys.append((np.minimum(ids[x], ids[y]) << 32 | np.maximum(ids[x], ids[y])).ravel())
                        values.append((abs(p[x] - p[y]) - abs(p[x] - a[y]) - abs(p[y] - a[x]) + abs(a[x] - a[y])).ravel())
                        held += len(keys[-1])
                        if held > PAIRS:
                            found, sums = added()
                            keys, values, held = [found], [sums], len(found)
                            if held > PAIRS // 2:
                                yield out(found, sums)
                                keys, values, held = [], [], 0
        if held:
            yield out(*added())
    made = points.select("lang", "points").filter(F.size("points") > 1).mapInArrow(run, "lang string, s string, t string, more long")
    return made.groupBy("lang", "s", "t").agg(F.sum("more").alias("more"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, most: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank for ``docs`` (lang, source, text, anything else).

    Part ``pair`` ranks every other source of the language by distance, part ``term`` the ``top`` terms that a source has more of
    than its language. Nulls count as ''; a source without terms has its pairs, too; where a language keeps no term all its
    distances are 0. Repeated rows count each; ties rank by item; an empty table gives an empty result.
    """
    plain = [F.coalesce(F.col(f"row.`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    rows = as_rows(docs).select(*plain)
    kept = saved(frequencies(rows, least, most), "frequencies")
    total = F.expr("aggregate(counts, 0L, (s, n) -> s + n)")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum(total).alias("lang_total"))
    each = kept.select("lang", "term", total.alias("lang_n"), F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    each = each.select("lang", "term", "lang_n", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    sums = each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    every = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    every = every.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])
    groups = saved(every.withColumn("absent", F.when(F.col("terms") > 0, _probability("0L", "total", "terms")).otherwise(zero)), "groups")
    shares = each.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "absent", _probability("n", "total", "terms").alias("p"), _probability("lang_n", "lang_total", "terms").alias("q"))
    shares = saved(shares, "shares")

    apart = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = apart.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    # |p - b| over a source's own terms: sum of p - b, and twice b - p where p is below b, from running sums over its distinct p
    other = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("b"))
    pairs = groups.join(other, "lang").filter("source <> item")
    steps = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))
    marks = steps.select("lang", "source", F.col("p").alias("x"), "k", (F.col("k") * F.col("p")).alias("kp"), F.lit(None).cast("string").alias("item"))
    asked = pairs.select("lang", "source", F.col("b").alias("x"), zero.alias("k"), zero.alias("kp"), "item")
    whole = Window.partitionBy("lang", "source")
    upto = whole.orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = marks.unionByName(asked).select("lang", "source", "item", "x", *[F.sum(c).over(w).alias(c + n) for c in ("k", "kp") for w, n in ((upto, "_below"), (whole, ""))])
    alone = run.filter("item is not null").select("lang", "source", "item", "k", F.expr("kp - k * x + 2 * (x * k_below - kp_below)").alias("alone"))
    back = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("k").alias("back_k"), F.col("alone").alias("back"))
    by_term = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "absent")).alias("points"))
    half = corrections(by_term)
    more = half.select("lang", F.col("s").alias("source"), F.col("t").alias("item"), "more").unionByName(
        half.select("lang", F.col("t").alias("source"), F.col("s").alias("item"), "more"))
    key = ["lang", "source", "item"]
    far = pairs.join(alone, key).join(back, key).join(more, key, "left").select(
        *key, F.expr("(terms - k - back_k) * abs(absent - b) + alone + back + coalesce(more, 0L)").alias("value"))
    ranked_pairs = far.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return ranked_pairs.withColumn("part", F.lit("pair")).select(cols).unionByName(best.withColumn("part", F.lit("term")).select(cols))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
with d as (select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as text from documents),
t as (select rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term, count(*) as n from t group by lang, term having count(distinct rid) >= {LEAST_DOCS}),
c as (select lang, source, term, count(*) as n from t semi join k using (lang, term) group by lang, source, term),
v as (select lang, count(*) as terms, sum(n) as total from k group by lang),
s as (select lang, source, sum(n) as total from c group by lang, source),
g as (select lang, source, coalesce(s.total, 0) as total from (select distinct lang, source from d) left join s using (lang, source)),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + ({SCALE}::hugeint * (coalesce(c.n, 0) + {SMOOTH})) // (g.total + {SMOOTH} * v.terms) as p,
    1 + ({SCALE}::hugeint * (k.n + {SMOOTH})) // (v.total + {SMOOTH} * v.terms) as q
    from g join k using (lang) join v using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
far as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(far.value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source
    left join far on far.lang = a.lang and far.source = a.source and far.item = b.source),
u as (select * from pairs union all select lang, source, 'term', term, (p - q)::bigint from p where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank from u)
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= {TOP}
"""
