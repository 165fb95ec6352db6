"""Benchmark decontamination: every suffix of the test items is looked up in suffix arrays over shards of the documents.

A shard is a run of whole documents of about SHARD words within a task. Its suffix array is sparse: it holds the suffixes
whose first words are also the first words of some test suffix, the only ones a test suffix can meet, sorted by as many words
as a window has. Two binary searches for each test suffix give the range of its occurrences, and so their places.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows, from_rows

WINDOW = 13
SHARD = 1 << 20
#: Test items go to the tasks in blocks of so many bytes at most (one item alone may be larger); every block meets all documents.
BLOCK = 2 << 20
LEAD = 3

#: Bytes of words stay, A-Z in lower case; everything else parts words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All of start[i], start[i] + 1, ... (size[i] of them), one run after another."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class TestSuffixes:
    """The distinct windows of a block of items by their length, sorted, and the items that hold each."""

    __test__ = False

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        held: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
        for name, ws in items:
            ids = np.array([self.vocab[w] for w in ws], ">u4")
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                held.setdefault(size, {}).setdefault(ids[at:at + size].tobytes(), []).append((place[name], at))
        self.groups = []
        for size, wins in sorted(held.items()):
            keys = sorted(wins)
            rows = np.frombuffer(b"".join(keys), ">u4").reshape(-1, size).astype(np.int64)
            lead = np.unique(self.codes(rows[:, :LEAD].ravel(), min(LEAD, size))[::min(LEAD, size)])
            seen = np.zeros(1 << 20, bool)
            seen[self.slot(lead)] = True
            of = [sorted({i for i, _ in wins[k]}) for k in keys]
            self.groups.append((size, np.array(keys, f"S{4 * size}"), lead, seen, np.cumsum([0, *map(len, of)]), np.array([i for o in of for i in o], np.int64),
                                np.array([wins[k][0] for k in keys], np.int64)))

    def codes(self, ids: np.ndarray, lead: int) -> np.ndarray:
        """One number for each run of ``lead`` ids."""
        n = max(0, len(ids) - lead + 1)
        code = ids[:n].astype(np.int64)
        for j in range(1, lead):
            code = code * (len(self.vocab) + 1) + ids[j:n + j]
        return code

    @staticmethod
    def slot(code: np.ndarray) -> np.ndarray:
        return (code ^ code >> 20 ^ code >> 40) & (1 << 20) - 1

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple]]:
        """For each length of windows: the length, places in ``ids``, which window stands there, and its group."""
        for group in self.groups:
            size, keys, lead, seen = group[:4]
            code = self.codes(ids, min(LEAD, size))
            at = np.flatnonzero(seen[self.slot(code)])
            at = at[at + size <= len(ids)]
            at = at[lead[np.minimum(np.searchsorted(lead, code[at]), len(lead) - 1)] == code[at]]
            suffixes = np.ascontiguousarray(ids[at[:, None] + np.arange(size)].astype(">u4")).view(f"S{4 * size}").ravel()
            order = np.argsort(suffixes)
            ordered = suffixes[order]
            low, high = np.searchsorted(ordered, keys, "left"), np.searchsorted(ordered, keys, "right")
            found = at[order[_ragged(low, high - low)]]
            which = np.repeat(np.arange(len(keys)), high - low)
            by = np.argsort(found)
            yield size, found[by], which[by], group


def _longest(size: int, found: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Windows that follow each other in the document and in an item, joined: (item, place in it, place, words)."""
    if not len(found):
        return []
    cut = np.flatnonzero((np.diff(found) != 1) | (np.diff(first[:, 0]) != 0) | (np.diff(first[:, 1]) != 1)) + 1
    starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(found)]])
    return [(int(first[s, 0]), int(first[s, 1]), int(found[s]), int(e - s - 1 + size)) for s, e in zip(starts, ends, strict=True)]


def _search(test: TestSuffixes, texts: list[bytes | None], before: list[dict]) -> list[dict]:
    """What the shard of these documents holds of the test items, joined with what earlier blocks found in them."""
    parts, sizes = [], []
    for t in texts:
        ws = words_of(t)
        sizes.append(len(ws))
        parts.append(np.fromiter((test.vocab.get(w, 0) for w in ws), np.int64, len(ws)))
        parts.append(np.zeros(1, np.int64))
    ids = np.concatenate(parts)
    starts = np.cumsum([0, *(n + 1 for n in sizes)])
    cover = np.zeros(len(ids) + 1, np.int32)
    names: list[set] = [set(b["items"] or ()) for b in before]
    longest: list[list] = [list(b["matches"] or ()) for b in before]
    for d, b in enumerate(before):
        for s, e in zip((b["spans"] or [])[::2], (b["spans"] or [])[1::2], strict=True):
            cover[starts[d] + s] += 1
            cover[starts[d] + e] -= 1
    for size, found, which, (*_, bounds, items, first) in test.occurrences(ids):
        np.add.at(cover, found, 1)
        np.add.at(cover, found + size, -1)
        docs = np.searchsorted(starts, found, "right") - 1
        pairs = np.unique(docs * len(bounds) + which)
        for d, w in zip((pairs // len(bounds)).tolist(), (pairs % len(bounds)).tolist(), strict=True):
            names[d].update(test.names[i] for i in items[bounds[w]:bounds[w + 1]])
        for item, place, at, n in _longest(size, found, first[which]):
            d = int(np.searchsorted(starts, at, "right")) - 1
            longest[d].append({"item_id": test.names[item], "item_word": place, "doc_word": int(at - starts[d]), "n_words": n})
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    owner = np.searchsorted(starts, edge[::2], "right") - 1
    spans: list[list[int]] = [[] for _ in texts]
    for d, s, e in zip(owner.tolist(), edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        spans[d] += [s - int(starts[d]), e - int(starts[d])]
    return [{"n_words": n, "n_hit": sum(s[1::2]) - sum(s[::2]), "spans": s, "items": sorted(i), "matches": m}
            for n, s, i, m in zip(sizes, spans, names, longest, strict=True)]


FOUND = ("struct<n_words:bigint,n_hit:bigint,spans:array<int>,items:array<string>,"
         "matches:array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>>")


def _blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The test items with words, in blocks whose size is checked before they come to the driver."""
    size = F.octet_length("text") + F.octet_length("name") + 8
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text").filter("text is not null").distinct()
    n = 1
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(n)))
        worst = dealt.groupBy("block").agg(F.sum(size).alias("bytes"), F.count("*").alias("items")).filter(f"bytes > {most} and items > 1").limit(1).collect()
        if not worst:
            break
        n *= 2
    for i in range(n):
        yield [(r.name, words_of(bytes(r.text, "utf-8"))) for r in dealt.filter(F.col("block") == i).select("name", "text").collect()]


def searched(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(row, found) for every row of ``docs``: its word count, words hit, hit spans, items and longest matches.

    A document word is hit if it stands inside an occurrence of ``window`` consecutive words of an item, or of a whole shorter
    item. Null or wordless texts have no words; items that are null or wordless occur nowhere; items with a null item_id count
    as '', those with the same item_id as one item. Longest matches are told for the first item that holds them.
    """
    out = as_rows(docs).select("row", F.lit(None).cast(FOUND).alias("found"))
    schema = out.schema
    for items in _blocks(benchmark, block):
        test = docs.sparkSession.sparkContext.broadcast(TestSuffixes(items, window))

        def run(batches: Iterator[pa.RecordBatch], test=test) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                texts = whole.column("row").field("text").cast(pa.large_binary())
                size = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)) // 6 + 1)
                shard = np.searchsorted(np.arange(0, size[-1] + SHARD, SHARD), size) if len(size) else size
                for s in np.unique(shard):
                    at, n = int(np.searchsorted(shard, s)), int((shard == s).sum())
                    b = whole.slice(at, n)
                    before = [x or {"items": (), "matches": (), "spans": ()} for x in b.column("found").to_pylist()]
                    found = pa.array(_search(test.value, texts.slice(at, n).to_pylist(), before), whole.schema.field("found").type)
                    yield pa.RecordBatch.from_arrays([b.column("row"), found], schema=pa.schema([whole.schema.field("row"), whole.schema.field("found")]))
        out = out.mapInArrow(run, schema)
    return out


CONTAMINATED = "found.n_hit > 0 and 20 * found.n_hit >= found.n_words"


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): words, words hit, items and whether it is contaminated (a twentieth hit)."""
    at = searched(docs.select("doc_id", "text"), benchmark)
    return at.select("row.doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
                     F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), F.expr(CONTAMINATED).alias("contaminated"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each longest verbatim match: doc_id, item_id, its place in words in either, its words."""
    at = searched(docs.select("doc_id", "text"), benchmark)
    return at.select("row.doc_id", F.explode("found.matches").alias("m")).select("doc_id", "m.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows, same columns. Documents are not shuffled."""
    return from_rows(searched(docs, benchmark).filter(f"not ({CONTAMINATED})"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
with d as (select row_number() over () as rid, doc_id, coalesce({_WORDS}, []) as ws from documents),
b as (select distinct item_id::varchar as item, {_WORDS} as ws from benchmark),
sizes as (select distinct least({WINDOW}, len(ws)) as n from b where len(ws) > 0),
iw as (select distinct item, least({WINDOW}, len(ws)) as n, array_to_string(ws[i:i + least({WINDOW}, len(ws)) - 1], ' ') as win
    from (select item, ws, unnest(range(1, len(ws) - least({WINDOW}, len(ws)) + 2)) as i from b where len(ws) > 0)),
lead as (select distinct split_part(win, ' ', 1) as word from iw),
dw as (select rid, i, n, array_to_string(ws[i:i + n - 1], ' ') as win
    from (select rid, ws, unnest(range(1, len(ws) + 1)) as i from d) x join lead on ws[i] = word, sizes where i + n - 1 <= len(ws)),
hits as (select rid, i, dw.n, item from dw join iw on dw.n = iw.n and dw.win = iw.win),
hit as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + n)) as p from hits) group by rid),
its as (select rid, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by rid)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join hit using (rid) left join its using (rid)
"""
