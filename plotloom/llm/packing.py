"""Packing by minimum bin slack: whole windows first, then multisets of remainders that fill each window closest.

A document's ids are cut at every CAPACITY; what is left over is one of CAPACITY - 1 lengths, so the whole corpus comes down
to one count per length. A bitset subset-sum picks the multiset of lengths that fills a window closest to its capacity, the
counts it used are traced back, and it is used as often as the counts allow. Pieces are numbered within their length, and
their number says which window of which multiset they stand in.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plotloom.llm.common import as_rows, ranked, saved
from plotloom.llm.tokens import encoder, vocabulary_path

CAPACITY, END = 1024, 0
#: Rows of a length that are numbered together.
NUMBERED = 200_000
#: Texts of a batch that are encoded together hold so many characters at most (one text alone may be longer).
CHARS = 4_000_000


def pieces(docs: DataFrame, path: str | None = None, with_ids: bool = False, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, its ids.

    Every document ends with the id END; a null or empty text is that id alone. ``ids`` holds little-endian 32-bit numbers.
    """
    path = path or vocabulary_path()
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            sizes = pa.compute.fill_null(pa.compute.utf8_length(whole.column("text")), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes, dtype=np.int64) // CHARS
            for g in np.unique(group):
                at = int(np.searchsorted(group, g))
                b = whole.slice(at, int((group == g).sum()))
                rows: list[tuple] = []
                for doc, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text").to_pylist()), strict=True):
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    for s in range(0, len(ids), capacity):
                        part = ids[s:s + capacity].tobytes()
                        rows.append((doc, s, len(part) // 4, zlib.crc32(part), len(ids), part)[:6 if with_ids else 5])
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(rows[0])]
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names)
    return as_rows(docs).select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text")).mapInArrow(run, fields)


def closest_multiset(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length fill the window closest to its capacity, at least one of the longest among them.

    Bit s of the set of sums is 1 if some multiset sums to s. Counts enter as 1, 2, 4, ... copies, the longest lengths first,
    and the sets before each of them are kept to trace the choice back.
    """
    longest = max(counts)
    room = capacity - longest
    sums, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, copies = min(counts[length] - (length == longest), room // length), 1
        while left > 0 and not sums >> room & 1:
            n = min(copies, left)
            steps.append((sums, length, n))
            sums |= sums << n * length & (1 << room + 1) - 1
            left, copies = left - n, copies * 2
    at, used = sums.bit_length() - 1, {longest: 1}
    for before, length, n in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + n
            at -= n * length
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(times, multiset) until no piece is left. Each multiset uses up one length at least, so their number is bounded by lengths."""
    left, out = {k: n for k, n in counts.items() if n}, []
    while left:
        used = closest_multiset(left, capacity)
        times = min(left[k] // n for k, n in used.items())
        out.append((times, used))
        for k, n in used.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
    return out


def places(patterns: list[tuple[int, dict[int, int]]], first: int) -> dict[int, np.ndarray]:
    """For each length, rows (first number, first sequence, pieces in a sequence, offset), by number."""
    rows: dict[int, list] = {}
    taken: dict[int, int] = {}
    for times, used in patterns:
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            rows.setdefault(length, []).append((taken.get(length, 0), first, n, offset))
            taken[length] = taken.get(length, 0) + times * n
            offset += n * length
        first += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def packed(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (each row a piece with doc_id, start, length, ids_crc32) with sequence_id and offset.

    What comes to the driver is one count for each length up to ``capacity``, whatever the input.
    """
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    full = counts.pop(capacity, 0)
    where = places(plan(counts, capacity), full) | ({capacity: np.array([(0, 0, 1, 0)], np.int64)} if full else {})
    salts = max(16, -(-max([full, *counts.values()], default=0) // NUMBERED))
    numbered = ranked(parts, "length", ["doc_id", "start", "ids_crc32"], "number", salts)
    names = list(parts.columns)
    fields = StructType([*parts.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            seq, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                table = where[int(size)]
                row = table[np.searchsorted(table[:, 0], number[at], "right") - 1]
                own = number[at] - row[:, 0]
                seq[at], offset[at] = row[:, 1] + own // row[:, 2], row[:, 3] + own % row[:, 2] * size
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(seq), pa.array(offset)], [*names, "sequence_id", "offset"])
    return numbered.mapInArrow(run, fields)


def pack(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """All documents as pieces with their sequence and offset; nulls as in ``pieces``, repeated rows are packed each."""
    return packed(saved(pieces(docs, path, with_ids), "pieces"))


def sequences(parts: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths): the packed rows themselves, from pieces that carry their ids. A row holds CAPACITY ids at most."""
    own = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return parts.groupBy("sequence_id").agg(own.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"), F.transform("p", lambda x: x["length"]).alias("lengths"))
