"""Token ids as packed matrices: best-fit-decreasing over blocks of documents, capacities searched in a segment tree.

A task packs its documents in blocks of whole documents, so nothing is gathered and a lost task is simply packed again. Within a
block, texts longer than a row are cut into full rows and a rest (nothing is lost), pieces are placed longest first, each into
the row with the least room that still holds it, and the segment tree over capacities finds that row in logarithmic time.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows, saved
from plotloom.llm.tokens import encoder, vocabulary_path

ROW, END, PAD = 2048, 0, 0
#: Characters of the documents that are packed together (a longer text is a block by itself).
BLOCK = 4_000_000


class Capacities:
    """Which rows have how much room left: a segment tree over 0 .. most that knows if any row is under a node."""

    def __init__(self, most: int):
        self.half = 1 << most.bit_length()
        self.count = [0] * (2 * self.half)
        self.rows: list[list[int]] = [[] for _ in range(self.half)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = self.half + room
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room of ``least`` or more, taken out; None if there is none."""
        at = self.half + least
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):        # up until a right neighbour has rows
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.half:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.half
        row = self.rows[room].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, row


def best_fit(lengths: list[int], row: int = ROW) -> list[list[int]]:
    """Pieces (by number) of each row, none longer than ``row``; longest first, into the row they fill best."""
    rows = [[i] for i, n in enumerate(lengths) if n == row]     # full rows leave no room to search
    room = Capacities(row)
    for i in sorted((i for i, n in enumerate(lengths) if n < row), key=lambda i: (-lengths[i], i)):
        got = room.take(lengths[i])
        left, at = got if got else (row, len(rows))
        if not got:
            rows.append([])
        rows[at].append(i)
        if left > lengths[i]:
            room.add(left - lengths[i], at)
    return rows


SCHEMA = ("block string, n_rows int, ids binary, cu_rows array<int>, cu_lengths array<int>, doc_ids array<bigint>, starts array<int>")


def blocks(docs: DataFrame, path: str | None = None, row: int = ROW) -> DataFrame:
    """A row for each block: its id matrix and what says which piece is where.

    ``ids`` is n_rows x ``row`` little-endian 16-bit ids (32-bit for vocabularies beyond that), PAD after a row's last piece.
    Row r holds pieces cu_rows[r] to cu_rows[r + 1]; piece p covers ids cu_lengths[p] to cu_lengths[p + 1] counted over pieces
    without padding, belongs to doc_ids[p], and its positions begin at starts[p] (0 for the head of a document).
    Every document ends with the id END; null and empty texts are that id alone. Repeated rows are packed each.
    """
    path = path or vocabulary_path()

    def packed(docs: list[tuple[int | None, np.ndarray]], name: str, kind: str) -> tuple:
        parts = [(d, s, ids[s:s + row]) for d, ids in docs for s in range(0, len(ids), row)]
        rows = best_fit([len(p) for *_, p in parts], row)
        matrix = np.full((len(rows), row), PAD, kind)
        order = [i for r in rows for i in r]
        for r, own in enumerate(rows):
            joined = np.concatenate([parts[i][2] for i in own])
            matrix[r, :len(joined)] = joined
        return (name, len(rows), matrix.tobytes(), np.cumsum([0, *map(len, rows)]).tolist(), np.cumsum([0, *(len(parts[i][2]) for i in order)]).tolist(),
                [parts[i][0] for i in order], [parts[i][1] for i in order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, made = encoder(path), 0
        kind = "<u2" if enc.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        types = [pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
        for whole in batches:
            sizes = pa.compute.fill_null(pa.compute.utf8_length(whole.column("text")), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes, dtype=np.int64) // BLOCK
            for g in np.unique(group):
                b = whole.slice(int(np.searchsorted(group, g)), int((group == g).sum()))
                ids = [np.append(x, np.uint32(END)) for x in enc.encode(b.column("text").to_pylist())]
                made += 1
                values = packed(list(zip(b.column("doc_id").to_pylist(), ids, strict=True)), f"{TaskContext.get().partitionId():06d}-{made:06d}", kind)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)
    return as_rows(docs).select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text")).mapInArrow(run, SCHEMA)


def written(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The blocks, written to the shared folder and read back: what a trainer would load."""
    return saved(blocks(docs, path), "token-blocks")


def pieces(made: DataFrame, row: int = ROW) -> DataFrame:
    """A row for each piece, read out of the matrices: block, row, offset, doc_id, start, length, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids = np.frombuffer(b["ids"], "<u2" if len(b["ids"]) == 2 * row * b["n_rows"] else "<u4").reshape(b["n_rows"], row).astype("<u4")
                bounds, out = np.array(b["cu_lengths"]), []
                for r, (p, q) in enumerate(zip(b["cu_rows"], b["cu_rows"][1:], strict=False)):
                    for k in range(p, q):
                        s, e = int(bounds[k] - bounds[p]), int(bounds[k + 1] - bounds[p])
                        out.append((b["block"], r, s, b["doc_ids"][k], b["starts"][k], e - s, zlib.crc32(ids[r, s:e].tobytes())))
                kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 ["block", "row", "offset", "doc_id", "start", "length", "ids_crc32"])
    return made.mapInArrow(run, "block string, row int, offset int, doc_id long, start long, length long, ids_crc32 long")
