"""SimHash near-duplicates: 64-bit fingerprints, covering masks, components of close fingerprints.

Masks come from a covering code: bit i gets the nonzero vector m(i) of r + 1 bits, and table v keeps the bits with odd
``m(i) & v``. The at most r differing bits of a close pair span less than r + 1 dimensions, so some v is orthogonal to all
of them and the pair agrees in that whole table: 15 tables for r = 3, each keeping 8 of 15 bits.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows, from_rows, row_keys, saved
from plotloom.llm.graph import components

BITS, SEED = 64, 42
#: Buckets above this size are dealt again by a second covering over the bits that their key leaves open.
BUCKET = 1024


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions of which every set of ``radius`` positions is left out by one at least."""
    n = 2 ** (radius + 1) - 1
    return [sum(1 << b for j, b in enumerate(bits) if ((j % n + 1) & v).bit_count() % 2) for v in range(1, n + 1)]


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Bit j is 1 if it is set in over half of the shingles' hashes; no words give 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(r), SEED) for r in runs), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << j for j in np.flatnonzero(2 * ones > len(hashes)).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprinted(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, k1, k2, fp) for every row; the text itself is left behind. A null text counts as one without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                fps = [_signed(fingerprint(t, shingle)) for t in b.column("text").cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(fps, pa.int64())],
                                                 ["doc_id", "k1", "k2", "fp"])
    rows = as_rows(docs).select(F.col("row.doc_id").cast("long").alias("doc_id"), *row_keys(), F.col("row.text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, k1 long, k2 long, fp long")


def _forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, root) that keep what is connected within ``radius`` among distinct values connected."""
    v = np.sort(values)
    n = len(v)
    if n <= BUCKET:
        a, b = np.nonzero(np.triu(np.bitwise_count(v[:, None] ^ v[None, :]) <= radius, 1))
    else:       # few open bits, so few ways to differ: look each of them up
        open_bits = int(np.bitwise_or.reduce(v ^ v[0]))
        ones = [1 << i for i in range(BITS) if open_bits >> i & 1]
        flips = {0}
        for _ in range(radius):
            flips |= {f ^ o for f in flips for o in ones}
        a, b = [], []
        for f in sorted(flips - {0}):
            other = v ^ np.uint64(f)
            at = np.minimum(np.searchsorted(v, other), n - 1)
            hit = np.flatnonzero((v[at] == other) & (np.arange(n) < at))
            a.append(hit)
            b.append(at[hit])
        a, b = np.concatenate(a or [np.zeros(0, int)]), np.concatenate(b or [np.zeros(0, int)])
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, b, label[a])
        np.minimum.at(new, a, label[b])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(n))
    return v[far], v[label[far]]


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for fps in b.column(0):
                x, y = _forest(fps.values.to_numpy(zero_copy_only=False).view(np.uint64), radius)
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])
    return buckets.select("fps").mapInArrow(run, "a long, b long")


def _mask_rows(fps: DataFrame, masks: Column) -> DataFrame:
    keys = F.transform(masks, lambda m, i: F.struct(i.alias("t"), m.bitwiseAND(F.col("fp")).alias("key")))
    return fps.select("*", F.explode(keys).alias("at"))


def _links(spread: DataFrame, keys: list[str], limit: int | None, radius: int) -> tuple[DataFrame, DataFrame | None]:
    """Links within the buckets named by ``keys``; beside them the rows of buckets above ``limit``."""
    sizes = saved(spread.groupBy(*keys).agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"), "buckets")
    pairs = sizes.filter("n = 2").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
    mid = sizes.filter("n > 2" + (f" and n <= {limit}" if limit else "")).select(*keys)
    gathered = spread.join(mid, keys).groupBy(*keys).agg(F.collect_list("fp").alias("fps"))
    links = pairs.unionByName(_bucket_links(gathered, radius))
    return links, spread.join(sizes.filter(f"n > {limit}").select(*keys), keys) if limit else None


def close_links(fps: DataFrame, radius: int = 3, limit: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints, one forest per bucket: whatever is within ``radius`` ends up connected.

    A bucket above ``limit`` is dealt once more by covering masks over the bits its key leaves open (30 of 64): what agrees
    there too differs in 14 bits at most, so those buckets are bounded by the number of such values.
    """
    everything = (1 << BITS) - 1
    first = covering_masks(list(range(BITS)), radius)
    second = [[_signed(m | n) for n in covering_masks([b for b in range(BITS) if not m >> b & 1], radius)] for m in first]
    lit = lambda xs: F.array(*[F.lit(x) for x in xs])
    assert all(m & ~everything == 0 for m in first)
    spread = _mask_rows(fps, lit([_signed(m) for m in first])).select("fp", F.col("at.t").alias("t"), F.col("at.key").alias("key"))
    links, hot = _links(spread, ["t", "key"], limit, radius)
    again = _mask_rows(hot, F.element_at(F.array(*[lit(x) for x in second]), F.col("t") + 1)).select(
        "fp", "t", F.col("at.t").alias("t2"), F.col("at.key").alias("key"))
    return links.unionByName(_links(again, ["t", "t2", "key"], None, radius)[0])


def components_of(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, component_id): the smallest doc_id among all rows whose fingerprints are reachable by links."""
    each = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(close_links(each.select("fp"), radius))
    rooted = each.join(roots, each.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    return rooted.join(ids, F.col("root") == F.col("of")).select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs`` (doc_id, text, anything else).

    Null and blank texts have fingerprint zero and are linked like any other. Repeated rows each get their row. A null
    doc_id is never the smallest unless the component has no other. An empty table gives an empty result.
    """
    prints = saved(fingerprinted(docs), "fingerprints")
    ids = components_of(prints, radius)
    return prints.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """One row of each component stays, the one with the smallest doc_id (then the smallest row key); columns as in ``docs``."""
    prints = saved(fingerprinted(docs), "fingerprints")
    ids = components_of(prints, radius)
    first = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "k1", "k2")
    kept = prints.join(ids, "fp").groupBy("root").agg(F.min(first).alias("k")).select("k.k1", "k.k2")
    rows = as_rows(docs).select("row", *row_keys())
    return from_rows(rows.join(kept, ["k1", "k2"]).dropDuplicates(["k1", "k2"]))
