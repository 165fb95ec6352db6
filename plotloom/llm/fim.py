"""Fill-in-middle: lines of a text cut into prefix, middle and suffix by pyarrow.compute on whole batches, and put together again.

A batch's texts become lists of units; the flat units keep the number of their document, their ordinal there says which role they
have, and each role's units become lists again whose strings are joined. No Python code sees a single text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.llm.common import as_rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the texts that are transformed, percent of those that become spm, and the seed of all choices.
RATE, SPM, SEED = 100, 50, 7
#: Bytes of text that go through the pipeline at once (a longer text by itself).
SLICE = 16 << 20

PARTS = "n long, form string, output string, prefix_chars long, middle_chars long"


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of seed and doc_id (null: nothing after the colon)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def _slices(batch: pa.RecordBatch, text: pa.Array) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about SLICE bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _units(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat lines of all texts, each with its line end, and the number of the text that each is from."""
    split = pc.split_pattern(text, "\n")
    flat, parent = pc.list_flatten(split), pc.list_parent_indices(split).to_numpy()
    last = np.append(parent[1:] != parent[:-1], True) if len(parent) else np.zeros(0, bool)
    ends = pc.if_else(pa.array(last), pa.scalar("", text.type), pa.scalar("\n", text.type))
    units = pc.binary_join_element_wise(flat, ends, pa.scalar("", text.type))
    real = pc.greater(pc.binary_length(units), 0)          # what is left after a text's last line end is no unit
    return pc.filter(units, real), parent[real.to_numpy(zero_copy_only=False)]


def _joined(units: pa.Array, parent: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """The chosen units of each text, joined."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(parent[chosen], minlength=rows))])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pc.filter(units, pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar("", units.type))


def _glued(*pieces) -> pa.Array:
    kind = pa.large_string()
    return pc.binary_join_element_wise(*[pa.scalar(p, kind) if isinstance(p, str) else p for p in pieces], pa.scalar("", kind))


def transformed(batch: pa.RecordBatch, rate: int = RATE, spm: int = SPM) -> list[pa.Array]:
    """Columns of PARTS for a batch of rows and h1 to h4."""
    text = pc.fill_null(pc.struct_field(batch.column("row"), "text"), "").cast(pa.large_string())
    h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4))
    units, parent = _units(text)
    n = np.bincount(parent, minlength=len(text)).astype(np.int64)
    ordinal = np.arange(len(parent)) - np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)[parent] if len(parent) else parent
    a, b = h1 % (n + 1), h2 % (n + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    marked = np.zeros(len(text), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(text, mark).to_numpy(zero_copy_only=False)
    plain = (n == 0) | marked | (h3 % 100 >= rate)
    moved = h4 % 100 < spm
    first = ordinal < low[parent]
    inner = ~first & (ordinal < high[parent])
    prefix, middle, suffix = (_joined(units, parent, x, len(text)) for x in (first, inner, ~first & ~inner))
    psm_text = _glued(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    spm_text = _glued(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    output = pc.if_else(pa.array(plain), text, pc.if_else(pa.array(moved), spm_text, psm_text))
    form = pa.array(np.where(plain, "plain", np.where(moved, "spm", "psm")))
    none = pa.scalar(None, pa.int64())
    chars = [pc.if_else(pa.array(plain), none, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return [pa.array(n), form, output.cast(pa.string()), *chars]


def restored(form: pa.Array, output: pa.Array) -> pa.Array:
    """The texts again, from outputs and forms alone: a transformed text holds each mark once."""
    output = output.cast(pa.large_string())
    plain, spm = pc.equal(form, "plain"), pc.equal(form, "spm")
    framed = pc.if_else(plain, pa.scalar(PREFIX + SUFFIX + MIDDLE, output.type), output)

    def between(text: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
        cut = pc.split_pattern(text, mark, max_splits=1)
        return pc.list_element(cut, 0), pc.list_element(cut, 1)
    head, middle = between(framed, MIDDLE)
    # psm: <P>prefix<S>suffix, spm: <S>suffix<P>prefix; what stands after a mark, up to the other one if that follows
    after_p, after_s = between(head, PREFIX)[1], between(head, SUFFIX)[1]
    prefix = pc.if_else(spm, after_p, between(_glued(after_p, SUFFIX), SUFFIX)[0])
    suffix = pc.if_else(spm, between(_glued(after_s, PREFIX), PREFIX)[0], after_s)
    return pc.if_else(plain, output, _glued(prefix, middle, suffix)).cast(pa.string())


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: int = SEED) -> DataFrame:
    """(row, n, form, output, prefix_chars, middle_chars) for each row of ``docs`` (doc_id, text, anything else, in ``row``).

    A null or empty text has no units and stays plain, as does one that holds a mark already. Repeated rows are cut alike, since
    only seed and doc_id choose (a null doc_id chooses as one without digits). An empty table gives an empty result; extra
    columns stay inside ``row`` and clash with nothing.
    """
    keyed = as_rows(docs).select("row", *draws(F.col("row.doc_id"), seed))
    names = ["row", *(f.split(" ")[0] for f in PARTS.split(", "))]
    kind = T.StructType([*keyed.select("row").schema.fields, *T.StructType.fromDDL(PARTS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole, pc.struct_field(whole.column("row"), "text")):
                yield pa.RecordBatch.from_arrays([b.column("row"), *transformed(b, rate, spm)], names)
    return keyed.mapInArrow(run, kind)


def with_restored(made: DataFrame) -> DataFrame:
    """Append ``restored``: the text rebuilt from ``output`` and ``form``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole, whole.column("output")):
                back = restored(b.column("form"), b.column("output"))
                yield pa.RecordBatch.from_arrays([*b.columns, back], [*b.schema.names, "restored"])
    return made.mapInArrow(run, T.StructType([*made.schema.fields, T.StructField("restored", T.StringType())]))


def digests(docs: DataFrame) -> DataFrame:
    """What the query returns: counts and form, sha256 of the output and of the text rebuilt from it."""
    made = fill_in_middle(docs.select("doc_id", "text")).select(F.col("row.doc_id").alias("doc_id"), "n", "form", "output", "prefix_chars", "middle_chars")
    sha = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return with_restored(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *sha)


SQL = rf"""
with u as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
    sha256('{SEED}:' || coalesce(doc_id::varchar, '')) as d from documents),
h as (select *, len(units)::bigint as n, ('0x' || d[1:8])::bigint as h1, ('0x' || d[9:16])::bigint as h2, ('0x' || d[17:24])::bigint as h3,
    ('0x' || d[25:32])::bigint as h4 from u),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
    case when text = '' or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}') or contains(text, '{MIDDLE}') or h3 % 100 >= {RATE} then 'plain'
         when h4 % 100 < {SPM} then 'spm' else 'psm' end as form from h),
p as (select *, array_to_string(units[1:low], '') as a, array_to_string(units[low + 1:high], '') as b, array_to_string(units[high + 1:], '') as c from c),
o as (select *, case form when 'plain' then text when 'psm' then '{PREFIX}' || a || '{SUFFIX}' || c || '{MIDDLE}' || b
    else '{SUFFIX}' || c || '{PREFIX}' || a || '{MIDDLE}' || b end as output from p)
select doc_id, n, form, case when form <> 'plain' then length(a) end as prefix_chars, case when form <> 'plain' then length(b) end as middle_chars,
    sha256(output) as output_sha256, sha256(text) as restored_sha256 from o
"""
