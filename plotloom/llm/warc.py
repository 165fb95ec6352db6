"""Web archives in ZIP packages: pages written as WARC records, and records read by byte range without unpacking an archive.

An archive is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz``, a gzip member for each record, and
``indexes/index.cdx`` with the place of each. A reader takes the end of the file, the central directory (ZIP64 or not) and the
index, and then only the ranges of records. Each task writes archives of its own under fresh names; one that a lost task left
behind is in no list of archives and is never read.
"""

import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows, ranked, saved
from plotloom.session import work_path

#: Payloads of fewer bytes are always written out.
LEAST = 100
#: Bytes after which a task begins a new archive, and bytes that one read takes at most (a longer record by itself).
ARCHIVE, SPAN = 256 << 20, 4 << 20
#: Parts of a group of equal payloads when it is joined.
SALTS = 32
#: Pages say nothing of when they were taken.
DATE = "1970-01-01T00:00:00Z"
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file that tasks reach by themselves: a shared mount, or what pyarrow.fs knows."""
    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)


# ---- roles ----

def _copies(rows: DataFrame) -> DataFrame:
    """(digest, first, times): the smallest page_id of payloads that several rows have, and how many rows have that page_id."""
    each = rows.filter(f"size >= {LEAST}").groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    least = F.min(F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id"), F.col("n"))).alias("least")
    of = each.groupBy("digest").agg(F.sum("n").alias("all"), least).filter("all > 1")
    return of.select("digest", F.col("least.page_id").alias("first"), F.col("least.n").alias("times"))


def roles(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, size, record_type, refers_to): of equal payloads of LEAST bytes or more one row is the response.

    That is the row with the smallest page_id (a null one comes last); where repeated rows share it, any one of them. The others
    are revisits that refer to it. A null html is an empty payload.
    """
    row = as_rows(pages)
    html = F.coalesce(F.col("row.html"), F.lit(""))
    rows = row.select(F.col("row.page_id").cast("long").alias("page_id"), F.col("row.url").alias("url"), html.alias("html"),
                      F.sha2(html.cast("binary"), 256).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    copies = saved(_copies(rows), "copies")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    dealt = copies.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = salted.join(dealt, ["digest", "salt"], "left")
    leads = F.col("times").isNull() | F.col("page_id").eqNullSafe(F.col("first"))

    def told(df: DataFrame, response: Column) -> DataFrame:
        return df.select("page_id", "url", "html", "digest", "size", F.when(response, "response").otherwise("revisit").alias("record_type"),
                         F.when(~response, F.col("first")).alias("refers_to"))
    if copies.filter("times > 1").isEmpty():
        return told(joined, leads)
    repeated = leads & (F.coalesce("times", F.lit(1)) > 1)
    tied = ranked(joined.filter(repeated).withColumn("tie", F.xxhash64("url")), "digest", ["tie"])
    return told(joined.filter(~repeated), leads).unionByName(told(tied, F.col("rank") == 0))


# ---- writing ----

def _record(page_id: int | None, url: str | None, html: str, digest: str, size: int, kind: str, refers_to: int | None, number: str) -> bytes:
    """One WARC record. A response's id follows from page and payload, so that its revisits can name it; other ids hold ``number``."""
    name = "null" if page_id is None else page_id
    own = digest if kind == "response" and size >= LEAST else number
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{name}:{own}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f-\x9f  ]", lambda m: quote(m[0]), url)))
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{'null' if refers_to is None else refers_to}:{digest}>")]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if kind == "response":
        block += html.encode()
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode() + block + b"\r\n\r\n"


class _Archive:
    """An archive being written: records go to the file as they come, the index follows at the end."""

    def __init__(self, folder: str, name: str):
        system, path = store(folder)
        system.create_dir(path, recursive=True)
        self.path, self.index, self.at = f"{folder}/{name}.zip", [], 0
        self.file = system.open_output_stream(f"{path}/{name}.zip")
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)

    def add(self, record: bytes, url: str | None, digest: str) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self.member.write(packed)
        entry = json.dumps({"digest": f"sha256:{digest}", "offset": self.at, "length": len(packed), "filename": WARC_MEMBER})
        self.index.append(f"{quote(url or '-', safe=':/?&=')} {re.sub('[^0-9]', '', DATE)} {entry}\n")
        self.at += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(INDEX_MEMBER, "w", force_zip64=True) as out:
            for line in sorted(self.index):
                out.write(line.encode())
        self.zip.close()
        size = self.file.tell()
        self.file.close()
        return self.path, size, len(self.index)


def written(pages: DataFrame, folder: str | None = None, most: int = ARCHIVE) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html, anything else) and return the archives: (path, bytes, records).

    Null ids, urls and texts have their records; control characters and blanks in a url are percent-encoded; repeated rows are
    written each; an empty table makes no archive. Columns other than the three are not written.
    """
    folder = folder or work_path(pages.sparkSession, "archives")
    names = ["page_id", "url", "html", "digest", "size", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, part, archive = 0, TaskContext.get().partitionId(), None

        def listed(done: _Archive) -> pa.RecordBatch:
            path, size, n = done.close()
            return pa.RecordBatch.from_pydict({"path": pa.array([path]), "bytes": pa.array([size], pa.int64()), "records": pa.array([n], pa.int64())})
        for batch in batches:
            for values in zip(*[batch.column(n) for n in names], strict=True):
                page_id, url, html, digest, size, kind, refers_to = (v.as_py() for v in values)
                if archive is None:
                    name, made = f"pages-{part:06d}-{made:04d}-{uuid.uuid4().hex[:12]}", made + 1
                    archive = _Archive(folder, name)
                archive.add(_record(page_id, url, html, digest, size, kind, refers_to, f"{name}-{len(archive.index)}"), url, digest)
                if archive.at >= most:
                    yield listed(archive)
                    archive = None
        if archive is not None:
            yield listed(archive)
    return saved(roles(pages).select(names).mapInArrow(run, "path string, bytes long, records long"), "archive-list")


# ---- reading ----

#: Fixed layouts of the ZIP format: end record, ZIP64 locator and end record, entry of the central directory, local header.
_END, _LOCATOR, _END64 = struct.Struct("<4s4H2LH"), struct.Struct("<4sLQL"), struct.Struct("<4sQ2H2L4Q")
_ENTRY, _LOCAL = struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s5H3L2H")


def _directory(file: pa.NativeFile, size: int) -> tuple[int, int]:
    """Place and bytes of the central directory."""
    tail_at = max(0, size - _END.size - 0xFFFF)
    tail = file.read_at(size - tail_at, tail_at)
    at = len(tail)
    while (at := tail.rfind(b"PK\x05\x06", 0, at)) >= 0:
        if at + _END.size <= len(tail) and at + _END.size + _END.unpack_from(tail, at)[-1] == len(tail):      # its comment ends the file
            break
    if at < 0:
        raise ValueError("no ZIP archive: there is no end record")
    _, _, _, _, entries, length, start, _ = _END.unpack_from(tail, at)
    if entries == 0xFFFF or 0xFFFFFFFF in (length, start):
        mark, _, end64, _ = _LOCATOR.unpack(file.read_at(_LOCATOR.size, tail_at + at - _LOCATOR.size))
        values = _END64.unpack(file.read_at(_END64.size, end64)) if mark == b"PK\x06\x07" else [b""]
        if values[0] != b"PK\x06\x06":
            raise ValueError("ZIP64 end record is missing")
        length, start = values[-2:]
    return start, length


def members(file: pa.NativeFile, size: int) -> dict[str, tuple[int, int, int]]:
    """Name -> (place of the data, bytes, method) of every member, from the central directory and the local headers."""
    start, length = _directory(file, size)
    listing, at, out = file.read_at(length, start), 0, {}
    while at + _ENTRY.size <= len(listing):
        mark, _, _, flags, method, _, _, _, packed, full, n, x, c, _, _, _, offset = _ENTRY.unpack_from(listing, at)
        if mark != b"PK\x01\x02":
            raise ValueError("central directory is damaged")
        name = listing[at + _ENTRY.size:at + _ENTRY.size + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = listing[at + _ENTRY.size + n:at + _ENTRY.size + n + x], 0
        while k + 4 <= len(extra):
            tag, m = struct.unpack_from("<2H", extra, k)
            if tag == 1:        # ZIP64: eight bytes for each of full, packed and offset that did not fit
                big = iter(struct.unpack_from(f"<{m // 8}Q", extra, k + 4))
                full = next(big) if full == 0xFFFFFFFF else full
                packed = next(big) if packed == 0xFFFFFFFF else packed
                offset = next(big) if offset == 0xFFFFFFFF else offset
            k += 4 + m
        local = _LOCAL.unpack(file.read_at(_LOCAL.size, offset))
        if local[0] != b"PK\x03\x04":
            raise ValueError(f"local header of {name} is damaged")
        out[name] = (offset + _LOCAL.size + local[-2] + local[-1], packed, method | 0x100 * (flags & 1))
        at += _ENTRY.size + n + x + c
    return out


def _stored(found: dict[str, tuple[int, int, int]], name: str) -> tuple[int, int]:
    at, size, method = found[name]
    if method:
        raise ValueError(f"{name} is not stored: its records have no byte ranges")
    return at, size


def places(archives: DataFrame, window: int = SPAN) -> DataFrame:
    """(path, at, length) of every record in the archives listed by ``path``, from their indexes, which are read piece by piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            system, plain = store(path)
            with system.open_input_file(plain) as file:
                found = members(file, file.size())
                indexes = [n for n in found if n.startswith("indexes/") and n.endswith((".cdx", ".cdxj"))]
                if not indexes and any(n.startswith("archive/") for n in found):
                    raise ValueError(f"{path} has no index")
                for name in indexes:
                    at, size = _stored(found, name)
                    rest = b""
                    for k in range(0, size, window):
                        *lines, rest = (rest + file.read_at(min(window, size - k), at + k) + b"\n" * (k + window >= size)).split(b"\n")
                        entries = [json.loads(x[x.index(b"{"):]) for x in lines if b"{" in x]
                        starts = [_stored(found, e["filename"] if e["filename"] in found else f"archive/{e['filename']}")[0] + int(e["offset"]) for e in entries]
                        yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(entries), pa.string()), "at": pa.array(starts, pa.int64()),
                                                          "length": pa.array([int(e["length"]) for e in entries], pa.int64())})
    return archives.select("path").mapInArrow(run, "path string, at long, length long")


def _parsed(packed: bytes) -> tuple:
    """Type, record id, url, id referred to, digest, payload bytes and payload (null unless written out) of one record."""
    raw = zlib.decompress(packed, 47) if packed[:2] == b"\x1f\x8b" else packed
    top, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = top.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[:int(head["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
    size = len(payload)
    if head["warc-type"] == "revisit":
        told = re.search(rb"(?mi)^content-length: *([0-9]+)", http)
        size, payload = int(told[1]) if told else None, None
    elif digest and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {head['warc-record-id']} is not what its digest says")
    return head["warc-type"], head["warc-record-id"], head.get("warc-target-uri"), head.get("warc-refers-to"), digest, size, payload


RECORD = "path string, at long, record_type string, record_id string, url string, refers_to_id string, payload_digest string, payload_bytes long, payload binary"


def records(archives: DataFrame, span: int = SPAN) -> DataFrame:
    """Every record of the archives (path, bytes): what its headers say, and its payload. Ranges that lie together are read at once.

    Ranges are dealt by place in the archive, about 16 spans to a task, so one large archive is read by many tasks.
    """
    spark = archives.sparkSession
    total = archives.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, total // (16 * span) + 1)
    dealt = places(archives).withColumn("span", F.expr(f"at div {span}")).repartition(int(tasks), "path", "span").sortWithinPartitions("path", "at")
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [f.split(" ")[0] for f in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            paths, ats, lengths = (batch.column(k).to_pylist() for k in ("path", "at", "length"))
            k = 0
            while k < len(paths):
                if paths[k] != opened:
                    if file is not None:
                        file.close()
                    system, plain = store(paths[k])
                    opened, file = paths[k], system.open_input_file(plain)
                to = k + 1
                while to < len(paths) and paths[to] == opened and ats[to] == ats[to - 1] + lengths[to - 1] and ats[to] + lengths[to] - ats[k] <= span:
                    to += 1
                data = file.read_at(ats[to - 1] + lengths[to - 1] - ats[k], ats[k])
                found = [(opened, ats[i], *_parsed(data[ats[i] - ats[k]:ats[i] - ats[k] + lengths[i]])) for i in range(k, to)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names)
                k = to
        if file is not None:
            file.close()
    return dealt.select("path", "at", "length").mapInArrow(run, RECORD)


def report(archives: DataFrame) -> DataFrame:
    """What the query returns, read back from the archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+):", 1).try_cast("long")
    return records(archives).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to_id").alias("refers_to"))


SQL = f"""
with p as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
r as (select *, min(page_id) over w as first, row_number() over (w order by page_id nulls last) as k from p window w as (partition by payload_digest))
select page_id, payload_bytes, payload_digest, case when payload_bytes < {LEAST} or k = 1 then 'response' else 'revisit' end as record_type,
    case when payload_bytes >= {LEAST} and k > 1 then first end as refers_to from r
"""
