"""Every page comes back from the archives; roles as counted by hand; ZIP and ZIP64 directories; odd rows; empty table."""

import hashlib
import io
import random
import zipfile
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from plotloom.llm import warc

SCHEMA = "page_id long, url string, html string, size int, digest string, path string"


def rows():
    rng = random.Random(3)
    texts = ["", "x" * 99, "y" * 100, "ü" * 50, "ü" * 49, "<html>\r\n\r\nWARC/1.1\r\n\x00 zero</html>" * 9, "漢" * 5000, "big " * 400_000, "copy " * 40]
    data = [(i, f"http://a/{i}?q=1 2", rng.choice(texts)) for i in range(200)]
    data += [(1000 + i, None, "copy " * 40) for i in range(300)] + [(-5, "u\nWARC-Type: fake", "copy " * 40)]
    data += [(7, "http://same", "repeated " * 20)] * 4 + [(8, "http://other", "repeated " * 20), (7, "http://third", "repeated " * 20)]
    data += [(None, "n", None), (None, None, "null id " * 30), (None, "z", "null id " * 30), (3000, "b", "one of two " * 20), (None, "c", "one of two " * 20)]
    return [(*r, 1, "d", "p") for r in data]


def expected(data):
    held = defaultdict(list)
    for i, _, t, *_ in data:
        held[t or ""].append(i)
    out = []
    for t, ids in held.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            later = k > 0 and len(t.encode()) >= 100
            out.append((i, len(t.encode()), hashlib.sha256(t.encode()).hexdigest(), "revisit" if later else "response", ids[0] if later else None))
    return Counter(out)


def test_roles_and_whole_payloads(spark):
    data = rows()
    made = warc.written(spark.createDataFrame(data, SCHEMA).repartition(5), most=5_000)
    assert made.count() > 6
    assert Counter(tuple(r) for r in warc.report(made).collect()) == expected(data)
    got = warc.records(made, span=1000).collect()
    assert len({r.record_id for r in got if r.payload_bytes >= 100}) == sum(r.payload_bytes >= 100 for r in got)
    by_id = {r.record_id: r for r in got}
    back = Counter()
    for r in got:
        source = by_id[r.refers_to_id] if r.record_type == "revisit" else r
        assert (r.payload is None) == (r.record_type == "revisit") and source.record_type == "response"
        back[bytes(source.payload).decode()] += 1
    assert back == Counter(t or "" for _, _, t, *_ in data)
    assert sum(r.url == "http://same" for r in got) == 4 and sum(r.url == "u%0AWARC-Type:%20fake" for r in got) == 1


def test_archives_open_with_any_zip_reader(spark):
    path = warc.written(spark.createDataFrame(rows(), SCHEMA)).first().path
    with zipfile.ZipFile(path.removeprefix("file:")) as z:
        assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
        assert set(z.namelist()) == {warc.WARC_MEMBER, warc.INDEX_MEMBER}


@pytest.mark.parametrize("big", [False, True])
def test_directories_of_other_writers(big, monkeypatch):
    if big:     # make the writer believe that all of this is beyond 4 GiB and 65 535 members
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("readme ü.txt", "deflated " * 50, zipfile.ZIP_DEFLATED)
        for k in range(5):
            z.writestr(f"archive/{k}.warc", f"member {k} " * (k + 3))
        z.comment = b"a comment that holds PK\x05\x06 and more than that, to mislead"
    data = out.getvalue()
    assert (b"PK\x06\x06" in data) == big
    file = pa.BufferReader(data)
    found = warc.members(file, len(data))
    assert set(found) == {"readme ü.txt", *(f"archive/{k}.warc" for k in range(5))}
    for k in range(5):
        at, size = warc._stored(found, f"archive/{k}.warc")
        assert data[at:at + size] == f"member {k} ".encode() * (k + 3)
    with pytest.raises(ValueError, match="not stored"):
        warc._stored(found, "readme ü.txt")
    with pytest.raises(ValueError, match="no end record"):
        warc.members(pa.BufferReader(b"PK" * 40), 80)


def test_damaged_payload_is_told():
    record = warc._record(1, "u", "text " * 30, hashlib.sha256(b"text " * 30).hexdigest(), 150, "response", None, "0")
    assert warc._parsed(record)[-1] == b"text " * 30
    with pytest.raises(ValueError, match="digest"):
        warc._parsed(record.replace(b"text text", b"text tent"))


def test_empty_table(spark):
    made = warc.written(spark.createDataFrame([], SCHEMA))
    assert made.count() == 0 and warc.report(made).count() == 0
