"""Cuts as a plain loop makes them, exact way back, odd rows, empty table."""

import hashlib
import re

from plotloom.llm import fim

SCHEMA = "doc_id long, text string, n int, form string, output string, row int"


def expected(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    d = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", text, None, None
    a, b, c = ("".join(units[i:j]) for i, j in ((0, low), (low, high), (high, None)))
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<S>{c}<P>{a}<M>{b}" if form == "spm" else f"<P>{a}<S>{c}<M>{b}"
    return len(units), form, out, len(a), len(b)


ODD = [None, "", "\n", "\n\n\n", "one line", "no end\nhere", "end\n", "a\r\nb\rc\n", "x <P> y\nz", "<S>", "tail\n<M>", "ü\n漢字\n😀😀\n", "< P>\n<\nP>\n", "same\n" * 50,
       " \n", "<PS>M>\n<S\n>", "very long\n" * 60_000, "w" * 700_000]


def rows():
    data = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "".join(f"line {j} of {i}\n" for j in range(i % 23)) + "rest" * (i % 2)) for i in range(300)]
    return [(i, t, 1, "f", "o", 2) for i, t in [*data, (None, "a\nb\nc\n"), (None, None), (5, "no end\nhere"), (5, "no end\nhere")]]


def test_cut_as_a_loop_would_and_back(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    for rate, spm in ((100, 50), (40, 0), (100, 100)):
        got = fim.with_restored(fim.fill_in_middle(docs, rate, spm)).collect()
        assert len(got) == len(rows())
        for r in got:
            assert (r.n, r.form, r.output, r.prefix_chars, r.middle_chars) == expected(r.row.doc_id, r.row.text, rate, spm)
            assert r.restored == (r.row.text or "") and r.row.form == "f"


def test_query_digests(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = sorted(map(str, (tuple(r) for r in fim.digests(docs).collect())))

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t, *_ in rows():
        n, form, out, a, b = expected(i, t)
        want.append(str((i, n, form, a, b, sha(out), sha(t or ""))))
    assert got == sorted(want)


def test_small_slices_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(rows(), SCHEMA)
    whole = sorted(map(str, fim.digests(docs).collect()))
    monkeypatch.setattr(fim, "SLICE", 64)
    assert sorted(map(str, fim.digests(docs).collect())) == whole


def test_empty_table(spark):
    made = fim.digests(spark.createDataFrame([], SCHEMA))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"] and made.count() == 0
