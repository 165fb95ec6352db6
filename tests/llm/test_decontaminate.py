"""Hits of test items against a plain search of every window; several blocks; longest matches; odd rows."""

import hashlib
import re

from plotloom.llm import decontaminate as dc

DOCS = "doc_id long, text string, found string, row int, n_words long"
ITEMS = "item_id long, text string, name string, block int"


def ws(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def plain(text, items):
    w, hit, names = ws(text), set(), set()
    for name, t in items:
        b = ws(t)
        n = min(13, len(b))
        wins = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                names.add("" if name is None else str(name))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


LONG = " ".join(f"q{i}" for i in range(40))
B = [(1, LONG), (2, "Q5 " + " ".join(f"q{i}" for i in range(6, 25))), (2, LONG), (10, "two words"), (3, None), (4, "!!"), (5, ""), (6, "Ünïq"), (None, "null item here"),
     (7, "a a a a a a a a a a a a a a a")]
D = [(1, LONG), (2, "pre " + LONG.upper().replace(" ", ", ") + " post"), (3, " ".join(LONG.split()[3:16])), (4, " ".join(LONG.split()[3:15])), (5, "Two-words two  WORDS"),
     (6, None), (7, ""), (8, "?"), (8, "ünïq x ÜNÏQ"), (9, "w " * 50000 + LONG + " w" * 100), (None, "a " * 40), (11, "null item here"), (12, "two"), (1, LONG), (13, "words two words")]


def frames(spark):
    return (spark.createDataFrame([(i, t, "f", 1, 2) for i, t in D], DOCS), spark.createDataFrame([(i, t, "n", 3) for i, t in B], ITEMS))


def got(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_equals_plain_search(spark):
    assert got(dc.report(*frames(spark))) == sorted((str(i), *plain(t, B)) for i, t in D)


def test_blocks_and_shards_change_nothing(spark, monkeypatch):
    docs, items = frames(spark)
    whole = {(str(r.row.doc_id), r.row.text, str(r.found.n_hit), str(r.found["items"])) for r in dc.searched(docs, items).collect()}
    monkeypatch.setattr(dc, "SHARD", 20)
    assert {(str(r.row.doc_id), r.row.text, str(r.found.n_hit), str(r.found["items"])) for r in dc.searched(docs, items, block=60).collect()} == whole


def test_longest_matches(spark):
    m = {(r.doc_id, r.item_word, r.doc_word, r.n_words) for r in dc.matches(*frames(spark)).collect() if r.item_id == "1"}
    assert {(1, 0, 0, 40), (2, 0, 1, 40), (3, 3, 0, 13), (9, 0, 50000, 40)} <= m and not any(i == 4 for i, *_ in m)


def test_contaminated_rows_go(spark):
    docs, items = frames(spark)
    left = dc.decontaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, t in D if not plain(t, B)[-1])


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert dc.report(docs.limit(0), items).count() == 0
    assert {r.n_items for r in dc.report(docs, items.limit(0)).collect()} == {0}
