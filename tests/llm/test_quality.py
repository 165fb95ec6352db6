"""Counts of each text against plain loops; limits on shared lines; rows that are null, blank, repeated or very long."""

import re
from collections import Counter

from plotloom.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, gone string, n long"


def counts(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    ls = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    times = Counter(wins)
    inside = {p for i, w in enumerate(wins) if times[w] > 1 for p in range(i, i + 5)}
    return (len(ws), len("".join(ws)), sum(c in "#*$%&|<>" for c in text or ""), len(ls) - len(set(ls)), len(inside),
            len(ws) < 10 or 100 * len(inside) > 20 * len(ws))


def row(i, text, source="a"):
    return (i, text, None, source, 7, 1, "x", 5)


def texts():
    plain = [f"w{i} " * 3 + " ".join(f"x{i}y{j}" for j in range(20)) for i in range(30)]
    odd = [None, "", " \t\n ", "\n\n", "a b c d e a b c d e f", "a a a a a a a a a a a", "é" * 50 + " # $ % & | < >", "one\x0btwo\rthree\n" * 40,
           "very long " * 40000, "l1 b\nl1 b\n l1 b\nL1 b"]
    return odd + plain


def test_counts_equal_plain_loops(spark):
    data = [row(i, t) for i, t in enumerate(texts())] + [row(None, "null id " * 30, None), row(3, "", None)]
    got = quality.verdicts(spark.createDataFrame(data, SCHEMA)).collect()
    want = sorted((str(r[0]), *counts(r[1])) for r in data)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want


def shared(spark):
    own = lambda i, n: " ".join(f"own{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}" for j in range(n))
    docs = [row(i, f"Shared  LINE {i} of the host here\n{own(i, 20)}") for i in range(25)]           # digits fold: one line
    docs += [row(100 + i, f"shared line 7 of the host here\n{own(40 + i, 2)}") for i in range(3)]        # depleted
    docs += [row(200 + i, f"shared line 7 of the host here\n{own(50 + i, 9)}", "b") for i in range(9)]      # too few in this host
    docs += [row(300 + i, own(90, 15) + "\n" + own(91, 15)) for i in range(60)] + [row(300, own(90, 15) + "\n" + own(91, 15))]   # copies
    return spark.createDataFrame(docs, SCHEMA)


def test_lines_above_the_limits(spark):
    kept = {(r.doc_id, r.kept) for r in quality.verdicts(shared(spark)).collect()}
    assert {i for i, k in kept if not k} == {100, 101, 102}


def test_cleaned_drops_lines_and_documents(spark):
    docs = shared(spark)
    out = quality.cleaned(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert not {100, 101, 102} & set(got) and out.count() == docs.count() - 3
    assert "hared" not in got[4].text and got[4].n_chars == len(got[4].text) and "shared" in got[200].text and got[200].n_chars == 7


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert quality.verdicts(docs).count() == 0 and quality.cleaned(docs).count() == 0
