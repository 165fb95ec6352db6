"""Held-out accuracy, the word ratios against plain counting, and rows and labels that are odd or missing."""

import math
import random
import zlib
from collections import defaultdict

import pytest

from plotloom.llm import toxicity as tx

DOCS = "doc_id long, text string, score string, fold int, toxic long, row int"
LABELS = "doc_id long, quality int, toxic int, fold string"
BAD = ["vile", "snarl", "grubby", "über"]


def corpus(n=1500):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        ws = [words[min(int(rng.expovariate(0.02)), 399)] for _ in range(rng.randrange(5, 120))]
        bad = rng.random() < 0.2
        for _ in range(rng.randrange(1, 4) if bad else 0):
            ws.insert(rng.randrange(len(ws)), rng.choice(BAD))
        docs.append((i, " ".join(ws), "s", 1, 0, 2))
        labels.append((i, 1, int(bad), "f"))
    return docs, labels


def remainder(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = corpus()
    extra = [(None, "vile thing", "s", 1, 0, 2), (9000, None, "s", 1, 0, 2), (9001, "", "s", 1, 0, 2), (9002, " ?! ", "s", 1, 0, 2),
             (9003, "w1 w2 " * 40000, "s", 1, 0, 2), (9003, "w1 w2 " * 40000, "s", 1, 0, 2), (9004, "w9 " * 30000 + "snarl", "s", 1, 0, 2)]
    more = [(None, 1, 1, "f"), (5, 1, None, "f"), (7, 1, labels[7][2], "f")]
    return docs + extra, labels, spark.createDataFrame(docs + extra, DOCS), spark.createDataFrame(labels + more, LABELS)


def test_held_out_accuracy_and_odd_rows(data):
    docs, labels, dd, ll = data
    rows = tx.scored(dd, ll).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {i: y for i, _, y, _ in labels}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(remainder(r.doc_id) == 0 for r in held) and len(held) > 200
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.score, r.predicted))
    assert by[9000] == by[9001] == by[9002] and {p for _, p in by[9000]} == {0} and len(by[9003]) == 1
    assert {p for _, p in by[9004]} == {1} and {p for _, p in by[None]} == {1}


def test_word_ratios_equal_plain_counts(data):
    docs, labels, dd, ll = data
    model = tx.learned(dd, ll)
    truth = {i: y for i, _, y, _ in labels}
    seen = [defaultdict(set), defaultdict(set)]
    for i, text, *_ in docs:
        if i in truth and remainder(i) in (1, 2, 3):
            ws = text.lower().split()
            for a, b in zip(["", *ws], ws, strict=False):
                seen[truth[i]][b].add(a)
    both = {w: len(seen[0][w] | seen[1][w]) for w in {*seen[0], *seen[1]}}
    n = [sum(len(s) for s in c.values()) for c in seen]
    lam = [tx.DISCOUNT * sum(bool(s) for s in c.values()) / m for c, m in zip(seen, n, strict=True)]

    def p(c, w):
        return max(len(seen[c].get(w, ())) - tx.DISCOUNT, 0) / n[c] + lam[c] * (both[w] + tx.PRIOR_WORD) / (sum(both.values()) + tx.PRIOR_WORD * len(both))
    for w in [w for w in both if both[w] > 1]:
        assert math.isclose(model.word[model.vocab[w.encode()]], math.log(p(1, w) / p(0, w)), rel_tol=1e-9)
    assert math.isclose(model.word[0], math.log(lam[1] / lam[0]))


def test_toxic_rows_go(data):
    _, labels, dd, ll = data
    left = tx.without_toxic(dd, ll)
    assert left.columns == dd.columns
    ids = [r.doc_id for r in left.collect()]
    truth = {i: y for i, _, y, _ in labels}
    assert sum(truth.get(i, 0) for i in ids) <= 0.02 * sum(truth.values()) and sum(1 for i in ids if truth.get(i) == 0) >= 0.99 * sum(1 for y in truth.values() if not y)


def test_empty_tables_and_one_class(data):
    _, _, dd, ll = data
    assert tx.scored(dd.limit(0), ll).count() == 0
    assert {r.predicted for r in tx.scored(dd, ll.limit(0)).collect()} == {0}
    assert {r.predicted for r in tx.scored(dd, ll.filter("toxic = 0")).collect()} == {0}


def test_a_phrase_of_its_own_words_tells(data, spark):
    docs, labels, *_ = data
    phrase = [(i, t + (" grot mulk zerp" if y else ""), *rest) for (i, t, *rest), (_, _, y, _) in zip(docs, labels, strict=False)]
    model = tx.learned(spark.createDataFrame(phrase, DOCS), spark.createDataFrame(labels, LABELS))
    assert {b"mulk", b"zerp"} <= set(model.vocab)     # each after one word only
    alone = model.word[[model.vocab[b"mulk"], model.vocab[b"zerp"]]]
    assert min(alone) > model.word[0] and min(alone) > 0 and min(model.ratios(b"grot mulk zerp")) > 0


def test_a_bounded_model_keeps_what_tells(data, monkeypatch):
    _, _, dd, ll = data
    monkeypatch.setattr(tx, "MAX_WORDS", 40)
    assert {w.encode() for w in BAD} <= set(tx.learned(dd, ll).vocab)
