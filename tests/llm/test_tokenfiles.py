"""Best fit against a plain search, an exact round trip through the matrices, padding, odd rows."""

import random
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from plotloom.llm import tokenfiles as T
from plotloom.llm import tokens
from plotloom.llm.common import read

SCHEMA = "doc_id long, text string, block string, ids int"


def test_best_fit_equals_plain_search():
    rng = random.Random(3)
    for _ in range(40):
        lengths = [rng.randrange(1, 65) for _ in range(80)]
        room, want = [], []
        for i in sorted(range(80), key=lambda i: (-lengths[i], i)):
            fits = [(r, k) for k, r in enumerate(room) if r >= lengths[i]]
            if not fits:
                room.append(64)
                want.append(lengths[i])
                room[-1] -= lengths[i]
                continue
            r, k = min(fits)
            room[k] -= lengths[i]
        got = T.best_fit(lengths, 64)
        assert sorted(i for r in got for i in r) == list(range(80)) and all(sum(lengths[i] for i in r) <= 64 for r in got)
        assert sorted(64 - sum(lengths[i] for i in r) for r in got) == sorted(room)


def test_round_trip(spark):
    tk = Tokenizer.from_file(tokens.vocabulary_path())
    tk.encode_special_tokens = True
    data = [(1, "a b c", "x", 1), (2, None, "x", 1), (3, "", "x", 1), (4, "word " * 9000, "x", 1), (None, "no id", "x", 1), (1, "a b c", "x", 1), (6, "word " * 2047, "x", 1), (7, "　 ideo", "x", 1)]
    made = T.written(spark.createDataFrame(data, SCHEMA).coalesce(1)).collect()
    docs = defaultdict(list)
    for b in made:
        ids = np.frombuffer(b.ids, "<u2").reshape(b.n_rows, T.ROW)
        for r in range(b.n_rows):
            base, used = b.cu_lengths[b.cu_rows[r]], 0
            for p in range(b.cu_rows[r], b.cu_rows[r + 1]):
                docs[b.doc_ids[p]].append((b.starts[p], ids[r, b.cu_lengths[p] - base:b.cu_lengths[p + 1] - base].tolist()))
                used = b.cu_lengths[p + 1] - base
            assert not ids[r, used:].any()
    for i, text, *_ in data:
        want = [*tk.encode(text or "", add_special_tokens=False).ids, 0]
        if i == 1:
            assert docs[1] == [(0, want)] * 2
        else:
            assert sum((x for _, x in sorted(docs[i])), []) == want


def test_little_padding(spark):
    made = T.written(read(spark, "/root/testdata/sf0.01", "documents"))
    p = T.pieces(made)
    rows = made.selectExpr("sum(n_rows) as n").first().n
    total = p.selectExpr("sum(length) as n").first().n
    assert total > 0.97 * rows * T.ROW and p.selectExpr("count(distinct doc_id) as n").first().n == 1000


def test_empty_table(spark):
    assert T.pieces(T.written(spark.createDataFrame([], SCHEMA))).count() == 0
