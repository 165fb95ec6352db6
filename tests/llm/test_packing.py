"""Ids against the tokenizer itself, an exact round trip, no padding to speak of, the subset sums against brute force."""

import itertools
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from plotloom.llm import packing, tokens
from plotloom.llm.common import read

SCHEMA = "doc_id long, text string, start long, length string, ids int"
ODD = ["", " ", "  a  b\n\n c\t\td \r\n e", "x y z  w", "don't we'll <|endoftext|> 12 3,4", "\n", "a\x1cb c", "é ü\n ñ", "end  ", " x" * 3000, "日本 語 text"]


def plain():
    t = Tokenizer.from_file(tokens.vocabulary_path())
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer():
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice(" \n\tab1.,é' ") for _ in range(rng.randrange(60))) for _ in range(300)]
    enc, want = tokens.Encoder(tokens.vocabulary_path()), plain()
    for _ in range(2):
        assert [x.tolist() for x in enc.encode([*texts, None])] == [*map(want, texts), []]


def test_closest_multiset_equals_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(4)}
        used = packing.closest_multiset(counts, 40)
        top = max(counts)
        best = max(s for c in itertools.product(*(range(n + 1) for n in counts.values()))
                   if dict(zip(counts, c))[top] and (s := sum(k * n for k, n in zip(counts, c))) <= 40)
        assert sum(k * n for k, n in used.items()) == best and all(used[k] <= counts[k] for k in used)


def test_round_trip(spark):
    data = [(i, t, 1, "s", 2) for i, t in enumerate(ODD)] + [(3, ODD[3], 1, "s", 2), (None, "null id", 1, "s", 2), (99, None, 1, "s", 2)]
    data += [(200 + i, "word " * n, 1, "s", 2) for i, n in enumerate([1023, 1024, 2047, 5000, 700, 700, 323, 40000])]
    rows = packing.pack(spark.createDataFrame(data, SCHEMA), with_ids=True)
    rows = [r for r in rows.collect()]
    want, seqs, docs = plain(), {}, {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for parts in seqs.values():
        assert [o for o, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1] and sum(n for _, n in parts) <= 1024
    got = sorted(str(sum((ids for _, ids in sorted(p)), [])) for (d, _), p in docs.items() if d != 3)
    assert got == sorted(str([*want(t), 0]) for d, t, *_ in data if d != 3)
    assert len(docs[3, len(want(ODD[3])) + 1]) == 2


def test_little_padding_and_whole_rows(spark):
    parts = packing.pack(read(spark, "/root/testdata/sf0.001", "documents"), with_ids=True)
    seqs = packing.sequences(parts).collect()
    assert all(len(s.ids) == 4 * sum(s.lengths) for s in seqs)
    total = sum(sum(s.lengths) for s in seqs)
    assert len(seqs) * 1024 < 1.02 * total


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
