"""Fingerprints and components against brute force; the covering property itself."""

import itertools
import random

import numpy as np
import xxhash

from plotloom.llm import simhash
from plotloom.llm.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, k1 int"


def plain_fingerprint(text):
    ws = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs))


def plain_components(fps, radius=3):
    parent = {f: f for f in fps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= radius and top(a) != top(b):
            parent[max(top(a), top(b))] = min(top(a), top(b))
    return {f: top(f) for f in parent}


def rows():
    rng = random.Random(5)
    base = [" ".join(rng.choice(["Alpha", "beta", "gämma", "delta", "eps"]) + str(rng.randrange(99)) for _ in range(120)) for _ in range(5)]
    out = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two"), (7, "x " * 30000), (7, "x " * 30000), (None, base[0]), (90, base[0])]
    for i in range(60):
        ws = base[i % 5].split()
        ws[rng.randrange(120)] = "edit"
        out.append((100 + i, "\n".join(ws)))
    return [(i, t, None, "s", 3, "clash", 9) for i, t in out]


def test_every_small_set_of_bits_is_left_out_by_a_mask():
    masks = simhash.covering_masks(list(range(64)), 3)
    assert len(masks) == 15 and all(any(not m & (1 << a | 1 << b | 1 << c) for m in masks) for a, b, c in itertools.combinations(range(64), 3))


def test_near_duplicates_equal_brute_force(spark):
    data = rows()
    got = simhash.near_duplicates(spark.createDataFrame(data, SCHEMA)).collect()
    fps = [plain_fingerprint(r[1]) for r in data]
    root = plain_components(fps)
    least = {}
    for r, f in zip(data, fps):
        if r[0] is not None:
            least[root[f]] = min(least.get(root[f], r[0]), r[0])
    want = sorted((str(r[0]), f"{f:016x}", least[root[f]]) for r, f in zip(data, fps))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want


def test_large_buckets_keep_every_link(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(3)]
    fps = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for s in seeds for _ in range(400)}
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    links = simhash.close_links(spark.createDataFrame(signed, "fp long"), 3, limit=20)
    got = {r.node: r.root for r in components(links).collect()}
    want = plain_components(fps)
    part = {}
    for f in fps:
        s = int(np.uint64(f).astype(np.int64))
        part.setdefault(want[f], set()).add(got.get(s, s))
    assert all(len(v) == 1 for v in part.values()) and len({next(iter(v)) for v in part.values()}) == len(part)


def test_forest_by_flips_equals_forest_by_pairs(monkeypatch):
    rng = np.random.default_rng(1)
    v = np.unique(rng.integers(0, 1 << 14, 900, dtype=np.uint64))
    sizes = []
    for limit in (1 << 20, 1):
        monkeypatch.setattr(simhash, "BUCKET", limit)
        sizes.append(len(simhash._forest(v, 2)[0]))
    assert sizes[0] == sizes[1]


def test_one_row_of_each_group_stays(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    root = plain_components([plain_fingerprint(r[1]) for r in data])
    left = [plain_fingerprint(r.text) for r in kept.collect()]
    assert len(left) == len({root[f] for f in left}) == len(set(root.values()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0 and simhash.without_near_duplicates(docs).count() == 0
