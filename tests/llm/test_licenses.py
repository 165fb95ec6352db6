"""Finds against a plain sliding comparison, edits on both sides of the limit, the chance of the bands, odd rows."""

import random

import numpy as np

from plotloom.llm import licenses as L
from plotloom.llm.decontaminate import words_of

SCHEMA = "doc_id long, text string, found string, license int"


def plain(text):
    """Templates of which some run of words as long as the template, or the whole shorter text, holds 80 % of the shingles."""
    ws, out = words_of((text or "").encode()), set()
    for name, t in L.TEMPLATES.items():
        tw = words_of(t.encode())
        k = min(5, len(tw))
        own = {tuple(tw[i:i + k]) for i in range(len(tw) - k + 1)}
        grams = [tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)]
        wide = len(tw) - k + 1
        for i in range(max(1, len(grams) - wide + 1)):
            if grams and len(own & set(grams[i:i + wide])) >= 0.8 * len(own):
                out.add(name)
    return out


def texts():
    rng = random.Random(9)
    filler = ["the", "of", "and", "license", "copy", "zebra", "lantern", "under", "to", "use"] + [f"f{i}" for i in range(50)]
    fill = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    out = [None, "", "?!", "all rights", "All Rights RESERVED.", "licensed", "x " * 60000 + L.TEMPLATES["mit-grant"]]
    for t in L.TEMPLATES.values():
        out += [t, fill(33) + " " + t.upper() + "\n" + fill(40), fill(7) + t.replace(" ", "  "), fill(3) + " " + " ".join(t.split()[1:]), fill(90)]
        ws = t.split()
        if len(ws) > 20:
            for edits in (1, 2, 8):
                w = ws[:]
                for k in rng.sample(range(len(w)), edits):
                    w[k] = "edited"
                out.append(fill(50) + " " + " ".join(w) + " " + fill(50))
    return out


def test_finds_equal_plain_comparison(spark):
    data = [(i, t, "f", 2) for i, t in enumerate(texts())] + [(None, "all rights reserved", "f", 2), (4, "All Rights RESERVED.", "f", 2)]
    got = L.report(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    by = {r.doc_id: r for r in got}
    for i, t in enumerate(texts()):
        assert set(filter(None, by[i].licenses.split(","))) == plain(t), (i, t and t[-300:])
    assert by[None].licenses == "all-rights-reserved" and by[0].n_matches == 0 and by[0].containment == 0


def test_bands_find_similar_sets():
    t, rng = L.Templates({"t": " ".join(f"w{i}" for i in range(100))}), np.random.default_rng(1)
    base = rng.integers(1, 2**63, 60, np.uint64)
    sets = np.stack([np.r_[base[:45], rng.integers(1, 2**63, 15, np.uint64)] for _ in range(3000)])      # Jaccard 0.6
    assert (t.bands(sets) == t.bands(base[None, :])).any(1).mean() >= 0.999


def test_two_places_and_spans(spark):
    text = "aa bb " + L.TEMPLATES["mit-notice"] + " cc dd ee ff gg " + L.TEMPLATES["mit-notice"]
    found = L.scanned(spark.createDataFrame([(1, text, "f", 2)], SCHEMA)).first().found
    assert [(f.license, f.first_word, f.end_word) for f in found] == [("mit-notice", 2, 7), ("mit-notice", 12, 17)]


def test_empty_table(spark):
    assert L.report(spark.createDataFrame([], SCHEMA)).count() == 0
