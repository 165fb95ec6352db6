"""The audit against plain dictionaries, with blocks of any size; the merge's order and sums; odd rows; empty table."""

import random
import re
from collections import Counter, defaultdict

from plotloom.llm import divergence as D

SCHEMA = "doc_id long, lang string, source string, text string, item string, value int, p long, terms string"


def brute(data, least, top):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, lang, source, text, *_ in data:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for g, s in groups if g == lang)

        def share(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}
        whole = share(sum((count[lang, s] for s in sources), Counter()))
        by = {s: share(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(by[s][t] - by[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(whole[t] - by[s][t], t.encode(), t) for t in kept if count[lang, s][t] and by[s][t] > whole[t]]
            out += [(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def rows(seed=5):
    rng = random.Random(seed)
    words = ["the", "The", "É", "é", "e", "zebra", "don't", "x1y2", "漢字", "a_b", "ABC-abc", "[tag]", "{k}", "😀", "\x85next", "nbsp here"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    data = []
    for i in range(500):
        lang = rng.choice(["en", "en", "de", None, "", "fr"])
        source = "hot" if i % 3 == 0 else rng.choice(["s1", "s2", None, "", "ünï", "ａ", "😀", "s10"])
        weight = [1 + (hash_of(source) * (k + 3)) % 11 for k in range(len(words))]
        data.append((i, lang, source, " ".join(rng.choices(words, weight, k=rng.randrange(0, 60)))))
    data += [(900, "xx", "only", "few words here"), (901, "xx", "none", None), (902, "yy", "alone", "a b"), (903, "en", "empty", ""), (904, "en", "digits", "1 2 3 __ @"), (905, "en", "nul", "the\x00zebra")]
    data += [(906, "en", "rep", "same text again"), ] * 40 + [(907, "en", "long", "the zebra " * 60_000)]
    return [(*r, "item", 1, 2, "terms") for r in data]


def hash_of(s):
    return sum((s or "").encode()) % 97


def test_audit_equals_plain_counts(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(6)
    for least, top, most in ((3, 50, 40), (12, 5, 10**6)):
        assert sorted(tuple(r) for r in D.audit(docs, least, top, most).collect()) == brute(data, least, top)


def test_pairs_added_up_early(spark, monkeypatch):
    data = rows(8)
    monkeypatch.setattr(D, "PAIRS", 7)
    assert sorted(tuple(r) for r in D.audit(spark.createDataFrame(data, SCHEMA), 4, 3).collect()) == brute(data, 4, 3)


def test_merge_adds_runs_in_order():
    rng, pieces, want = random.Random(1), [], defaultdict(int)
    docs = Counter()
    block = D.Block()
    for i in range(400):
        lang, source = rng.choice("ab"), rng.choice("xyz")
        terms = rng.choices([f"t{chr(97 + k)}" for k in range(26)], k=9)
        block.add(lang, source, " ".join(terms))
        docs.update((lang, t.encode()) for t in set(terms))
        for t, n in Counter(terms).items():
            want[lang, t.encode(), source] += n
        if block.postings > 30 or i == 399:
            pieces += [p for b in block.runs(3) for p in D.pieces(b)]
    pieces.sort(key=lambda p: (p[0], p[1], p[2][0]))
    for least in (0, 65):
        got = list(D.merged(iter(pieces), least))
        assert len({(lang, t) for lang, t, _ in got}) == len(got)
        held = {k: n for k, n in want.items() if docs[k[:2]] >= least}
        assert {(lang, t, s): n for lang, t, sums in got for s, n in sums.items()} == held


def test_counts_beyond_64_bits_of_product(spark):
    df = spark.createDataFrame([(10**13, 3 * 10**13, 7)], "n long, total long, terms long")
    assert df.select(D._probability("n", "total", "terms")).first()[0] == 1 + 10**9 * (10**13 + 5) // (3 * 10**13 + 35)


def test_empty_table(spark):
    made = D.audit(spark.createDataFrame([], SCHEMA))
    assert made.columns == ["lang", "source", "part", "item", "value", "rank"] and made.count() == 0
