"""Toxicity by class-conditional Kneser-Ney bigram models that share their backoff counts.

A word's probability in a class rests on how many distinct words it follows there, discounted, and backs off to the counts of
both classes together. A bigram's probability rests on its share of the class's discounted bigrams after that word, backs off
to the share among both classes, tilted as the word is, and both mix with the word's probability by one weight per preceding word, so that a bigram
nobody has seen says no more than its word. Text is scored by the toxic over the ordinary log-likelihood, divided by the number
of words: of the whole text and of its most telling runs of 1 and 3 words. A logistic fit on other labelled rows turns the
three numbers into a score.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows, from_rows, saved
from plotloom.llm.decontaminate import words_of
from plotloom.llm.quality import LOWER, UPPER

#: About so many labelled rows of either class are drawn (by a hash of doc_id) for the counts, and as many to fit the scale.
MAX_DOCS = {1: 5_000, 0: 10_000}
#: The model holds the most telling words and bigrams (log ratio times count) up to these numbers, whatever the sample's texts hold.
MAX_WORDS, MAX_BIGRAMS = 250_000, 250_000
#: Bigrams whose ratio is as near as this to their word's are left to the word.
NEAR = 0.25
DISCOUNT = 0.75
#: What each word and each preceding word adds to the shared counts; keeps chance words of one class from telling much.
PRIOR_WORD, PRIOR_BIGRAM = 10.0, 50.0
RUNS = (1, 3)
FOLDS, HELD_OUT, SCALE = 5, 0, 4


@dataclass
class Model:
    """Log-likelihood ratios of words and of bigrams seen in the sample; place 0 stands for all other words."""

    vocab: dict[bytes, int]
    word: np.ndarray
    pair_keys: np.ndarray
    pair: np.ndarray
    weights: np.ndarray

    def ratios(self, text: bytes | None) -> np.ndarray:
        ws = words_of(text)
        ids = np.fromiter((self.vocab.get(w, 0) for w in ws), np.int64, len(ws))
        out = self.word[ids]
        if len(self.pair_keys) and len(ids):
            keys = np.concatenate([[self.vocab.get(b"", 0)], ids[:-1]]) * len(self.word) + ids
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            hit = self.pair_keys[at] == keys
            out[hit] = self.pair[at[hit]]
        return out

    def features(self, text: bytes | None) -> list[float]:
        r = self.ratios(text)
        if not len(r):
            return [0.0] * (1 + len(RUNS))
        sums = np.concatenate([[0.0], np.cumsum(r)])
        return [float(r.mean()), *(float((sums[n:] - sums[:-n]).max() / n) for n in (min(k, len(r)) for k in RUNS))]

    def score(self, features: list[float]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[0] + np.dot(self.weights[1:], features), -40, 40))))


def fold(doc_id: str = "doc_id"):
    """crc32 of doc_id as text, modulo FOLDS; a null doc_id counts as ''."""
    return (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, fold, text) of a sample of the rows that may be learned from, bounded by MAX_DOCS.

    Labels without a value are left out; a doc_id with several labels is toxic if one of them is. The drawn labels are few,
    by MAX_DOCS, so they are broadcast and the texts stay where they are.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna()
             .groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).withColumn("fold", fold("id")).filter(F.col("fold") != HELD_OUT))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.coalesce(*[F.when(F.col("toxic") == k, F.lit(min(1.0, FOLDS / (FOLDS - 2) * MAX_DOCS[k] / n))) for k, n in sizes.items()], F.lit(0.0))
    drawn = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))
    return as_rows(docs).select(F.col("row.doc_id").cast("long").alias("id"), F.col("row.text").alias("text")).join(F.broadcast(drawn), "id").select("toxic", "fold", "text")


def counted(sample: DataFrame) -> DataFrame:
    """(prev, word, ct, co): how often each bigram stands in toxic and in ordinary texts; the first word follows ''."""
    ws = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    runs = sample.select("toxic", ws.alias("ws")).filter(F.size("ws") > 0).select("toxic", "ws", F.concat(F.array(F.lit("")), "ws").alias("before"))
    each = runs.select("toxic", F.explode(F.arrays_zip("before", "ws")).alias("p")).filter("p.ws is not null")
    return each.groupBy(F.col("p.before").alias("prev"), F.col("p.ws").alias("word")).agg(F.sum("toxic").alias("ct"), F.sum(1 - F.col("toxic")).alias("co"))


def _ratio(top, low):
    return F.log(top / low)


def _level(llr):
    """Levels of |llr| times the count n, in steps of a few percent."""
    return F.floor(16 * F.log2(F.abs(llr) * F.col("n") + 1e-9)).cast("int").alias("level")


def tables(bigrams: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """(word, level, llr) for words seen twice or more, (prev, word, level, llr) for bigrams seen twice or more, and the ratio of
    any other word. The level is that of what the row tells: its log ratio (of bigrams, beyond their word's) times its count."""
    each = bigrams.groupBy("word").agg(F.count_if(F.expr("ct > 0")).alias("nt"), F.count_if(F.expr("co > 0")).alias("no"), F.count("*").alias("ns"), F.sum(F.expr("ct + co")).alias("n"))
    each = saved(each, "words")
    s = each.agg(F.sum("nt").alias("nt"), F.sum("no").alias("no"), F.sum("ns").alias("ns"), F.count_if(F.expr("nt > 0")).alias("tt"), F.count_if(F.expr("no > 0")).alias("to"),
                 F.count("*").alias("v")).first()
    if not s.nt or not s.no:
        empty = each.select("word", F.lit(0).alias("level"), F.lit(0.0).alias("llr"), F.lit(1.0).alias("pt"), F.lit(1.0).alias("po")).limit(0)
        return empty, bigrams.select("prev", "word", F.lit(0).alias("level"), F.lit(0.0).alias("llr")).limit(0), 0.0
    lam = {"nt": DISCOUNT * s.tt / s.nt, "no": DISCOUNT * s["to"] / s.no}
    shared = (F.col("ns") + PRIOR_WORD) / (s.ns + PRIOR_WORD * s.v)
    p = {c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / getattr(s, c) + lam[c] * shared for c in ("nt", "no")}
    words = each.filter("n > 1").select("word", "n", p["nt"].alias("pt"), p["no"].alias("po")).withColumn("llr", _ratio(F.col("pt"), F.col("po")))
    words = words.select("word", _level(F.col("llr")), "llr", "pt", "po")
    # a discount of one leaves bigrams seen once to the backoff
    often = bigrams.withColumn("n", F.col("ct") + F.col("co"))
    before = often.groupBy("prev").agg(F.sum("n").alias("all"), F.sum(F.col("n") - 1).alias("left"), F.sum(F.expr("ct * (n - 1) / n")).alias("lt"),
                                       F.sum(F.expr("co * (n - 1) / n")).alias("lo")).filter("left > 0")
    pairs = often.filter("n > 1").join(before, "prev").join(words.select("word", "pt", "po"), "word")
    own = F.col("left") / F.col("all")
    # as if each bigram had been seen PRIOR_BIGRAM times more, shared out as its words lead one to expect
    tilt = F.expr("lt * pt + lo * po")
    q = {c: (F.expr(f"{c} * (n - 1) / n") + PRIOR_BIGRAM * F.expr(f"{of} * {word}") / tilt) / F.greatest(F.col(of), F.lit(1e-9))
         for c, of, word in (("ct", "lt", "pt"), ("co", "lo", "po"))}
    both = F.expr("(n - 1) / left") / (F.expr("lt / left") * q["ct"] + F.expr("lo / left") * q["co"])
    known = (F.col("lt") > 0) & (F.col("lo") > 0)
    mixed = _ratio(own * both * q["ct"] + (1 - own) * F.col("pt"), own * both * q["co"] + (1 - own) * F.col("po"))
    llr = F.when(known, mixed).otherwise(_ratio(F.col("pt"), F.col("po")))
    told = pairs.select("prev", "word", "n", llr.alias("llr"), _ratio(F.col("pt"), F.col("po")).alias("alone")).filter(F.abs(F.col("llr") - F.col("alone")) > NEAR)
    return words, told.select("prev", "word", _level(F.col("llr") - F.col("alone")), "llr"), float(np.log(lam["nt"] / lam["no"]))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (constant first) of a logistic fit with a ridge; without rows of both classes, the constant alone."""
    if not len(y) or y.min() == y.max():
        return np.array([-40.0 if not len(y) or not y.max() else 40.0] + [0.0] * (1 + len(RUNS)))
    mean, dev = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / dev])
    w, penalty = np.zeros(z.shape[1]), ridge * np.r_[0, np.ones(x.shape[1])]
    for _ in range(50):     # Newton's method; the fit is convex and of few dimensions
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve(z.T * (p * (1 - p) + 1e-9) @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
        w -= step
        if abs(step).max() < 1e-8:
            break
    return np.r_[w[0] - (w[1:] * mean / dev).sum(), w[1:] / dev]


def _scored(rows: DataFrame, model: Model, keep: list[str], features: bool = False) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)
    new = "array<double>" if features else "double"
    schema = rows.select(*keep, F.lit(None).cast(new).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                fs = [m.features(t) for t in b.column("text").cast(pa.large_binary()).to_pylist()]
                col = pa.array(fs, pa.list_(pa.float64())) if features else pa.array([m.score(f) for f in fs], pa.float64())
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), col], [*keep, "score"])
    return rows.select(*keep, "text").mapInArrow(run, schema)


def _frequent(rows: DataFrame, count: str, most: int) -> DataFrame:
    """The rows with the highest counts, all those of a count or none, ``most`` at most."""
    total, least = 0, None
    for r in rows.groupBy(count).agg(F.count("*").alias("rows")).orderBy(F.desc(count)).collect():
        total += r.rows
        if total > most:
            break
        least = r[count]
    return rows.filter(F.col(count) >= least) if least is not None else rows.limit(0)


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """Counts on all folds but the held-out and the scale fold, the scale on the scale fold.

    What reaches the driver: MAX_WORDS and MAX_BIGRAMS rows of the model, and three numbers for each drawn row of the scale fold.
    """
    sample = labelled(docs, labels)
    bigrams = saved(counted(sample.filter(F.col("fold") != SCALE)), "bigrams")
    words, pairs, other = tables(bigrams)
    ws = _frequent(words, "level", MAX_WORDS).select("word", "llr").toArrow()
    vocab = {b"": 1} | {w: i + 2 for i, w in enumerate(ws["word"].cast(pa.binary()).to_pylist())}
    ps = _frequent(pairs, "level", MAX_BIGRAMS).select("prev", "word", "llr").toArrow()
    of = lambda c: [vocab.get(w, -1) for w in ps[c].cast(pa.binary()).to_pylist()]
    ps = [p for p in zip(of("prev"), of("word"), ps["llr"].to_pylist(), strict=True) if min(p[:2]) >= 0]
    keys = np.array([a * (len(vocab) + 1) + b for a, b, _ in ps], np.int64)
    order = np.argsort(keys)
    model = Model(vocab, np.r_[other, other, ws["llr"].to_numpy()], keys[order], np.array([r for *_, r in ps], float)[order], np.zeros(2 + len(RUNS)))
    fits = _scored(sample.filter(F.col("fold") == SCALE), model, ["toxic"], features=True).toPandas()
    model.weights = _logistic(np.array(fits["score"].tolist(), float).reshape(-1, 1 + len(RUNS)), fits["toxic"].to_numpy(float))
    return model


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null and blank texts score as texts that say nothing either way; repeated rows score alike; without labels of both
    classes every score is the same. Only the text is an input of the score.
    """
    rows = as_rows(docs).select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"))
    out = _scored(rows, learned(docs, labels), ["doc_id"])
    return out.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below a half, same columns; nothing is shuffled."""
    rows = as_rows(docs).select("row", F.col("row.text").alias("text"))
    return from_rows(_scored(rows, learned(docs, labels), ["row"]).filter("score < 0.5"))
