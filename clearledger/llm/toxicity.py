"""Toxicity: maximum-scoring segments of token log-odds, aggregated by extreme-value calibration.

Tokens are lower-cased letter runs; each stands for itself and for its first 3 to 6 letters, so that forms
of a stem share evidence. The log-odds of a token between toxic and other labelled texts has a Dirichlet prior
(the pooled counts, scaled), and counts only where it is significant. A word scores as its strongest
significant feature, other words cost a constant. One linear scan (Ruzzo and Tompa) finds every maximal
scoring segment of a text; each segment's score s becomes lambda * s - ln(K * words), its significance under the
extreme-value law whose lambda and K come from the other texts, and the sum of the positive ones is turned into a
probability by a logistic curve.

Labels are a bounded sample of per_class rows of each class. Null, empty and letterless texts have no segment
and get the curve's value there, below one half. Without toxic labels every score is 0. Repeated rows score each and alike; of
rows that share an id one teaches, with the id's largest label. Features that are equally strong are taken by name. An empty table gives an empty
result. Other columns stay as they are, but a column named like the score is replaced.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import labelled_sample, materialise

TOKEN = re.compile(r"[^\W\d_]+")
STEMS = (3, 4, 5, 6)


def features(word: str) -> list[str]:
    return [word + "$", *[word[:n] for n in STEMS if len(word) >= n]]


def segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, start, end) in one scan: each has a positive score, none can grow.

    Candidates lie on a stack with the running sums before and after them; a new one merges back to the last candidate
    that starts lower, which is found along links of ever lower starts, so the whole scan is linear.
    """
    left: list[float] = []
    right: list[float] = []
    spans: list[tuple[int, int]] = []
    link: list[int] = []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start = i
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= before:
                j = link[j]
            if j < 0 or right[j] >= total:
                left.append(before), right.append(total), spans.append((start, i + 1)), link.append(j)
                break
            before, start = left[j], spans[j][0]
            del left[j:], right[j:], spans[j:], link[j:]
    return [(r - a, *span) for a, r, span in zip(left, right, spans, strict=True)]


@dataclass
class Model:
    """score: of significant features; other: of any other word; lam, k: the extreme-value law; the logistic curve."""

    score: dict[str, float]
    other: float = -0.1
    lam: float = 1.0
    k: float = 0.1
    slope: float = 1.0
    cut: float = 1.0

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def word(self, w: str) -> float:
        best = max((self.score.get(f, 0.0) for f in features(w)), key=abs, default=0.0)
        s = best if best > 0 else min(best, self.other)
        if len(w) < 40:
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[w] = s
        return s

    def scan(self, text: str | None) -> tuple[list[tuple[float, int, int]], int]:
        """Segments over words, and the number of words. Runs of words without evidence are one step."""
        words = TOKEN.findall((text or "").lower())
        get, slow = self.known.get, self.word
        scores = [s if (s := get(w)) is not None else slow(w) for w in words]
        if not any(s > 0 for s in scores):
            return [], len(words)
        return segments(scores), len(words)

    def evidence(self, text: str | None) -> float:
        found, n = self.scan(text)
        base = math.log(self.k * max(n, 1))
        return sum(max(0.0, self.lam * s - base) for s, _, _ in found)

    def passages(self, text: str | None) -> list[dict]:
        """The significant segments with their words' places and significance."""
        found, n = self.scan(text)
        spans = [m.span() for m in TOKEN.finditer((text or "").lower())]
        base = math.log(self.k * max(n, 1))
        return [{"start": spans[a][0], "end": spans[b - 1][1], "bits": (self.lam * s - base) / math.log(2)} for s, a, b in found if self.lam * s > base]

    def probability(self, x: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * (x - self.cut)))))


def _counts(taught: DataFrame, text: str) -> DataFrame:
    """(feature, toxic, other): in how many sampled texts of each class a feature occurs. Added up per task, then by Spark."""

    def count(batches):
        seen: dict[str, list[int]] = {}
        for b in batches:
            for t, y in zip(b["t"], b["y"], strict=True):
                for f in {f for w in set(TOKEN.findall((t or "").lower())) for f in features(w)}:
                    seen.setdefault(f, [0, 0])[int(y)] += 1
                if len(seen) > 100_000:
                    yield pd.DataFrame([(f, n[1], n[0]) for f, n in seen.items()], columns=["f", "toxic", "other"])
                    seen = {}
        yield pd.DataFrame([(f, n[1], n[0]) for f, n in seen.items()], columns=["f", "toxic", "other"])

    return taught.select(F.col(text).alias("t"), F.col("_label").alias("y")).mapInPandas(count, "f string, toxic long, other long").groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def fit(docs: DataFrame, labels: DataFrame, keep: Column, id_col: str = "doc_id", text: str = "text", label_col: str = "toxic", per_class: int = 10_000, prior: float = 50.0, least: float = 2.5, most_features: int = 50_000) -> Model | None:
    """Learn from the labelled rows where keep holds. None if a class is missing.

    Features count where their log-likelihood ratio passes 2 ln(number of features), so that by chance about one
    would, and their log-odds reach `least`; the most_features strongest of them bound the model's size.
    """
    taught = materialise(labelled_sample(docs.select(id_col, text), labels, id_col, label_col, keep, per_class).select(F.col(text).cast("string").alias("text"), "_label", "_id"), "taught")
    n = {r._label: r.n for r in taught.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    # the informative prior spreads pseudo-texts over features as all sampled texts use them: `prior` a class, fewer in a small sample
    all_n = n[0] + n[1]
    prior = min(prior, 0.02 * all_n)
    a = (F.col("toxic") + F.col("other")) * F.lit(prior / all_n) + 0.01
    odds = lambda hit, size: F.log((F.col(hit) + a) / (F.lit(float(size + prior)) - F.col(hit) - a + 1))
    delta = odds("toxic", n[1]) - odds("other", n[0])
    seen = materialise(_counts(taught, "text").where("toxic + other >= 4"), "features")
    tests = max(2, seen.count())
    x_log = lambda hit, size: F.when(F.col(hit) > 0, F.col(hit) * F.log(F.col(hit) * all_n / ((F.col("toxic") + F.col("other")) * size))).otherwise(0.0)
    scored = (
        seen.select("f", delta.alias("d"), (2 * (x_log("toxic", n[1]) + x_log("other", n[0]))).alias("g"))
        .where((F.col("g") >= F.lit(2 * math.log(tests))) & (F.col("d") >= least)).orderBy(F.desc("g"), "f").limit(most_features)
    )
    model = Model({r.f: r.d for r in scored.collect()})
    if model.score:
        _calibrate(model, taught)
    return model


def _calibrate(model: Model, taught: DataFrame) -> None:
    """The cost of a neutral word, lambda, K and the logistic curve, from the sampled texts."""
    def look(batches):
        for b in batches:
            rows = []
            for t, y in zip(b["text"], b["_label"], strict=True):
                found, n = model.scan(t)
                rows.append((int(y), n, sum(s > 0 for s in (model.known.get(w, 0.0) for w in TOKEN.findall((t or "").lower()))), max([s for s, _, _ in found], default=0.0), [float(s) for s, _, _ in found]))
            yield pd.DataFrame(rows, columns=["y", "n", "hits", "top", "all"])

    first = taught.mapInPandas(look, "y int, n long, hits long, top double, all array<double>").groupBy("y").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()
    per = {r.y: (r.hits + 0.5) / max(r.n, 1) for r in first}
    # by chance a positive word comes once in 1 / rate words; neutral words cost so much that chance has a negative mean
    rate, mean = per[0], float(np.mean(list(model.score.values()) or [1.0]))
    model.other = -max(0.05, 2 * rate * mean)
    model.known.clear()
    # lambda solves E[exp(lambda * score)] = 1 under chance
    lo, hi = 1e-3, 50.0
    f = lambda x: rate * math.exp(min(600, x * mean)) + (1 - rate) * math.exp(x * model.other) - 1
    while hi - lo > 1e-6:
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    model.lam = min(hi, 2.0)
    rows = taught.mapInPandas(look, "y int, n long, hits long, top double, all array<double>").toPandas()  # the bounded sample, a few numbers a row
    rows["all"] = [sorted(x) for x in rows["all"]]
    rows = rows.sort_values(["y", "n", "top", "hits"], kind="stable")
    calm = rows[rows["y"] == 0]
    # K by the mean of the largest segments of other texts: E[lambda * top] = ln(K n) + 0.5772
    k = np.exp(np.mean(model.lam * calm["top"] - np.log(np.maximum(calm["n"], 1)) - 0.5772))
    model.k = float(np.clip(k, 1e-9, 1.0))
    x = np.array([sum(max(0.0, model.lam * s - math.log(model.k * max(n, 1))) for s in a) for a, n in zip(rows["all"], rows["n"], strict=True)])
    y = rows["y"].to_numpy(float)
    w = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    v = np.log1p(x)
    a, b = 1.0, -1.0
    for _ in range(200):  # logistic curve in ln(1 + x), Newton steps, slightly damped towards 0
        p = 1 / (1 + np.exp(-np.clip(a * v + b, -50, 50)))
        g = np.array([np.sum(w * (p - y) * v) + 1e-3 * a, np.sum(w * (p - y))])
        q = w * p * (1 - p)
        h = np.array([[np.sum(q * v * v) + 1e-3, np.sum(q * v)], [np.sum(q * v), np.sum(q) + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    # a text without evidence stays below one half whatever the sample
    model.slope = max(float(a), 1e-3)
    model.cut = max(float(-b / model.slope), 1e-3)


def scorer(model: Model | None):
    """A column function: text -> score from 0 to 1."""

    @pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.zeros(len(texts)))
        return pd.Series([model.probability(math.log1p(model.evidence(t))) for t in texts], dtype="float64")

    return run


def passage_finder(model: Model):
    """A column function: text -> array of the significant passages (start, end, bits)."""

    @pandas_udf("array<struct<start: int, end: int, bits: double>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.passages(t) for t in texts])

    return run


def score(docs: DataFrame, labels: DataFrame, keep: Column, id_col: str = "doc_id", text: str = "text", into: str = "score", **how) -> DataFrame:
    """docs with a column `into`: how likely the label is 1. Labels teach only where keep holds."""
    return docs.withColumn(into, scorer(fit(docs, labels, keep, id_col, text, **how))(F.col(text).cast("string")))
