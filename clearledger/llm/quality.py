"""Quality rules: a learned decision list over text statistics.

Sequential covering: rules for label 0 (bad) are learned one at a time. Each rule is a conjunction of
thresholds, grown on one part of the labelled rows by information gain, pruned on the other part, and
kept while it is right more often than the rest; the rows it covers are then set aside. The list becomes
one ordered Spark conditional expression, so scoring needs no Python.

Learning takes a bounded sample of labelled rows (per_class of each class, those with the smallest id
hash), whose statistics are a few numbers a row. Null and empty texts have all statistics 0. With no
labelled rows, or rows of one class alone, the list is empty and keeps everything. Repeated rows are judged each and alike; of rows
that share an id one teaches, with the id's largest label. An empty table gives an empty result. Of equally good thresholds the first feature's lowest
wins. Only the id and the text are read, so further columns of any name do nothing and are not returned.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import labelled_sample, materialise

SYMBOLS = "#*$%&|<>"
_SYMBOL = re.compile(r"[#*$%&|<>]")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_distinct"]
#: What rules look at, as ratios of the statistics; each is a Spark expression of them.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "mean_word_chars": "coalesce(try_divide(word_chars, n_words), 0D)",
    "symbol_share": "coalesce(try_divide(n_symbols, n_words), 0D)",
    "dup_line_words": "coalesce(try_divide(n_dup_lines * 10, n_words), 0D)",
    "repeat_share": "coalesce(try_divide(n_repeat_words, n_words), 0D)",
    "upper_share": "coalesce(try_divide(n_upper, n_letters), 0D)",
    "letter_share": "coalesce(try_divide(n_letters, word_chars), 0D)",
    "distinct_share": "coalesce(try_divide(n_distinct, n_words), 0D)",
}


def repeat_words(ids: np.ndarray, size: int) -> int:
    """Words that lie in a 3-word window found twice or more; ids number the text's words below size."""
    if len(ids) < 4:
        return 0
    if size < 2_000_000:
        grams = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # the product would not fit 64 bits: number the pairs first
        _, pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
        grams = pairs[:-1] * size + ids[2:]
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The statistics of a whole text, in the order of STATS."""
    if not text:
        return (0,) * len(STATS)
    words = text.encode("utf-8", "replace").split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line and _BLANK.sub("", line[:64]) or _BLANK.sub("", line):
            seen.add(line)
    letters = sum(c.isalpha() for c in text) if not text.isascii() else len(text) - len(_NOT_ASCII_LETTER.findall(text))
    upper = len(_UPPER.findall(text))
    blanks = len(_BLANK.findall(text))
    return (
        len(words), len(text) - blanks, len(_SYMBOL.findall(text)), dup, repeat_words(ids, max(1, len(number))),
        upper, letters, len(number),
    )


_NOT_ASCII_LETTER = re.compile(r"[^A-Za-z]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def stats_of(text: Column) -> Column:
    """The statistics of a text column as a struct."""

    @pandas_udf(", ".join(f"{s} long" for s in STATS))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_stats(t) for t in texts], columns=STATS)

    return run(text)


@dataclass
class Rule:
    """A conjunction of (feature, is an upper bound, threshold) with the verdict of the rows it covers."""

    tests: list[tuple[str, bool, float]] = field(default_factory=list)

    def covers(self, x: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
        for name, upper, at in self.tests:
            rows = rows[x[name][rows] <= at] if upper else rows[x[name][rows] > at]
        return rows

    def expression(self) -> Column:
        out = F.lit(True)
        for name, upper, at in self.tests:
            value = F.expr(FEATURES[name])
            out = out & ((value <= F.lit(float(at))) if upper else (value > F.lit(float(at))))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'<=' if u else '>'} {t:.6g}" for n, u, t in self.tests) or "always"


def _gain(p0: float, n0: float, p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Information gain of covering p and n instead of p0 and n0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        g = p * (np.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
    return np.where(p > 0, g, -np.inf)


def _grow(x: dict[str, np.ndarray], y: np.ndarray, rows: np.ndarray, most: int) -> Rule:
    rule = Rule()
    while len(rule.tests) < most:
        p0, n0 = float(y[rows].sum()), float((~y[rows]).sum())
        if not p0 or not n0:
            break
        best = (1e-9, None)
        for name in FEATURES:
            v = x[name][rows]
            order = np.argsort(v, kind="stable")
            v, hit = v[order], y[rows][order]
            cut = np.flatnonzero(v[1:] > v[:-1])
            if not len(cut):
                continue
            p = np.cumsum(hit)[cut].astype(float)
            n = cut + 1 - p
            for upper, gain in ((True, _gain(p0, n0, p, n)), (False, _gain(p0, n0, p0 - p, n0 - n))):
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (name, upper, float((v[cut[k]] + v[cut[k] + 1]) / 2)))
        if best[1] is None:
            break
        rule.tests.append(best[1])
        rows = Rule([best[1]]).covers(x, rows)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray, rows: np.ndarray) -> tuple[Rule, float]:
    """The start of the rule that does best on rows not grown from, and its share of right rows there."""
    best = (-2.0, Rule(), 0.0)
    for k in range(1, len(rule.tests) + 1):
        part = Rule(rule.tests[:k])
        hit = part.covers(x, rows)
        p, n = int(y[hit].sum()), int((~y[hit]).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0]:
            best = (worth, part, (p + 1) / (p + n + 2))
    return best[1], best[2]


def learn(x: dict[str, np.ndarray], bad: np.ndarray, grown: np.ndarray, precision: float = 0.7, most_tests: int = 4, most_rules: int = 24) -> list[Rule]:
    """Rules for bad rows. grown: rows to grow from; the others prune. Stops at the first rule below precision."""
    left = np.arange(len(bad))
    rules: list[Rule] = []
    while len(rules) < most_rules and bad[left].sum() >= 5:
        grow, test = left[grown[left]], left[~grown[left]]
        if not bad[grow].any() or not len(test):
            break
        rule, right = _prune(_grow(x, bad, grow, most_tests), x, bad, test)
        if not rule.tests or right < precision:
            break
        rules.append(rule)
        left = np.setdiff1d(left, rule.covers(x, left), assume_unique=True)
    return rules


def as_expression(rules: list[Rule]) -> Column:
    """The list in order: the first rule that holds gives false (not kept), none gives true."""
    out = None
    for rule in rules:
        out = F.when(rule.expression(), F.lit(False)) if out is None else out.when(rule.expression(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def decision_list(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", per_class: int = 20_000) -> list[Rule]:
    """Learn from stats (id and STATS) and labels (1: good). Only rows that the base test passes teach."""
    names = list(FEATURES)
    taught = labelled_sample(stats.where(~base_failed()), labels, id_col, label_col, F.lit(True), per_class)
    rows = taught.select(
        F.col("_label"), (F.xxhash64("_id") % 3 != 0).alias("_grow"), *[F.expr(e).alias(n) for n, e in FEATURES.items()]
    ).orderBy(F.xxhash64("_id"), *names).toPandas()  # at most 2 * per_class rows of numbers
    if rows.empty:
        return []
    return learn({n: rows[n].to_numpy(float) for n in names}, rows["_label"].to_numpy() == 0, rows["_grow"].to_numpy(bool))


def with_stats(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(F.col(id_col), stats_of(F.col(text).cast("string")).alias("_s")).select(id_col, "_s.*")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", per_class: int = 20_000) -> DataFrame:
    """One row per row of docs: id, statistics, base_failed, kept. The statistics are computed once and written."""
    stats = materialise(with_stats(docs, id_col, text), "stats")
    rules = decision_list(stats, labels, id_col, "quality", per_class)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & as_expression(rules))
