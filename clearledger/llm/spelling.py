"""Spelling variants: pairs of words one edit apart by PartEnum signatures over letter multisets, and each word's commoner form.

A word's multiset of letters is a binary vector with a place for each letter and occurrence (the second `t` is a place of its own). One replaced
code point moves two places, one inserted or deleted code point moves one. Places are dealt to parts, letters by the rank of their frequency so
that parts carry alike. Two vectors at most two places apart agree on all but two of PARTS parts, so words of one length share a signature for
some choice of PARTS - 2 parts; words whose lengths differ by one agree on all but one part. Words meet by equality of signature and length,
and each pair that meets is verified by edit distance. Signatures are numbers from a hash of the parts: equal parts always give equal ones.

A signature that more than HOT words share is split: two words one edit apart agree before or after the middle, so such words meet only where
they also share the half of the spelling on that side. That is exact as well; no word, signature or partner is capped.

Rows: null and empty texts have no words; texts of any length are read whole; repeated rows count again; a null id reads as an empty one. An empty
table, or one without two near words, gives words without forms or no rows. Further columns don't matter, whatever their names.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import materialise
from .merkle import LOWER, UPPER

LETTERS = r"[A-Za-zÀ-ÿ]"
PARTS, HOT = 7, 1000
_CHOICES = [(0, c) for c in itertools.combinations(range(PARTS), 2)] + [(k, (j,)) for k in (1, 2) for j in range(PARTS)]
#: The choices whose posts are made together: those for words of one length, and the others.
ROUNDS = [[c for c in _CHOICES if c[0] == 0], [c for c in _CHOICES if c[0] > 0]]


def occurrences(docs: DataFrame, id_col: str, text_col: str, least: int, every: int) -> DataFrame:
    """(word): the lower-cased runs of letters of all texts, of `least` code points or more; every `every`-th (id, run) by crc32 lacks one code point."""
    run = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))).alias("run"))
    low = run.select("id", F.translate("run", UPPER, LOWER).alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % every == 0, F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))).otherwise(F.col("run"))
    return low.select(word.alias("word")).where(F.length("word") >= least)


def letter_ranks(words: DataFrame) -> dict[int, int]:
    """Code point to its rank by frequency over the words: a row a letter is collected, so as many as the alphabet has."""
    seen = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").groupBy("c").agg(F.count("*").alias("n")).collect()
    return {ord(r.c): k for k, r in enumerate(sorted(seen, key=lambda r: (-r.n, r.c)))}


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, over arrays that wrap."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def part_counts(words: list[str], ranks: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the places in each part, length) of each word. Place (letter, k-th occurrence) lies in part (rank of the letter + k) mod PARTS."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    pairs, n = np.unique(np.repeat(np.arange(len(words)), lengths) << 21 | points, return_counts=True)
    word, point = pairs >> 21, pairs & 0x1FFFFF
    values, inverse = np.unique(point, return_inverse=True)
    rank = np.array([ranks.get(int(v), int(v)) for v in values], dtype=np.int64)[inverse]
    weight = _mix(point.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(words), PARTS), dtype=np.uint64)
    for j in range(PARTS):
        first = (j - rank - 1) % PARTS + 1  # the first occurrence that lies in this part
        places = np.where(n >= first, (n - first) // PARTS + 1, 0).astype(np.uint64)
        np.add.at(out[:, j], word, places * weight)
    return out, lengths


def signatures(words: list[str], ranks: dict[int, int], choices: list[tuple[int, tuple[int, ...]]] = _CHOICES) -> np.ndarray:
    """A row a word: numbers of its signatures, in the order of choices: kind 0 for words of one length, 1 and 2 for the longer and the shorter of a pair."""
    parts, lengths = part_counts(words, ranks)
    mixed = _mix(parts * np.arange(3, 2 * PARTS + 2, 2, dtype=np.uint64) + np.arange(PARTS, dtype=np.uint64))
    whole, out = mixed.sum(axis=1, dtype=np.uint64), []
    for kind, left_out in choices:
        tag = sum(1 << j for j in left_out) | (kind > 0) << PARTS
        longer = (lengths + (kind == 2)).astype(np.uint64)
        out.append(_mix(whole - sum(mixed[:, j] for j in left_out) + np.uint64(tag) * np.uint64(0x9E3779B97F4A7C15) + (longer << np.uint64(32))))
    return np.stack(out, axis=1).view(np.int64) if words else np.zeros((0, len(choices)), dtype=np.int64)


def posts(words: DataFrame, ranks: dict[int, int], choices: list[tuple[int, tuple[int, ...]]]) -> DataFrame:
    """(sig, kind, word) of each word under each of its signatures in choices."""
    kinds = F.array(*[F.lit(kind) for kind, _ in choices])

    @pandas_udf("array<long>")
    def run(w: pd.Series) -> pd.Series:
        with np.errstate(over="ignore"):
            return pd.Series(list(signatures(w.tolist(), ranks, choices)), dtype=object)

    made = words.select("word", F.explode(F.arrays_zip(run("word").alias("sig"), kinds.alias("kind"))).alias("one"))
    return made.select("one.sig", "one.kind", "word")


def _half(side: str) -> Column:
    """The part of the spelling before or after the middle of the longer word of a pair."""
    middle = F.shiftright(F.length("word") + F.when(F.col("kind") == 2, 1).otherwise(0), 1)
    text = F.col("word").substr(F.lit(1), middle) if side == "<" else F.col("word").substr(middle + F.when(F.col("kind") == 2, 0).otherwise(1), F.length("word"))
    return F.concat(F.lit(side), text)


def _met(words: DataFrame, ranks: dict[int, int], choices: list[tuple[int, tuple[int, ...]]], hot: int) -> DataFrame:
    """(a, b): pairs that meet under a signature in choices, which are of kind 0 or of the others, and are one edit apart.

    A word travels with one number, of its signature or, where that is shared by more than `hot` words, of signature and half. Numbers that
    happen to be equal only make a pair more that is verified. Which signatures are hot is written first, so that the posts are not dealt out for it.
    """
    posted = posts(words, ranks, choices)
    sizes = materialise(posted.groupBy("sig").agg(F.count("*").alias("size")).where(F.col("size") > hot).select("sig", F.lit(True).alias("split")), "hot")
    keys = F.when(F.col("split"), F.array(F.xxhash64("sig", _half("<")), F.xxhash64("sig", _half(">")))).otherwise(F.array("sig"))
    keyed = posted.join(sizes, "sig", "left").select("kind", "word", F.explode(keys).alias("key"))
    side = lambda kind, name: keyed.where(F.col("kind") == kind).select("key", F.col("word").alias(name))
    if choices[0][0] == 0:  # both sides are one exchange
        met = side(0, "a").join(side(0, "b"), "key").where("a < b")
    else:
        met = side(1, "a").join(side(2, "b"), "key")
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b) of all words one inserted, deleted or replaced code point apart, each pair once. words: distinct and not null.

    The choices are taken in ROUNDS, each of which writes its pairs, so that no exchange holds the posts of all.
    """
    ranks = letter_ranks(words)
    found = [materialise(_met(words, ranks, choices, hot), "met") for choices in ROUNDS]
    return reduce(DataFrame.unionByName, found).distinct()


def follow(forms: DataFrame, rounds: int = 40) -> DataFrame:
    """(word, root) of forms (word, form) that have no cycles: each round doubles the way that is followed, and is written."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialise(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now
    raise RuntimeError(f"forms did not end in {rounds} rounds")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, most_often: int = 10, every: int = 31, min_count: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word with `least` code points and min_count occurrences or more.

    form: the near word of largest n (ties: smallest), if that n is most_often times the word's; root: where forms lead to from the word.
    """
    words = materialise(occurrences(docs, id_col, text_col, least, every).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count), "words")
    pairs = materialise(near_pairs(words.select("word")), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    best = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    lead = -F.col("best.n") >= F.col("n") * most_often
    known = materialise(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(lead, F.col("best.other")).alias("form"), F.when(lead, -F.col("best.n")).alias("form_n")), "forms")
    roots = follow(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: Near words by deletions: words of one length that agree without the code point at one place, or a word that another gives by one deletion.
SPELLING_SQL = """
WITH RECURSIVE t AS (SELECT LIST(LIST_REDUCE(RANGE(8), lambda c, i: CASE WHEN c % 2 = 1 THEN XOR(c >> 1, 3988292384) ELSE c >> 1 END, k) ORDER BY k) AS crc FROM (SELECT UNNEST(RANGE(256)) AS k)),
o AS (SELECT COALESCE(CAST(doc_id AS VARCHAR), '') AS id, TRANSLATE(UNNEST(REGEXP_EXTRACT_ALL(text, '[A-Za-z\\x{C0}-\\x{FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
b AS (SELECT run, HEX(ENCODE(id || ':' || run)) AS x, COUNT(*) AS times FROM o GROUP BY ALL),
h AS (SELECT run, times, XOR(LIST_REDUCE(LIST_TRANSFORM(RANGE(LENGTH(x) // 2), lambda i: CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT)), lambda c, v: XOR(c >> 8, crc[1 + XOR(c, v) % 256]), 4294967295), 4294967295) AS h FROM b, t),
w AS (SELECT word, CAST(SUM(times) AS BIGINT) AS n FROM (SELECT times, CASE WHEN h % 31 = 0 THEN run[: h % LENGTH(run)] || run[h % LENGTH(run) + 2 :] ELSE run END AS word FROM h) WHERE LENGTH(word) >= 7 GROUP BY word HAVING SUM(times) >= 2),
d AS (SELECT word, n, i, word[: i] || word[i + 2 :] AS rest FROM (SELECT word, n, UNNEST(RANGE(LENGTH(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word AND LENGTH(a.word) = LENGTH(b.word)
  UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.rest = w.word UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.rest = w.word),
m AS (SELECT word, COUNT(*) AS n_near, FIRST(other ORDER BY other_n DESC, other) AS best, MAX(other_n) AS best_n FROM p GROUP BY word),
k AS (SELECT w.word, n, COALESCE(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM w LEFT JOIN m USING (word)),
r AS (SELECT word, word AS root, 0 AS step FROM k UNION ALL SELECT r.word, k.form, step + 1 FROM r JOIN k ON k.word = r.root WHERE k.form IS NOT NULL)
SELECT k.word, form, root, n, n_near, form_n FROM k JOIN (SELECT word, ARG_MAX(root, step) AS root FROM r GROUP BY word) USING (word)
"""
