"""Whole verdicts and scores against plain learners and scorers, and whole conversations against plain digests."""

from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from clearledger.llm import chat, quality, toxicity
from clearledger.llm.common import fold

from .test_operators import brute_segments

# ---- quality: a learner of loops over rows


def gain(p0, n0, p, n):
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -math.inf


def holds(rule, row):
    return all((row[name] <= at) == upper for name, upper, at in rule)


def grown_rule(rows, most=4):
    rule = []
    while len(rule) < most:
        p0 = sum(bad for _, bad in rows)
        n0 = len(rows) - p0
        if not p0 or not n0:
            break
        best, found = 1e-9, None
        for name in quality.FEATURES:
            values = sorted({x[name] for x, _ in rows})
            cuts = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
            for upper in (True, False):
                for at in cuts:
                    inside = [bad for x, bad in rows if (x[name] <= at) == upper]
                    g = gain(p0, n0, sum(inside), len(inside) - sum(inside))
                    if g > best:
                        best, found = g, (name, upper, at)
        if found is None:
            break
        rule.append(found)
        rows = [r for r in rows if holds([found], r[0])]
    return rule


def plain_rules(rows, precision=0.7):
    """rows: (features, bad, grows). Rules in order."""
    rules = []
    while len(rules) < 24 and sum(bad for _, bad, _ in rows) >= 5:
        grow, test = [(x, b) for x, b, g in rows if g], [(x, b) for x, b, g in rows if not g]
        if not any(b for _, b in grow) or not test:
            break
        long, best = grown_rule(grow), (-2.0, [], 0.0)
        for k in range(1, len(long) + 1):
            hit = [b for x, b in test if holds(long[:k], x)]
            p, n = sum(hit), len(hit) - sum(hit)
            worth = (p - n) / (p + n) if hit else -1.0
            if worth > best[0]:
                best = (worth, long[:k], (p + 1) / (p + n + 2))
        if not best[1] or best[2] < precision:
            break
        rules.append(best[1])
        rows = [r for r in rows if not holds(best[1], r[0])]
    return rules


def test_verdicts_match_a_plain_learner(spark):
    r = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]

    def text(bad):
        own = [r.choice(words) for _ in range(r.randint(60, 160))]
        if bad == 1:
            own = [w.upper() if r.random() < 0.5 else w for w in own]
        if bad == 2:
            own = [w + "$" if r.random() < 0.3 else w for w in own]
        return " ".join(own)

    kinds = [r.choice([0, 0, 1, 2]) for _ in range(360)]
    docs = [(i, text(k)) for i, k in enumerate(kinds)] + [(900, None), (901, ""), (902, "too short")]
    # one label in twelve is wrong, some ids have none, one has two
    taught = {i: int((k == 0) != (r.random() < 0.08)) for i, k in enumerate(kinds) if i % 9}
    labels = [*taught.items(), (900, 1), (None, 0), (1, None), (1, taught[1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: x for x in quality.judge(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert len(got) == len(docs)
    grows = {x.doc_id: x.g for x in df.select("doc_id", (F.xxhash64("doc_id") % 3 != 0).alias("g")).collect()}
    share = lambda a, b: a / b if b else 0.0

    def features(s):
        return {
            "n_words": float(s.n_words), "mean_word_chars": share(s.word_chars, s.n_words), "symbol_share": share(s.n_symbols, s.n_words), "dup_line_words": share(s.n_dup_lines * 10, s.n_words),
            "repeat_share": share(s.n_repeat_words, s.n_words), "upper_share": share(s.n_upper, s.n_letters), "letter_share": share(s.n_letters, s.word_chars), "distinct_share": share(s.n_distinct, s.n_words),
        }

    failed = {i: s.n_words < 50 or 100 * s.n_repeat_words > 50 * s.n_words for i, s in got.items()}
    rules = plain_rules([(features(got[i]), y == 0, grows[i]) for i, y in taught.items() if not failed[i]])
    assert rules and {i: s.base_failed for i, s in got.items()} == failed
    want = {i: not failed[i] and not any(holds(rule, features(s)) for rule in rules) for i, s in got.items()}
    assert {i: s.kept for i, s in got.items()} == want and 0 < sum(want.values()) < len(want)


# ---- toxicity: a scorer of loops over texts


def plain_scores(docs, labels, keep):
    """Scores of all docs (id -> text), from the labels of ids that keep holds for."""
    sample = [(docs[i], y) for i, y in labels.items() if keep(i)]
    size = [sum(y == k for _, y in sample) for k in (0, 1)]
    every = sum(size)
    seen: dict[str, list[int]] = {}
    for text, y in sample:
        for f in {f for w in toxicity.TOKEN.findall((text or "").lower()) for f in [w + "$", *[w[:n] for n in (3, 4, 5, 6) if len(w) >= n]]}:
            seen.setdefault(f, [0, 0])[y] += 1
    seen = {f: n for f, n in seen.items() if sum(n) >= 4}
    prior, score = min(50.0, 0.02 * every), {}
    for f, n in seen.items():
        a = sum(n) * prior / every + 0.01
        odds = [math.log((n[k] + a) / (size[k] + prior - n[k] - a + 1)) for k in (0, 1)]
        g = 2 * sum(n[k] * math.log(n[k] * every / (sum(n) * size[k])) for k in (0, 1) if n[k])
        if g >= 2 * math.log(max(2, len(seen))) and odds[1] - odds[0] >= 2.5:
            score[f] = odds[1] - odds[0]

    def strength(w):
        return max([score[f] for f in [w + "$", *[w[:n] for n in (3, 4, 5, 6) if len(w) >= n]] if f in score], default=None)

    words = lambda t: toxicity.TOKEN.findall((t or "").lower())
    calm = [[strength(w) for w in words(t)] for t, y in sample if y == 0]
    rate = (sum(s is not None for c in calm for s in c) + 0.5) / max(sum(map(len, calm)), 1)
    mean = sum(score.values()) / len(score)
    other = -max(0.05, 2 * rate * mean)
    lo, hi = 1e-3, 50.0
    while hi - lo > 1e-6:
        mid = (lo + hi) / 2
        above = rate * math.exp(min(600, mid * mean)) + (1 - rate) * math.exp(mid * other) >= 1
        lo, hi = (lo, mid) if above else (mid, hi)
    lam = min(hi, 2.0)
    cost = lambda w: other if strength(w) is None else strength(w)
    found = lambda t: [s for s, _, _ in brute_segments([cost(w) for w in words(t)])]
    terms = [lam * max(found(t), default=0.0) - math.log(max(len(words(t)), 1)) - 0.5772 for t, y in sample if y == 0]
    k = min(1.0, max(1e-9, math.exp(sum(terms) / len(terms))))
    evidence = lambda t: math.log1p(sum(max(0.0, lam * s - math.log(k * max(len(words(t)), 1))) for s in found(t)))
    v = [(evidence(t), y) for t, y in sample]
    a, b = 1.0, -1.0
    for _ in range(200):
        ga, gb, haa, hab, hbb = 1e-3 * a, 0.0, 1e-3, 0.0, 1e-9
        for x, y in v:
            p, w = 1 / (1 + math.exp(-max(-50.0, min(50.0, a * x + b)))), 0.5 / size[y]
            ga, gb, q = ga + w * (p - y) * x, gb + w * (p - y), w * p * (1 - p)
            haa, hab, hbb = haa + q * x * x, hab + q * x, hbb + q
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - da, b - db
        if max(abs(da), abs(db)) < 1e-9:
            break
    slope = max(a, 1e-3)
    cut = max(-b / slope, 1e-3)
    return {i: 1 / (1 + math.exp(-max(-50.0, min(50.0, slope * (evidence(t) - cut))))) for i, t in docs.items()}


@pytest.mark.parametrize("seed", [5, 6])
def test_scores_match_a_plain_scorer(spark, seed):
    r = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnr"]

    def text(bad):
        own = [r.choice(words) for _ in range(r.randint(20, 90))]
        if bad:
            at = r.randrange(len(own))
            own[at:at] = [f"grunz{r.choice('abcd')}" if r.random() < 0.6 else r.choice(words) for _ in range(8)]
        elif r.random() < 0.1:
            own.append("grunza")
        return " ".join(own)

    docs = {i: text(i % 4 == 0) for i in range(240)} | {500: None, 501: "", 502: "12 :: 34"}
    labels = {i: int((i % 4 == 0) != (r.random() < 0.05)) for i in docs}
    df = spark.createDataFrame([*docs.items()], "doc_id long, text string")
    told = spark.createDataFrame([*labels.items()], "doc_id long, toxic int")
    got = {x.doc_id: x.score for x in toxicity.score(df, told, fold(F.col("doc_id"), 5) != 0).collect()}
    folds = {x.doc_id: x.k for x in df.select("doc_id", (fold(F.col("doc_id"), 5) != 0).alias("k")).collect()}
    want = plain_scores(docs, labels, folds.get)
    assert got.keys() == want.keys() and max(want.values()) > 0.5 > min(want.values())
    assert max(abs(got[i] - want[i]) for i in want) < 1e-6 and got[500] == got[501] == got[502] < 0.5


# ---- chat: digests of whole conversations

CHAT = "conv_id long, turn long, role string, text string, start long, node string, form int"


def plain_conversations(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations_with_long_texts_ties_and_repeats(spark):
    long = "so <|im_end|> it goes \\ on <\\| and on\n" * 20_000
    rows = [
        (1, 0, "user", long), (1, 1, "assistant", long), (2, 0, "user", long), (2, 1, "assistant", ""), (3, 0, "user", "tied"), (3, 0, "assistant", "tied"), (3, 0, "assistant", "also"), (4, 0, "user", "x"), (4, 0, "user", "x"),
        (5, None, "assistant", "first"), (5, 0, "user", None), (6, 0, None, None), (7, 3, "assistant", "<|im_end|>\n<|im_start|>assistant\nok"), (None, 0, "user", "hi"), (None, 1, "assistant", "ho"), (8, 0, "", ""),
    ]
    packed, convs = chat.format_tree(spark.createDataFrame([(*x, 9, "n", 1) for x in rows], CHAT).repartition(3))
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in chat.read_back(packed, convs).collect()}
    assert got == plain_conversations(rows)
    # the long first turn that two conversations share stands there once
    assert packed.where("depth = 0 and length(form) > 100000").count() == 1


def test_no_conversations(spark):
    packed, convs = chat.format_tree(spark.createDataFrame([], CHAT))
    assert packed.count() == 0 and convs.count() == 0 and chat.read_back(packed, convs).count() == 0
