"""Each operator against a brute-force version, a round trip or held-out accuracy, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clearledger.llm import chat, language, linededup, mixing, neardup, pieces, quality, toxicity, vectors, warc
from clearledger.llm.common import connected_components, labelled_sample, scratch
from clearledger.llm.queries import ORACLES, QUERIES

from ..conftest import as_sql_frame, same_rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, key string, size long, score double, component_id long"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "de", None), (5, LONG, "en", "b"), (5, LONG, "en", "b"), (None, "the quick brown fox jumps over", "fr", None),
    (6, LONG + " tail", "de", "b"), (7, "the quick brown fox jumps over the lazy dog again and again", "en", "c"), (8, "\x00 12 ::", "es", "a"), (9, "é", "fr", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and columns with clashing names."""
    return spark.createDataFrame([(*r, None, 1, "k", 2, 0.5, 3) for r in ROWS], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (6, 1, 0), (7, None, 1), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    same_rows(as_sql_frame(duck, QUERIES[name](spark, sf_dir)), duck.execute(ORACLES[name]).fetchdf())


def test_a_worker_keeps_no_parts_between_tasks(spark):
    """The digests are those of each text alone, over several batches, and the parts are let go when the task ends."""
    with open(MODEL, "rb") as f:
        model = f.read()
    texts = ["the quick brown fox", "", None, "jumps over the lazy dog"]
    got = pd.concat(pieces.digests(model).func(iter([pd.Series(texts[:2]), pd.Series(texts[2:])])), ignore_index=True)
    fresh = pieces.Pieces(model)
    assert got["ids_sha256"].tolist() == [hashlib.sha256(fresh.encode(t or "")).hexdigest() for t in texts]
    assert fresh.known and not pieces.pieces(model).known


# ---- archives

PAGES = "page_id long, url string, html string, payload string, digest string"


def test_archives_round_trip_and_reruns_agree(spark):
    page = "<p>" + "x" * 120
    rows = [(3, "http://a/ü b", page), (1, None, page), (2, "http://a\r\nX: y", "short"), (4, "u", "short"), (5, "u", None), (None, "u", page + "é"), (1, None, page), (600, "u", page)]
    df = spark.createDataFrame([(*r, "p", "d") for r in rows], PAGES)
    manifests = [warc.write(df, scratch(spark, "warc"), file_bytes=700) for _ in range(2)]
    sums = [sorted(r.sha256 for r in m.collect()) for m in manifests]
    assert sums[0] == sums[1] and len(sums[0]) > 1
    got = warc.read(manifests[0], payloads=True).collect()
    assert sorted((r.page_id or -1, r.record_type, r.refers_to or -1) for r in got) == sorted([(1, "response", -1), (1, "revisit", 1), (3, "revisit", 1), (600, "revisit", 1), (2, "response", -1), (4, "response", -1), (5, "response", -1), (-1, "response", -1)])
    assert {bytes(r.payload).decode() for r in got if r.record_type == "response"} == {page, "short", "", page + "é"}
    assert all(r.payload_digest == hashlib.sha256(bytes(r.payload)).hexdigest() for r in got if r.record_type == "response")


def test_archives_of_nothing(spark):
    assert warc.round_trip(spark, spark.createDataFrame([], PAGES), scratch(spark, "warc")).count() == 0


def test_archives_of_long_pages_and_many_without_ids(spark):
    rows = [(None, "u", f"page {i % 40} " + "y" * 100) for i in range(80)] + [(7, "u", "z" * 3_000_000), (8, "u", "z" * 3_000_000), (8, "u", "")]
    df = spark.createDataFrame([(*r, "p", "d") for r in rows], PAGES)
    manifest = warc.write(df, scratch(spark, "warc"), shard_bytes=4000, max_tasks=5)
    assert manifest.count() > 5
    got = warc.read(manifest, payloads=True).collect()
    assert len(got) == len(rows) and {r.payload_digest for r in got} == {hashlib.sha256(x[2].encode()).hexdigest() for x in rows}
    assert [(r.record_type, r.payload_bytes, r.refers_to) for r in got if r.page_id == 8 and r.payload_bytes] == [("revisit", 3_000_000, 7)]
    assert sum(r.record_type == "response" for r in got if r.page_id is None) == 40


def test_sample_is_bounded_where_ids_repeat(spark):
    docs = spark.createDataFrame([(i % 6, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)] * 3, "doc_id long, y int")
    got = [sorted(map(tuple, labelled_sample(docs.repartition(n), labels, "doc_id", "y", F.lit(True), 2).collect())) for n in (1, 7)]
    assert got[0] == got[1] and len(got[0]) == 4 and len({r[0] for r in got[0]}) == 4


def test_damaged_record_is_found():
    good = warc.record(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None, False, 0)
    assert warc.parse(good)["payload"] == b"hello"
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"hello", b"jello"))


# ---- quality

def brute_stats(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text or ""), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab#é \n\t|", max_size=60))
def test_statistics_match_brute_force(text):
    assert quality.text_stats(text)[:5] == brute_stats(text)


def test_decision_list_learns_and_explains():
    r = np.random.default_rng(1)
    x = {n: r.random(3000) for n in quality.FEATURES}
    bad = (x["symbol_share"] > 0.8) | ((x["upper_share"] > 0.7) & (x["repeat_share"] < 0.4))
    rules = quality.learn(x, bad, np.arange(3000) % 3 != 0)
    hit = np.zeros(3000, dtype=bool)
    for rule in rules:
        hit[rule.covers(x, np.arange(3000))] = True
    assert (hit == bad).mean() > 0.97 and all(" and " in str(k) or ">" in str(k) or "<=" in str(k) for k in rules)


def test_quality_on_odd_rows(odd, none, labels):
    got = quality.judge(odd, labels).collect()
    assert len(got) == len(ROWS) and all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    assert quality.judge(none, labels).count() == 0 and quality.judge(odd, labels.limit(0)).count() == len(ROWS)


def test_quality_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.judge(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed")
    assert got.where((F.col("kept").cast("int") == F.col("quality"))).count() >= 0.9 * got.count()


# ---- toxicity

def brute_segments(scores):
    """Best segment first, then the same to its left and right."""
    if not scores:
        return []
    sums = np.concatenate([[0], np.cumsum(scores)])
    best = max(((sums[j] - sums[i], -j, i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    s, j, i = best[0], -best[1], best[2]
    return [*brute_segments(scores[:i]), (s, i, j), *[(a, b + j, c + j) for a, b, c in brute_segments(scores[j:])]]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-9, 9), max_size=14))
def test_segments_match_brute_force(values):
    scores = [v + 2.0 ** -(i + 1) for i, v in enumerate(values)]  # exact, and no two stretches have equal sums
    got = toxicity.segments(scores)
    assert [round(s, 6) for s, _, _ in got] == [round(s, 6) for s, _, _ in brute_segments(scores)]


def test_toxicity_on_odd_rows(odd, none, labels):
    got = toxicity.score(odd, labels, F.lit(True), per_class=50).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(none, labels, F.lit(True)).count() == 0
    assert {r.score for r in toxicity.score(odd, labels.limit(0), F.lit(True)).collect()} == {0.0}


def test_toxicity_finds_planted_words(spark):
    r = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bdf" for b in "aeiou" for c in "lmnr"]
    text = lambda bad: " ".join(r.choice(words) if not bad or i % 40 else f"grunz{r.choice('abc')}" for i in range(1, 200))
    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(240)]
    docs, labels = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"), spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    got = toxicity.score(docs, labels, F.col("doc_id") < 120).join(labels, "doc_id").where("doc_id >= 120").collect()
    assert sum((x.score >= 0.5) == (x.toxic == 1) for x in got) >= 0.97 * len(got)


# ---- lines

#: Lines that no other document has, not even with fields of its own.
OWN = ["the sun rose late that day", "nobody had asked for rain", "seven boats left before noon", "we never found the key"]


def test_templates_generalise_fields(spark):
    line = "report for station north was filed on day {} by {} and closed"
    rows = [(i, OWN[i] + "\n" + line.format(i, n)) for i, n in enumerate(["anna", "ben", "cleo", "dora"])]
    df = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id long, text string, dropped string")
    got = {r.doc_id: r for r in linededup.drop_recurring_lines(df, info="i", template_docs=3).collect()}
    assert got[0].text == rows[0][1] and all(got[i].text == rows[i][1].split("\n")[0] and got[i].i.n_dropped == 1 for i in (1, 2, 3)) and got[1].dropped == "kept"


def test_templates_generalise_neighbouring_and_short_fields(spark):
    names = [("jane", "doe"), ("max", "moor"), ("ann", "lee"), ("bo", "yu")]
    kept = ["this page was closed", "one and two"]  # too few equal tokens, and in two documents
    rows = [(i, "\n".join([OWN[i], f"this page was written by {a} {b} and closed", f"read more on {a} today", f"this page was {b}", *(kept if i < 2 else [])])) for i, (a, b) in enumerate(names)]
    got = {r.doc_id: r.text.split("\n") for r in linededup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), template_docs=3).collect()}
    assert got[0] == rows[0][1].split("\n")
    assert all(got[i] == [OWN[i], f"this page was {names[i][1]}", *(kept if i < 2 else [])] for i in (1, 2, 3))


def test_lines_that_state_different_things_stay(spark):
    """Four facts in one form are no boilerplate; a form that 40 documents fill in, and lines equal but for numbers, are."""
    facts = [f"in our long yearly atlas the capital city of {x} is the town of {y} today" for x, y in (("france", "paris"), ("spain", "madrid"), ("italy", "rome"), ("peru", "lima"))]
    form = [f"this page of the town paper was filed by {chr(97 + i % 26)}{chr(97 + i // 26)}name and closed for good" for i in range(40)]
    rows = [(i, f) for i, f in enumerate(facts)] + [(10 + i, f"{f}\nown words {chr(97 + i % 26)} {chr(97 + i // 26)} stay here") for i, f in enumerate(form)] + [(100 + i, f"printed on day {i} of the year") for i in range(3)]
    got = {r.doc_id: r for r in linededup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), info="i").collect()}
    assert [got[i].text for i in range(4)] == facts and got[10].text == rows[4][1]
    assert all(got[10 + i].text == rows[4 + i][1].split("\n")[1] and got[10 + i].i.n_alike == 1 for i in range(1, 40))
    assert got[100].text == rows[-3][1] and [(got[i].text, got[i].i.n_dropped, got[i].i.n_alike) for i in (101, 102)] == [("", 1, 0)] * 2


def test_query_drops_templates_of_few_documents(spark, tmp_path):
    """A template that three documents fill in goes in the query, its SQL and the pipeline but for one line; one of two documents stays."""
    from corpus_pipeline import line_stage

    line = "this page of the town paper was filed by {} and closed for good"
    rows = [(i, f"{OWN[i]}\n{line.format(n)}", "en", "a", 1) for i, n in enumerate(["anna", "ben", "cleo"])] + [(3 + i, f"in two documents only there is this line of {n} here") for i, n in enumerate(["anna", "ben"])]
    docs = spark.createDataFrame([(*r, "en", "a", 1)[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: t if i in (0, 3, 4) else OWN[i] for i, t, *_ in rows}
    got = {r.doc_id: (r.text, r.n_dropped) for r in QUERIES["op5_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {i: (t, int(i in (1, 2))) for i, t in want.items()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert {i: t for i, t in con.execute(f"SELECT doc_id, text FROM ({ORACLES['op5_line_dedup']})").fetchall()} == want
    assert {r.doc_id: r.text for r in line_stage(spark, docs, "").collect()} == want


def test_line_stage_keeps_documents_that_a_template_empties(spark):
    from corpus_pipeline import line_stage

    rows = [(i, f"this page of the town paper was filed by {chr(97 + i % 26)}{chr(97 + i // 26)}name and closed for good", "en", "a", 1) for i in range(40)] + [(50 + i, "the very same line in three", "en", "a", 1) for i in range(3)]
    out = {r.doc_id: r.text for r in line_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "").collect()}
    assert out == {i: t for i, t, *_ in rows[:41]}


def test_lines_on_odd_rows(odd, none):
    got = linededup.drop_recurring_lines(odd, info="i").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in ROWS) and linededup.drop_recurring_lines(none).count() == 0


# ---- language

def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language.identify(docs, F.col("doc_id") % 2 == 0).where("doc_id % 2 = 1 and n_chars > 50")
    assert got.where("_lid.lang_pred = lang").count() >= 0.95 * got.count()


def test_language_on_odd_rows(odd, none):
    got = {(r.doc_id, r.text): r._lid for r in language.identify(odd, F.lit(True)).collect()}
    assert {x.lang_pred for (i, _), x in got.items() if i in (2, 3, 4, 8)} == {"und"} and all(0 <= x.score <= 1 for x in got.values())
    assert language.identify(none, F.lit(True)).count() == 0


def test_long_texts_without_letters_are_und():
    p = language.Profile(256, 7)
    for text in ("\U0001f600\u3001\u3002 ", "\u3001"):
        assert not p.bundle([text * 70_000]).any()
    cjk = "\u6f22\u5b57\u3001\u4eee\u540d\u3002 \U0001f600abc "
    assert (p.symbols(cjk * 9_000) == np.tile(p.symbols(cjk), 9_000)).all() and np.allclose(p.bundle([cjk * 9_000]), p.bundle([cjk * 900]), atol=1e-3)


def brute_bundle(text, dim, seed):
    """The bundle of a text's n-grams, one by one."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    spaced = f" {' '.join(letters.split())} "
    vector = lambda c: np.random.default_rng([seed, 0 if c == " " else ord(c)]).choice(np.array([-1, 1]), size=dim)
    total = sum(np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c) for a, b, c in zip(spaced, spaced[1:], spaced[2:], strict=False))
    return total / np.linalg.norm(total)


def test_bundles_and_predictions_match_brute_force(spark):
    texts = {"en": "the cat sat on the mat, the hat", "ja": "\u6f22\u5b57\u3001\u4eee\u540d \u4eee\u540d\u3002", "zh": "\u4f60\u597d\u4e16\u754c\u4f60\u597d", "el": "\u03b1\u03b2\u03b3 \u03b1\u03b2"}
    p = language.Profile(256, 7)
    assert np.allclose(p.bundle(list(texts.values())), [brute_bundle(t, 256, 7) for t in texts.values()], atol=1e-5)
    asked = ["that cat", "\u4eee\u540d", "\u4f60\u597d!", "\u03b3 \u03b1\u03b2", "\U0001f600 12"]
    rows = [(i, t, lang) for i, (lang, t) in enumerate(texts.items())] + [(100 + i, t, None) for i, t in enumerate(asked)]
    got = {r.doc_id: r._lid for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), dim=256).collect()}
    protos = {lang: brute_bundle(t, 256, 7) for lang, t in texts.items()}
    for i, t in enumerate(asked[:-1]):
        cos = {lang: float(brute_bundle(t, 256, 7) @ v) for lang, v in protos.items()}
        best = max(cos, key=cos.get)
        assert got[100 + i].lang_pred == best and abs(got[100 + i].score - max(0.0, cos[best])) < 1e-5
    assert got[104].lang_pred == "und" and got[104].score == 0


def test_bundles_do_not_depend_on_limits(monkeypatch):
    texts = ["the cat sat on the mat", "\u6f22\u5b57 and \u4eee\u540d", "a" * 50]
    whole = language.Profile(256, 7).bundle(texts)
    monkeypatch.setattr(language, "KEPT_GRAMS", 5)
    monkeypatch.setattr(language, "KEPT_LETTERS", 3)
    p = language.Profile(256, 7)
    assert np.allclose(whole, p.bundle(texts), atol=1e-5) and np.allclose(whole, p.bundle(texts), atol=1e-5)


def test_bundles_do_not_depend_on_blocks(monkeypatch):
    p = language.Profile(256, 7)
    text = "abca bcab  ac, cab ab" * 3
    whole = p.bundle([text])[0]
    monkeypatch.setattr(language, "BLOCK", 7)
    assert np.allclose(whole, p.bundle([text])[0], atol=1e-6)


# ---- near-duplicates

def brute_components(rows, size=5, percent=75):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    ids = sorted(sets)
    root = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                for k in ids:
                    if root[k] == max(a, b):
                        root[k] = min(a, b)
    return {i: (len(sets[i]), root[i]) for i in ids}


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LIST", 8)  # so that lists are refined, dealt into blocks and met in grids
    r = random.Random(11)
    source = [f"w{r.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(260):
        w = list(source) if i % 3 else [f"z{r.randrange(5000)}" for _ in range(60)] + source[:40]
        for _ in range(r.randrange(0, 9) if i % 3 else r.randrange(0, 2)):
            w[r.randrange(len(w))] = f"e{i}_{r.randrange(99)}"
        rows.append((i, " ".join(w)))
    rows += [(300, "one two"), (301, "ONE two"), (302, "one two three"), (303, ""), (304, None)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("share", [62, 74, 78, 84, 88])
def test_near_duplicates_among_documents_that_are_mostly_one_passage(spark, monkeypatch, share):
    monkeypatch.setattr(neardup, "LIST", 8)
    r = random.Random(share)
    word = lambda: f"q{r.randrange(10**9)}"
    passage = [word() for _ in range(share)]
    rows = []
    for i in range(0, 240, 2):  # pairs differ in a word or two, and texts in length; the passage is about `share` percent of each
        own = [word() for _ in range(100 - share + i % 12)]
        rows += [(i, " ".join(passage + own)), (i + 1, " ".join(passage + own[:-2] + [word(), word()]))]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_in_long_lists_meet_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LIST", 8)
    r = random.Random(3)
    word = lambda: f"q{r.randrange(10**9)}"
    passage = [word() for _ in range(100)]
    rows = []
    for i in range(0, 700, 2):  # pairs at about 0.78; all others share the passage alone, at about 0.42
        own = [word() for _ in range(48)]
        rows += [(i + k, " ".join(passage + own + [word() for _ in range(20)])) for k in (0, 1)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_components(rows)
    assert got == want and sum(c == i for i, (_, c) in want.items()) == 350


def test_near_duplicates_on_odd_rows(odd, none):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == len(ROWS) and {r.component_id for r in got if r.doc_id in (1, 7)} == {1} and {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert all(r.kept and r.n_shingles == 0 and r.component_id == r.doc_id for r in got if r.doc_id in (2, 3, 4)) and all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert neardup.near_duplicates(none).count() == 0
    assert sorted(r.doc_id or 0 for r in neardup.one_of_each(odd).collect()) == [0, 1, 2, 3, 4, 5, 5, 8, 9]


def test_vectors_match_brute_force(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(60, 16))
    x = np.concatenate([centres[r.integers(0, 60, 8400)] + 0.25 * r.normal(size=(8400, 16)), np.tile(centres[:1], (150, 1))]).astype(np.float32)  # four shards of over 1,536
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9100, None), (9101, []), (9102, [0.0] * 16), (9103, [float("nan")] * 16), (9104, [1.0] * 5), (9105, [2.0] * 5), (None, x[0].tolist())]
    got = vectors.near_duplicates(spark.createDataFrame([(*v, 1, 2) for v in rows], "vec_id long, embedding array<float>, links int, id int"), beam=16).toPandas()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    by = got.dropna(subset=["vec_id"]).set_index("vec_id")
    assert by.loc[range(len(x)), "n_links"].sum() >= 0.99 * near.sum()
    odd = by.loc[[9100, 9101, 9102, 9103]]
    assert (odd["n_links"] == 0).all() and (odd["component_id"] == odd.index).all() and by.loc[9104, "n_links"] == 1 and by.loc[9105, "component_id"] == 9104
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_components_settle(spark):
    edges = [(i, i + 3) for i in range(90)] + [(500, 501)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(93)} == {0, 1, 2} and got[501] == 500


# ---- chat

@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\>im_endstart\nx ", max_size=40), st.text(max_size=8))
def test_turns_come_back(text, role):
    form, a, z = chat.format_turn(role, text)
    assert chat.parse_turn(form) == (role, text) and chat.unescape(form[a:z]) == text and form.count("<|") == 2


def test_tree_shares_and_attends(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (2, 2, "user", "why"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes"), (4, 0, None, None), (None, 0, "user", "hi")]
    packed, convs = chat.format_tree(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, start int"))
    p = sorted(packed.collect(), key=lambda r: r.start)
    assert len(p) == 5 and all(a.end == b.start for a, b in zip(p, p[1:], strict=False)) and p[0].start == 0
    hi = next(r for r in p if "hi" in r.form)
    for r in p:
        if r.depth:
            assert r.attends[0].start == hi.start and sum(x.end - x.start for x in r.attends) == r.position
    assert {r.conv_id: r.n_turns for r in chat.read_back(packed, convs).collect()} == {1: 2, 2: 3, 3: 2, 4: 1, None: 1}


# ---- mixing

def test_mix_on_odd_rows(odd, none):
    got = mixing.mix_plan(odd).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 2 * r["size"] and r.target <= 2 * r.source_size for r in got) and mixing.mix_plan(none).count() == 0
    assert mixing.mixed(odd).columns == odd.columns


def test_mix_is_near_its_targets_and_reruns_agree(spark):
    r = random.Random(2)
    docs = spark.createDataFrame([(i, "w " * r.randrange(1, 40), "hot" if i % 3 else f"s{i % 5}") for i in range(1500)], "doc_id long, text string, source string")
    a, b = mixing.mix_plan(docs).toPandas(), mixing.mix_plan(docs.repartition(7)).toPandas()
    same_rows(a, b)
    by = a.assign(source=a["doc_id"].map({x.doc_id: x.source for x in docs.collect()})).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by["taken"] - by["target"]).abs() <= 45).all()
    assert mixing.mixed(docs).count() == int((a["taken"] / a["size"]).sum())


def test_mix_of_tied_ids_is_repeatable(spark):
    rows = [(7, f"word{i % 20} more words", "en", "a", i) for i in range(41)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = [sorted(tuple(r) for r in mixing.mixed(docs.repartition(n, F.rand(n))).collect()) for n in (1, 3, 8)]
    assert taken[0] == taken[1] == taken[2] and len(taken[0]) in (61, 62)



# ---- tokens

TABLE = pieces.Pieces(pieces.read_model(MODEL))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(sorted(TABLE.ids)), st.sampled_from([" ", "  ", "\n", "▁", "�", "a" * 40])), max_size=8).map("".join))
def test_ids_and_text_match_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    packed = TABLE.encode(text)
    assert np.frombuffer(packed, dtype="<u4").tolist() == ids and TABLE.decode(packed) == LIBRARY.decode(ids)


def test_tokens_on_odd_rows(odd, none):
    got = {r.doc_id: r for r in pieces.token_digests(odd, MODEL).collect()}
    assert got[2].n_tokens == got[3].n_tokens == 2 and got[5].n_tokens == len(LIBRARY.encode(LONG)) + 2
    assert pieces.token_digests(none, MODEL).count() == 0 and "tokens" in pieces.encode_documents(odd, MODEL).columns


# ---- pipeline

def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, before, sf_dir).cache()
        assert after.columns == docs.columns and 0 < after.count()
        if name != "mixing sources to target weights":
            assert after.count() <= before.count() and after.select("doc_id").distinct().count() == after.count()
        before = after
    out = p.STAGES[-1][1](spark, before, sf_dir).toPandas()
    assert len(out) == before.count() and (out["n_tokens"] >= 2).all()
