"""Manifest, spelling variants and nearest neighbours against brute force on small and awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearledger.llm import forest, merkle, spelling

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, digest string, leaf string, pos long, n long, word string"
ROWS = [(1, "The Quick BROWN fox", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (3, "", None, None), (4, "Über ÀÉ", "", "b"), (5, "X" * 300_000, "de", "b"), (None, "ABC", "en", None), (None, None, None, None)] + [(10 + i, f"Row {i}", "en", "a") for i in range(80)] + [(7, "Same ROW", "en", "c")] * 20


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "t", "d", "l", 5, 6, "w") for r in ROWS], DOCS).repartition(3)


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def framed(x) -> str:
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def lower(x):
    return None if x is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and of each node what stands left and right of it on the way up."""
    ways, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 8, len(nodes))) for a in range(0, len(nodes), 8)]
        for run in runs:
            for i in run:
                for m in members[i]:
                    ways[m].append(("".join(nodes[j] for j in run if j < i), "".join(nodes[j] for j in run if j > i)))
        nodes, members = [sha("".join(nodes[i] for i in run)) for run in runs], [[m for i in run for m in members[i]] for run in runs]
    return nodes[0], ways


def plain_manifest(rows: list[tuple]) -> Counter:
    leaf = lambda r, text: sha("".join(map(framed, (r[0], r[3], r[2], None if r[1] is None else len(r[1]), text))))
    trees = defaultdict(list)
    for r in rows:
        trees[(r[2] is not None, (r[2] or "").encode())].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(trees)
    built = [climb([x[2] for x in sorted(trees[k], key=lambda x: x[:3])]) for k in names]
    root, tops = climb([b[0] for b in built])
    out = Counter()
    for k, (subroot, ways), top in zip(names, built, tops, strict=True):
        for (_, _, own, r), way in zip(sorted(trees[k], key=lambda x: x[:3]), ways, strict=True):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            at = leaf(r, lower(r[1])) if hit else own
            for left, right in way + top:
                at = sha(left + at + right)
            out[(r[0], own, subroot, root, sha("".join(a + b for a, b in way + top)), at, at == root)] += 1
    return out


def test_manifest_is_the_plain_one(spark, docs):
    done = merkle.audit(docs)
    assert done.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = Counter(tuple(r) for r in done.collect())
    assert got == plain_manifest(ROWS) and {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("rows", [1, 7, 8, 9, 64, 65])
def test_manifest_of_one_tree(spark, rows):
    given = [(i, f"T{i}", "en", "s") for i in range(rows)]
    df = spark.createDataFrame([(*r, len(r[1])) for r in given], "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(tuple(r) for r in merkle.audit(df).collect()) == plain_manifest(given)


def test_manifest_of_nothing(docs):
    assert merkle.audit(docs.limit(0)).collect() == []


def test_some_leaves_are_requested(spark):
    leaves = spark.createDataFrame([(t, i, sha(f"{t}{i}")) for t in "ab" for i in range(70)], "tree string, k long, digest string")
    placed = merkle.materialise(merkle.ranked(leaves, ["k"]), "placed")
    held = merkle.build(placed)
    roots = held.roots.select("tree", "digest", "depth", F.struct("digest").alias("carry"), F.array().cast(merkle.PATH).alias("path"))
    found = merkle.descend(held, roots, placed.where("k in (0, 13, 69)").withColumn("want", F.struct("tree", "k"))).withColumn("up", merkle.fold_up(F.col("digest"), F.col("path"))).collect()
    assert sorted((r.want.tree, r.want.k) for r in found) == [(t, k) for t in "ab" for k in (0, 13, 69)]
    assert all(r.up == r.carry.digest and r.digest == sha(f"{r.want.tree}{r.want.k}") and len(r.path) == 3 for r in found)


# ---- spelling

LETTERS = "abcdeéß"


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.fixture(scope="module")
def word_list():
    rng = random.Random(3)
    base = ["".join(rng.choices(LETTERS, k=rng.randint(7, 11))) for _ in range(120)]
    for w in list(base):
        for _ in range(3):
            i = rng.randrange(len(w))
            base += [w[:i] + rng.choice(LETTERS) + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + rng.choice(LETTERS) + w[i:]]
    return sorted({*base, *["aaaaaaa" + x for x in ("", "a", "aa", "b", "ab", "ba", "é")], "a" * 3000, "a" * 3000 + "b"})


@pytest.mark.parametrize("hot", [1000, 2])
def test_pairs_are_all_one_edit_apart(spark, word_list, hot):
    want = {(min(a, b), max(a, b)) for i, a in enumerate(word_list) for b in word_list[:i] if abs(len(a) - len(b)) < 2 and one_edit(a, b)}
    got = [(r.a, r.b) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in word_list], "word string"), hot).collect()]
    assert len(want) > 300 and len(got) == len(set(got)) and {(min(p), max(p)) for p in got} == want


def test_posts_are_dealt_out_once(spark, word_list):
    """Words of one length meet in one exchange of two narrow columns, which both sides of the join read, and nothing is dealt out for the hot ones."""
    words = spark.createDataFrame([(w,) for w in word_list], "word string")
    ranks = spelling.letter_ranks(words)
    for choices, most in zip(spelling.ROUNDS, (1, 2), strict=True):
        met = spelling._met(words, ranks, choices, 1000)
        met.collect()
        plan = met._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len(re.findall(r"[+:]- Exchange hashpartitioning\(key", plan)) == plan.count("- Exchange hashpartitioning") == most, plan
    assert sorted(c for r in spelling.ROUNDS for c in r) == sorted(spelling._CHOICES)


def test_equal_parts_give_equal_signatures():
    ranks = {ord(c): i for i, c in enumerate("etaoin")}
    with np.errstate(over="ignore"):
        a, b, c, d = spelling.signatures(["notable", "notible", "notables", "elbaton"], ranks)
    kinds = np.array([k for k, _ in spelling._CHOICES])
    assert (a == b)[kinds == 0].any() and (a == d)[kinds == 0].all() and not (a == c)[kinds == 0].any()
    assert any(x in set(c[kinds == 1]) for x in a[kinds == 2])


def test_variants_of_given_texts(spark):
    text = lambda n, w: " ".join([w] * n)
    rows = [(1, text(300, "Therefore")), (1, text(30, "THEREFOR")), (1, text(3, "therefox") + " " + text(3, "therefix")), (2, None), (3, ""), (4, "short " * 9), (5, text(2, "Ñandúes÷")), (None, text(2, "reading")), (6, text(40, "wondering") + " once_another")] * 2
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, word string, n long, form string")
    got = {r.word: r for r in spelling.variants(docs).collect()}
    lost = {}
    want = Counter()
    for i, t in rows:
        for w in (lower(t) or "").replace("_", " ").split():
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            w = w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w
            lost[w] = h % 31 == 0
            want[w] += len(w) >= 7
    want = {w: n for w, n in want.items() if n >= 2}
    assert {w: r.n for w, r in got.items()} == want and "ÑandÚes÷".replace("Ú", "ú") in got
    near = {w: [v for v in want if one_edit(v, w)] for w in want}
    for w, r in got.items():
        top = min(near[w], key=lambda v: (-want[v], v), default=None)
        form = top if top and want[top] >= 10 * want[w] else None
        assert (r.form, r.form_n, r.n_near) == (form, want.get(form), len(near[w]))
        assert r.root == (got[form].root if form else w)
    assert got["therefox"].form == "therefor" and got["therefor"].form == "therefore" and got["therefox"].root == "therefore"


def test_variants_of_nothing(spark):
    schema = "doc_id long, text string"
    assert spelling.variants(spark.createDataFrame([], schema)).collect() == []
    alone = spelling.variants(spark.createDataFrame([(1, "absolutely absolutely"), (2, "\x00 12")], schema)).collect()
    assert [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in alone] == [("absolutely", None, "absolutely", 2, 0, None)]


# ---- nearest neighbours

VECTORS = "vec_id long, embedding array<float>, label int, raw binary, id long, score double"


def scan(rows, k=5, every=50):
    held = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, q in held:
        if i % every == 0:
            near = sorted({(-float(q @ x / np.linalg.norm(q) / np.linalg.norm(x)), j) for j, x in held if j != i and len(x) == len(q)})
            out[i] = near[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, b"r", 9, 0.5) for i, v in rows], VECTORS)


def test_nearest_of_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    vec = lambda n=8: [float(x) for x in rng.standard_normal(n)]
    same = vec()
    rows = [(i, vec()) for i in range(1, 160)] + [(i, same) for i in range(200, 460)] + [(500, None), (550, [0.0] * 8), (600, [float("nan")] * 8), (650, [1.0, None]), (None, same), (700, []), (750, vec(3)), (800, vec(3)), (801, vec(3)), (850, [1.0])]
    df = table(spark, rows + rows[200:210])
    found, audits = forest.nearest(df.where("vec_id % 50 = 0"), df, shards=3)
    got = found.orderBy("query_id", "rank").collect()
    want = scan(rows)
    assert {r.query_id for r in got} == {i for i, near in want.items() if near} and 850 not in {r.query_id for r in got}
    for i, near in want.items():
        mine = [r for r in got if r.query_id == i]
        assert [r["rank"] for r in mine] == list(range(1, len(near) + 1))
        assert np.allclose([r.score for r in mine], [-s for s, _ in near], atol=1e-12)
    assert [r.vec_id for r in got if r.query_id == 250] == [200, 201, 202, 203, 204] and [r.vec_id for r in got if r.query_id == 200] == [201, 202, 203, 204, 205]
    assert audits.agg(F.min("recall")).first()[0] >= 0.97


def test_forest_finds_longest_prefixes():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 16)) + np.repeat(rng.standard_normal((30, 16)) * 3, 100, axis=0)
    planes = forest.directions(forest.unit32(x[:500]))
    keys = forest.hash_strings(forest.unit32(x), planes)
    held = forest.Forest(keys)
    text = lambda k: format(int(k), "064b")
    for q in (0, 700, 2999):
        key = keys[:, q] ^ np.uint64(1 << 40)
        for tree in (0, 9):
            def shared(a, b=text(key[tree])):
                return next((i for i in range(64) if text(a)[i] != b[i]), 64)
            assert held.longest(tree, key[tree : tree + 1])[0] == max(map(shared, keys[tree]))
    places = held.candidates(keys[:, :40], 640)
    assert all(q in p for q, p in enumerate(places)) and all(len(p) < 1500 for p in places)


def test_width_grows_until_the_audit_passes():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 32))
    planes = forest.directions(forest.unit32(x[:1000]))
    found, width, recall = forest.search_shard((x, np.arange(4000)), x[::50], planes, 5, 64, 0.97)
    truth = [np.lexsort((np.arange(4000), -(x @ q) / np.linalg.norm(x, axis=1)))[:6] for q in x[::50]]
    hits = sum(len(np.intersect1d(p, t)) for (_, p), t in zip(found, truth, strict=True))
    assert width > 64 and recall >= 0.97 and hits >= 0.93 * 6 * len(truth)


def test_nearest_of_nothing(spark):
    df = table(spark, [])
    assert forest.nearest(df, df)[0].collect() == []
    one = table(spark, [(0, [1.0, 2.0])])
    assert forest.nearest(one, one)[0].collect() == []
