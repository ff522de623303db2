"""MinHash near-dedup by a signature-coordinate inverted join.

Every document's set of word shingles is reduced to COORDS minima. Documents with equal sets are one class from there on. Two
classes are candidates when at least MATCHES of their coordinate-value pairs collide; candidates are confirmed on the full shingle sets. A
pair of classes at the threshold collides less often about once in a million times.

First pass, for the bulk of the links. Classes are posted under the pairs of their first FIRST coordinates (two classes at the threshold
share none of them once in 17 million times). Collisions are counted once, in the first short list that two classes share,
and each class verifies its four best partners. Lists longer than LIST are refined by the values of the next two coordinates; those that
are still longer are dealt into blocks of LIST by a hash, differently under each coordinate, with their first class in each block.

Second pass, for all others: prefix and skip merging. Only classes that share a first-pass list with another component take part, and only
lists that hold several components count. A class with fewer than MATCHES such lists has no partner left. The others skip
their MATCHES - 1 longest lists and are posted under the rest alone: two classes with MATCHES common lists still meet in one of these. A
passage that many documents share fills long lists, so these are skipped while it makes up less than MATCHES of COORDS (56 %) of
the classes that share it. Beyond, the classes of long lists are posted anew, under their rarest shingles (those of one
component first, then by the number of classes that hold them): of n shingles, the first n - ceil(0.75 n) + 1. Two sets at the threshold share their first common shingle early
in both, so a passage brings classes together only where it makes up so much of both that they are near-duplicates anyway. In lists that are
long even so, classes outside the largest component meet the list's members in a grid of bounded cells.

Pairs inside a component cannot change the result, so groups of thousands cost a few links for each member. Long lists, of which there
can only be a bounded number, are looked up in a broadcast table, so that no task holds one whole.

Null ids are never linked and kept, with a null component. Null and blank texts have no shingles and link with nothing. Rows with the
same id are one document. Texts of fewer words than a shingle are one shingle; long ones are hashed in blocks. Equally good partners:
the smaller id is taken. An empty table gives an empty result. Of docs, only the two named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window as W

from .common import connected_components, materialise

COORDS, FIRST, MATCHES, LIST = 128, 12, 72, 96
#: Long lists among so many posts that each has a part of one in FEW of them: the rows that are broadcast.
FEW = 100_000
_RNG = np.random.default_rng(20240607)
_A, _B = (_RNG.integers(1, 1 << 32, COORDS, dtype=np.uint64).astype(np.uint32) | np.uint32(1) for _ in range(2))
_P = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Remembers words' hashes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) < 40:
            self[word] = h
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int, words: _Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of `size` words."""
    found = (text or "").encode("utf-8", "replace").lower().split()  # bytes.lower() changes A-Z alone
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    k = min(size, len(h))
    n = len(h) - k + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = _mix(out * _P + h[i : i + n])
    return np.unique(out + np.uint64(k))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each coordinate."""
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(COORDS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(hashes), 2048):
        a, b = low[at : at + 2048], high[at : at + 2048]
        np.minimum(out, (a[None, :] * _A[:, None] + b[None, :] * _B[:, None]).min(axis=1), out=out)
    return out


def signatures(docs: DataFrame, id_col: str, text: str, size: int) -> DataFrame:
    """(doc, n, key, full, sig): set size, digest of the set, the coordinates, and a byte of each coordinate."""

    @pandas_udf("n long, key binary, full array<int>, sig binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        words, rows = _Words(), []
        for t in texts:
            s = shingles(t, size, words)
            if not len(s):
                rows.append((0, None, None, None))
                continue
            m = sketch(s)
            rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), m.view(np.int32), (m >> np.uint32(24) ^ m & np.uint32(255)).astype(np.uint8).tobytes()))
        return pd.DataFrame(rows, columns=["n", "key", "full", "sig"])

    return docs.select(F.col(id_col).alias("doc"), run(F.col(text).cast("string")).alias("s")).select("doc", "s.*")


def _in_lists(posts: DataFrame, lists: DataFrame, keys: list[str], total: int) -> DataFrame:
    """posts joined with their lists (keys, many, ...). Of `total` posts, at most FEW lists can be long: these are broadcast."""
    long = max(LIST, total // FEW)
    marked = posts.join(F.broadcast(lists.where(F.col("many") > long)), keys, "left")
    rest = marked.where("many is null").select(posts.columns).join(lists.where(F.col("many") <= long), keys)
    return marked.where("many is not null").unionByName(rest)


def _postings(classes: DataFrame, total: int) -> DataFrame:
    """(at, value, many, doc, n, post, short, sig): classes under each coordinate-value pair that at least two share; short: a bit for each short list."""
    posts = classes.select("doc", F.posexplode(F.slice("full", 1, FIRST)).alias("at", "value"))
    shared = materialise(posts.groupBy("at", "value").agg(F.count("*").alias("many")).where("many > 1"), "shared")
    posted = materialise(_in_lists(posts, shared, ["at", "value"], FIRST * total), "posted")
    short = posted.groupBy("doc").agg(F.bit_or(F.when(F.col("many") <= LIST, F.expr("shiftleft(1, at)")).otherwise(0)).alias("short"))
    own = classes.join(short, "doc").select("doc", "n", F.slice("full", 1, FIRST + 2).alias("post"), "short", "sig")
    return posted.join(own, "doc")


def _lists(near: DataFrame, total: int) -> DataFrame:
    """(list, at, doc, n, post, short, sig): posting lists of two to LIST + 1 classes each; at is null in blocks of long ones."""
    rest = ["doc", "n", "post", "short", "sig"]
    none = F.lit(None).cast("int").alias("at")
    whole = near.where(F.col("many") <= LIST).select(F.xxhash64("at", "value").alias("list"), "at", *rest)
    finer = near.where(F.col("many") > LIST).withColumn("finer", F.xxhash64("at", "value", F.element_at("post", F.col("at") + 2), F.element_at("post", F.col("at") + 3)))
    sizes = materialise(finer.groupBy("finer").agg(F.count("*").alias("many"), F.min("doc").alias("first")).where("many > 1"), "finer")
    long = _in_lists(finer.drop("many"), sizes, ["finer"], FIRST * total).withColumn("blocks", F.ceil(F.col("many") / LIST).cast("int"))
    block = F.pmod(F.xxhash64("doc", "at"), F.col("blocks")).cast("int")
    own = long.select(F.xxhash64("finer", block).alias("list"), none, *rest)
    ties = long.where((F.col("doc") == F.col("first")) & (F.col("blocks") > 1)).select("finer", *rest, block.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
    ties = ties.where("b <> own").select(F.xxhash64("finer", "b").alias("list"), none, *rest)
    return whole.unionByName(own).unionByName(ties)


def _prefixes(classes: DataFrame, near: DataFrame, comps: DataFrame) -> DataFrame:
    """(list, doc, n, comp, sig, before): classes that may have a partner in another component, under the lists that they don't skip.

    before: the lists of the class that come before this one, in the order of all lists (length, coordinate, value).
    """
    comp = F.coalesce("component", "doc").alias("comp")
    named = comps.withColumnRenamed("id", "doc")
    seen = materialise(near.select("at", "value", "doc").join(named, "doc", "left").select("at", "value", "doc", comp), "seen")
    several = lambda posts, *keys: posts.groupBy(*keys).agg(F.count("*").alias("many"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").drop("lo", "hi")
    mixed = materialise(several(seen, "at", "value"), "mixed")
    doc = _in_lists(seen.select("at", "value", "doc"), mixed, ["at", "value"], seen.count()).select("doc").distinct()
    active = materialise(classes.join(doc, "doc").join(named, "doc", "left").select("doc", "n", comp, "full", "sig"), "active")
    posts = active.select("doc", "comp", F.posexplode("full").alias("at", "value"))
    lists = materialise(several(posts, "at", "value"), "mixed")
    own = _in_lists(posts.drop("comp"), lists, ["at", "value"], COORDS * active.count()).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("many", "at", "value"))).alias("all"))
    own = own.where(F.size("all") >= MATCHES).select("doc", F.transform(F.expr(f"slice(all, 1, size(all) - {MATCHES - 1})"), lambda x: F.xxhash64(x["at"], x["value"])).alias("lists"))
    posted = own.join(active.drop("full"), "doc").select("doc", "n", "comp", "sig", "lists", F.posexplode("lists").alias("rank", "list"))
    posted = materialise(posted.select("list", "doc", "n", "comp", "sig", F.expr("slice(lists, 1, rank)").alias("before")), "prefixes")
    return _in_lists(posted, materialise(several(posted, "list"), "mixed"), ["list"], posted.count())


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """(doc, hashes): the shingle hashes of each candidate, 32 bits each, sorted and distinct."""

    @pandas_udf("binary")
    def run(t: pd.Series) -> pd.Series:
        words = _Words()
        return pd.Series([np.unique(shingles(x, size, words).astype(np.uint32)).tobytes() for x in t])

    return texts.select("doc", run("text").alias("hashes"))


def _whole_lists(done):
    """A function of Arrow batches, sorted by list, that calls done with tables of whole lists."""

    def run(batches):
        held = None
        for x in batches:
            t = pa.Table.from_batches([x]) if held is None else pa.concat_tables([held, pa.Table.from_batches([x])])
            lists_ = t.column("list").to_numpy()
            last = int(np.searchsorted(lists_, lists_[-1])) if len(lists_) else 0
            held = t.slice(last).combine_chunks()
            if last:
                yield from done(t.slice(0, last))
        if held is not None and held.num_rows:
            yield from done(held)

    return run


def _rare(who: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(list, many, doc, n, comp, sig, before, pos): the classes `who` under their rarest shingles, in lists of several components.

    pos: the shingle's place in the class's order. Shingles of one component come first and are posted nowhere; the others follow by number of classes,
    equals by hash. The commonest, of which there are FEW at most, are known to every task, so they are counted and placed where the text is read. Lists in
    which no class is early enough to meet one of its own size or more are left out. before is empty: pairs that share several lists are found in each.
    """
    own = texts.join(who.select("doc", "comp", "n"), "doc")

    @pandas_udf("array<long>")
    def every(t: pd.Series) -> pd.Series:
        words = _Words()
        return pd.Series([shingles(x, size, words).view(np.int64) for x in t], dtype=object)

    posts = own.select("comp", F.explode(every("text")).alias("list"))
    shared = posts.groupBy("list").agg(F.count("*").alias("many"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("list", "many")
    shared = materialise(shared, "shared")
    long = max(LIST, who.agg(F.sum("n")).first()[0] // FEW)
    common = sorted((r.many, r.list) for r in shared.where(F.col("many") > long).collect())  # FEW rows at most
    known = np.array([x for _, x in common], dtype=np.int64)
    by_hash = np.argsort(known)
    first = lambda n: n - -(-percent * n // 100) + 1  # noqa: E731  shingles of the prefix

    @pandas_udf("rest array<long>, held array<long>")
    def split(t: pd.Series, n: pd.Series) -> pd.DataFrame:
        words, rows = _Words(), []
        for x, many in zip(t, n, strict=True):
            s = shingles(x, size, words).view(np.int64)
            at = np.searchsorted(known[by_hash], s)
            hit = known[by_hash][np.minimum(at, len(known) - 1)] == s if len(known) else np.zeros(len(s), dtype=bool)
            rest = s[~hit]
            rows.append((rest, known[np.sort(by_hash[at[hit]])][: max(0, first(int(many)) - len(rest))]))
        return pd.DataFrame(rows, columns=["rest", "held"])

    read = own.select("doc", split("text", "n").alias("s"))
    early = F.greatest(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.col("start"), F.lit(0)).cast("int")
    of = read.select("doc", F.size("s.rest").alias("others"), F.explode("s.rest").alias("list")).join(shared.where(F.col("many") <= long), "list")
    of = of.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("many", "list"))).alias("all"), (F.max("others") - F.count("*")).alias("start"))
    of = of.join(who, "doc").select("doc", "n", "comp", "sig", "start", F.posexplode(F.slice(F.transform("all", lambda x: x["list"]), F.lit(1), early)).alias("i", "list"))
    top = read.select("doc", F.size("s.rest").alias("start"), F.posexplode("s.held").alias("i", "list")).join(who, "doc").select("doc", "n", "comp", "sig", "start", "i", "list")
    placed = of.unionByName(top).select("list", "doc", "n", "comp", "sig", F.array().cast("array<long>").alias("before"), (F.col("start") + F.col("i")).cast("long").alias("pos"))
    placed = materialise(placed, "placed")
    open_ = F.col("pos") + F.ceil(2 * percent * F.col("n") / (100 + percent)) <= F.col("n")
    several = placed.groupBy("list").agg(F.count("*").alias("many"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(open_).alias("open")).where("lo < hi and open")
    return _in_lists(placed, materialise(several.select("list", "many"), "mixed"), ["list"], placed.count())


def _grid(hot: DataFrame) -> DataFrame:
    """(list, doc, n, comp, stray, pos, sig, role): each long list as a grid of bounded cells.

    In its cells every class outside the list's largest component (a guest, role 0) meets every class of the list (role 1).
    """
    by_comp = hot.groupBy("list", "comp").agg(F.count("*").alias("rows"))
    side = 4 * LIST
    main = by_comp.groupBy("list").agg(F.max_by("comp", F.struct("rows", "comp")).alias("main"), F.sum("rows").alias("many"), F.max("rows").alias("most")).where(F.col("many") > F.col("most"))
    main = materialise(main.select("list", "many", "main", F.ceil(F.col("many") / side).cast("int").alias("blocks"), F.ceil((F.col("many") - F.col("most")) / side).cast("int").alias("chunks")), "grid")
    placed = _in_lists(hot.drop("many"), main, ["list"], hot.count()).withColumn("stray", F.col("comp") != F.col("main"))
    b, c = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("doc", F.lit(1)), F.col("chunks")).cast("int")
    cols = [F.xxhash64("list", "b", "c").alias("list"), "doc", "n", "comp", "stray", "pos", "sig"]
    members = placed.withColumn("b", b).withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*cols, F.lit(1).alias("role"))
    guests = placed.where("stray").withColumn("c", c).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*cols, F.lit(0).alias("role"))
    return members.unionByName(guests)


class _Before:
    """The lists before each row's own, as sets made when asked for."""

    def __init__(self, column):
        self.column, self.sets = column, {}

    def apart(self, x: int, y: int) -> bool:
        """Whether two rows of a list share no list before it."""
        for i in (x, y):
            if i not in self.sets:
                self.sets[i] = frozenset(self.column[i].as_py())
        return self.sets[x].isdisjoint(self.sets[y])


def _met(t: pa.Table, percent: int):
    """(x, ys) for each guest x of the cells: the rows of other components that pass the place, size and match tests.

    Two guests are handled from the smaller one's side. Sets at the threshold have `least` shingles in common, so the list of their first common
    one is that early in both.
    """
    lists_, doc, n, comp, role, pos = (t.column(k).to_numpy() for k in ("list", "doc", "n", "comp", "role", "pos"))
    stray = t.column("stray").to_numpy(zero_copy_only=False)
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), dtype=np.uint8).reshape(-1, COORDS)
    for start, end in zip(s := np.flatnonzero(np.r_[True, lists_[1:] != lists_[:-1]]), np.r_[s[1:], len(lists_)], strict=True):
        first = start + int((role[start:end] == 0).sum())
        m = np.arange(first, end)
        for x in range(start, first):
            k = m[(comp[m] != comp[x]) & (~stray[m] | (doc[m] > doc[x])) & (100 * np.minimum(n[m], n[x]) >= percent * np.maximum(n[m], n[x]))]
            least = -(-percent * (n[k] + n[x]) // (100 + percent))
            k = k[(pos[k] + least <= n[k]) & (pos[x] + least <= n[x])]
            k = k[(sig[k] == sig[x]).sum(axis=1) >= MATCHES] if len(k) else k
            if len(k):
                yield x, k


def _named(hot: DataFrame, percent: int) -> DataFrame:
    """(doc): the classes of long lists with a partner in another component by match count. All classes meet; sets are not read."""

    def done(t):
        doc = t.column("doc").to_numpy()
        rows = [np.r_[x, k] for x, k in _met(t, percent)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(doc[np.concatenate(rows)]))], names=["doc"])

    cells = _grid(hot).repartition("list").sortWithinPartitions("list", "role")
    return cells.mapInArrow(_whole_lists(done), "doc long").distinct()


def _strays(hot: DataFrame, named: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): for named classes outside a long list's largest component, their best partner in each other component.

    Compared by match count and then by shingle sets within the task, so no pair that fails leaves it.
    """
    sets = materialise(_sets(texts.join(named, "doc", "left_semi"), size), "sets")
    asked = materialise(hot.join(named, "doc", "left_semi"), "asked")  # read several times
    cells = _grid(asked).join(sets, "doc").repartition("list").sortWithinPartitions("list", "role")

    def done(t):
        doc, comp = t.column("doc").to_numpy(), t.column("comp").to_numpy()
        hashes = [np.frombuffer(h, dtype=np.uint32) for h in t.column("hashes").to_pylist()]
        found = []
        for x, k in _met(t, percent):
            best: dict[int, tuple[float, int]] = {}
            for y in k:
                both = len(np.intersect1d(hashes[x], hashes[y], assume_unique=True))
                share = both / max(1, len(hashes[x]) + len(hashes[y]) - both)
                if 100 * share >= percent - 0.5:
                    best[comp[y]] = max(best.get(comp[y], (0.0, 0)), (share, int(doc[y])))
            found.extend((min(int(doc[x]), y), max(int(doc[x]), y)) for _, y in best.values())
        if found:
            a, d = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(d, pa.int64())], names=["a", "b"])

    return cells.mapInArrow(_whole_lists(done), "a long, b long").distinct()


def _within(doc, n, sig, starts, ends, percent: int, first) -> np.ndarray:
    """Pairs of rows of the same list that pass the size test, `first` (a function of both) and the match test, and their collisions."""
    sizes, found = ends - starts, [np.zeros((3, 0), dtype=np.int64)]
    for s in np.unique(sizes[sizes > 1]):
        at = starts[sizes == s]
        i, j = np.triu_indices(int(s), 1)
        step = max(1, 200_000 // len(i))
        for k in range(0, len(at), step):
            left, right = ((at[k : k + step, None] + x[None, :]).ravel() for x in (i, j))
            ok = (doc[left] != doc[right]) & (100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right]))
            ok[ok] = first(left[ok], right[ok])
            left, right = left[ok], right[ok]
            matches = np.concatenate([(sig[left[m : m + 50_000]] == sig[right[m : m + 50_000]]).sum(axis=1) for m in range(0, len(left), 50_000)] or [np.zeros(0, dtype=np.int64)])
            ok = matches >= MATCHES
            found.append(np.stack([left[ok], right[ok], matches[ok]]))
    return np.concatenate(found, axis=1)


def _listed(t: pa.Table):
    """doc, n, sig and the bounds of the lists."""
    lists_ = t.column("list").to_numpy()
    starts = np.flatnonzero(np.r_[True, lists_[1:] != lists_[:-1]])
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), dtype=np.uint8).reshape(-1, COORDS)
    return t.column("doc").to_numpy(), t.column("n").to_numpy(), sig, starts, np.r_[starts[1:], len(lists_)]


def _best_pairs(lists: DataFrame, most: int, percent: int) -> DataFrame:
    """(a, b) with a < b: for each class its `most` best partners in the first pass's lists."""

    def done(t):
        doc, n, sig, starts, ends = _listed(t)
        post = np.array(t.column("post").to_pylist(), dtype=np.int32)[:, :FIRST]
        at = t.column("at").fill_null(-1).to_numpy()
        short = (t.column("short").to_numpy()[:, None] >> np.arange(FIRST)) & 1 == 1

        def first(x, y):  # whether this is the first short list of both; blocks count all their pairs
            same = (post[x] == post[y]) & short[x]
            return (at[x] < 0) | (same.argmax(axis=1) == at[x])

        left, right, matches = _within(doc, n, sig, starts, ends, percent, first)
        rows, mates, m = np.concatenate([left, right]), np.concatenate([right, left]), np.concatenate([matches, matches])
        order = np.lexsort((doc[mates], -m, rows))
        rows, mates, m = rows[order], mates[order], m[order]
        start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]][: len(rows)])
        rank = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
        ok = rank < most
        if ok.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[rows[ok]]), pa.array(doc[mates[ok]]), pa.array(m[ok])], names=["a", "b", "matches"])

    found = lists.repartition("list").sortWithinPartitions("list").mapInArrow(_whole_lists(done), "a long, b long, matches long")
    found = found.distinct().withColumn("rank", F.row_number().over(W.partitionBy("a").orderBy(F.desc("matches"), "b"))).where(F.col("rank") <= most)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rest_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b) with a < b: all pairs of different components in the second pass's short lists, each in its first list alone."""

    def done(t):
        doc, n, sig, starts, ends = _listed(t)
        comp, before = t.column("comp").to_numpy(), _Before(t.column("before"))
        left, right, _ = _within(doc, n, sig, starts, ends, percent, lambda x, y: comp[x] != comp[y])
        ok = [before.apart(x, y) for x, y in zip(left.tolist(), right.tolist(), strict=True)]
        if any(ok):
            a, b = doc[left[ok]], doc[right[ok]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return lists.repartition("list").sortWithinPartitions("list").mapInArrow(_whole_lists(done), "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int, batch: int = 200) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the percentage. A document that many pairs name first is dealt out in parts."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / batch).cast("int").alias("parts"))
    mates = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.col("b").alias("doc"), F.lit(1).alias("role"))
    firsts = many.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("doc"), F.lit(0).alias("role"))
    rows = firsts.unionByName(mates).join(texts, "doc").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def run(batches):
        words, now, first = _Words(), None, None
        for b in batches:
            found = []
            for a, part, doc, role, t in zip(*(b.column(c).to_pylist() for c in ("a", "part", "doc", "role", "text")), strict=True):
                s = shingles(t, size, words)
                if role == 0:
                    now, first = (a, part), s
                elif now == (a, part):
                    both = len(np.intersect1d(first, s, assume_unique=True))
                    if both and 100 * both >= percent * (len(first) + len(s) - both):
                        found.append((a, doc))
            if found:
                a, d = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(d, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, kept (the component's smallest id)."""
    work = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text).cast("string").alias("text"))
    signed = materialise(signatures(work, id_col, "text", size), "signatures")
    classes = signed.where("n > 0 and doc is not null").groupBy("key").agg(
        F.min("doc").alias("doc"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("full").alias("full"), F.first("sig").alias("sig")
    )
    classes = materialise(classes, "classes")
    source = work.select(F.col(id_col).alias("doc"), "text")
    fetch = lambda named: materialise(source.join(named, "doc").dropDuplicates(["doc", "text"]), "texts")
    either = lambda pairs: pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()

    total = classes.count()
    near = materialise(_postings(classes, total), "postings")
    pairs = materialise(_best_pairs(_lists(near, total), 4, percent), "pairs")
    texts = fetch(either(pairs).hint("merge"))  # the same join whatever the size
    links = materialise(_confirmed(pairs, texts, size, percent), "links")
    comps = materialise(connected_components(links), "components")

    rest = materialise(_prefixes(classes, near, comps), "lists")
    more = _rest_pairs(rest.where(F.col("many") <= LIST), percent)
    hot = materialise(rest.where(F.col("many") > LIST).select("doc", "n", "comp", "sig").dropDuplicates(["doc"]), "hot")
    if not hot.isEmpty():
        held = fetch(hot.select("doc"))
        rare = materialise(_rare(hot, held, size, percent), "rare")
        more = more.unionByName(_rest_pairs(rare.where(F.col("many") <= LIST), percent))
        long = materialise(rare.where(F.col("many") > LIST).drop("before"), "long")
        if not long.isEmpty():
            more = more.unionByName(_strays(long, materialise(_named(long, percent), "named"), held, size, percent))
        texts = texts.unionByName(held.join(texts.select("doc"), "doc", "left_anti"))
    more = materialise(more.distinct(), "pairs")
    new = materialise(either(more).join(texts.select("doc"), "doc", "left_anti"), "new")
    if not new.isEmpty():
        texts = texts.unionByName(fetch(new))
    found = materialise(_confirmed(more, texts, size, percent), "links")
    if not found.isEmpty():
        comps = materialise(connected_components(links.unionByName(found)), "components")

    moved = classes.join(comps.withColumnRenamed("id", "doc"), "doc", "left").where("copies > 1 or component is not null")
    moved = moved.select(F.col("key").alias("_key"), F.coalesce("component", "doc").alias("_component"))
    one = F.coalesce(F.col("_component"), F.col("doc"))
    return signed.join(moved, F.col("key") == F.col("_key"), "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), one).alias("component_id"),
        F.coalesce(F.col("doc") == one, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """docs without the documents that another of their component stands for."""
    out = near_duplicates(docs, id_col, text, size, percent).where(~F.col("kept")).select(F.col(id_col).alias("_out")).distinct()
    return docs.join(out, docs[id_col] == F.col("_out"), "left_anti")


NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, REGEXP_EXTRACT_ALL(TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, UNNEST(CASE WHEN words IS NULL OR LEN(words) = 0 THEN [] WHEN LEN(words) < 5 THEN [ARRAY_TO_STRING(words, ' ')]
  ELSE LIST_TRANSFORM(RANGE(1, LEN(words) - 3), LAMBDA i: ARRAY_TO_STRING(words[i:i+4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * p.both >= 75 * (x.n + y.n - p.both)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, MIN(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
