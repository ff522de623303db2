"""Embedding near-dedup with hierarchical navigable small-world graphs.

Equal vectors are one class from there on, so a vector that a third of all rows share is searched once. Classes are dealt to
shards by a hash of the id; each shard builds its own graph: a base layer of all vectors and sparser layers above, each node
linked to diverse near neighbours, and bridges to nodes that no path leads to. Every shard is queried: for shards s <= t the vectors of s search the graph of t, which meets every
pair of shards once.

The beam of such a search is audited first: one query in AUDIT (five, if these have fewer than TRUE links) is compared with brute force,
and the beam is doubled until recall passes. Then all vectors search, in blocks. A query whose beam is full of hits goes on with one four
times as wide; when a widened beam would visit as many nodes as the shard has, the shard is scanned for that query, so dense groups of any size are found
whole. A shard of up to 8 * LINKS vectors is one layer, which is searched whole. Hits are verified by cosine in double precision.

A task returns for each vector its number of links and its root in the task's own spanning forest, so a dense group of thousands
costs a row for each member and not for each pair. Links are added up and the forests joined by connected components.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Vectors of different lengths never link.
Rows without an id are returned unlinked, with a null component, and kept. Repeated rows are separate vectors. An empty table gives an empty
result. Vectors of any length are compared; equally near nodes are taken in the order of the shard. Only the two named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import connected_components, materialise

LINKS, BEAM, BLOCK, AUDIT, TRUE, RECALL = 16, 48, 512, 50, 200, 0.99
#: Similarities that a task holds at a time; classes so common that each has one in FEW of all rows are few enough to be broadcast.
HELD, FEW = 1 << 22, 10_000
#: Starting nodes that a layer gives to the one below; links that each node should have to itself, and room for more of them.
ENTRIES, ENTERED, BRIDGES = 8, 4, 8
_SLACK, WIDTH = 1e-4, 2 * LINKS + BRIDGES


def unit(raw: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1, as doubles and as floats."""
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x, x.astype(np.float32)


def diverse(gram: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Which candidates to link, each row's sorted by falling `near`: one that is nearer to a taken one than to the node is passed over."""
    rows, width = near.shape
    keep = np.zeros((rows, width), dtype=bool)
    for c in range(width):
        shade = np.where(keep[:, :c], gram[:, c, :c], -2.0).max(axis=1) if c else np.full(rows, -2.0)
        keep[:, c] = (near[:, c] > -2) & (shade <= near[:, c]) & (keep.sum(axis=1) < most)
    return keep


class Layer:
    """A graph over the given vectors; links holds 2 * LINKS neighbours each and a bridge, -1 for none."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.links = np.full((len(x), WIDTH), -1, dtype=np.int32)

    def search(self, q: np.ndarray, entry: np.ndarray, beam: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam's nodes and similarities for each query, nearest first; entry: (queries, some) starting nodes, -1 for none."""
        n = len(q)
        seen = np.zeros((n, size), dtype=bool)
        found = np.full((n, beam), -1, dtype=np.int64)
        sims = np.full((n, beam), -2.0, dtype=np.float32)
        done = np.ones((n, beam), dtype=bool)
        k = min(entry.shape[1], beam)
        e = entry[:, :k]
        ok = e >= 0
        s = np.where(ok, np.einsum("nd,nkd->nk", q, self.x[np.maximum(e, 0)]), -2.0)
        order = np.argsort(-s, axis=1)
        found[:, :k], sims[:, :k] = np.take_along_axis(e, order, 1), np.take_along_axis(s, order, 1)
        done[:, :k] = found[:, :k] < 0
        r, c = np.nonzero(ok)
        seen[r, e[r, c]] = True
        live = np.arange(n)
        while len(live):
            open_ = ~done[live]
            any_open = open_.any(axis=1)
            live, open_ = live[any_open], open_[any_open]
            if not len(live):
                break
            first = open_.argmax(axis=1)
            open_[np.arange(len(live)), first] = False
            more = open_.any(axis=1)
            second = np.where(more, open_.argmax(axis=1), first)
            done[live, first] = True
            done[live, second] = True
            parts = []
            for near in (self.links[found[live, first]], np.where(more[:, None], self.links[found[live, second]], -1)):
                ok = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
                r, c = np.nonzero(ok)
                seen[live[r], near[r, c]] = True  # so that the second node's links pass over the first's
                parts.append((near, ok))
            at, ok = np.maximum(np.concatenate([p[0] for p in parts], axis=1), 0), np.concatenate([p[1] for p in parts], axis=1)
            r, c = np.nonzero(ok)
            s = np.full(ok.shape, -2.0, dtype=np.float32)
            s[r, c] = np.einsum("kd,kd->k", q[live[r]], self.x[at[r, c]])
            all_s = np.concatenate([sims[live], s], axis=1)
            top = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
            all_f = np.concatenate([found[live], at], axis=1)
            all_d = np.concatenate([done[live], s <= -2], axis=1)
            sims[live], found[live], done[live] = (np.take_along_axis(a, top, 1) for a in (all_s, all_f, all_d))
        found[sims <= -2] = -1
        return found, sims

    def link(self, new: np.ndarray, near: np.ndarray, sims: np.ndarray) -> None:
        """Link new nodes to diverse ones of their candidates, and those back."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, :BEAM]
        near, sims = np.take_along_axis(near, order, 1), np.take_along_axis(sims, order, 1)
        v = self.x[np.maximum(near, 0)]
        keep = diverse(v @ v.transpose(0, 2, 1), sims, LINKS)
        lone = np.cumsum(~keep & (sims > -2), axis=1) + keep.sum(axis=1, keepdims=True) <= LINKS // 2  # few are diverse inside a dense group: the nearest as well
        keep |= lone & (sims > -2)
        r, c = np.nonzero(keep)
        place = np.cumsum(keep, axis=1)[r, c] - 1
        self.links[new[r], place] = near[r, c]
        # back links: those that fit are added, full nodes choose again
        to, back = near[r, c], new[r]
        o = np.argsort(to, kind="stable")
        to, back = to[o], back[o]
        nodes, start, count = np.unique(to, return_index=True, return_counts=True)
        have = (self.links[nodes] >= 0).sum(axis=1)
        fits = have + count <= 2 * LINKS
        rank = np.arange(len(to)) - np.repeat(start, count)
        easy = np.repeat(fits, count)
        self.links[to[easy], (np.repeat(have, count) + rank)[easy]] = back[easy]
        if not fits.all():
            mine = np.repeat(~fits, count)
            self.choose_again(nodes[~fits], to[mine], back[mine])

    def choose_again(self, full: np.ndarray, to: np.ndarray, back: np.ndarray) -> None:
        """Give full nodes diverse links among those they have and the new ones (to, back); places left go to the nearest."""
        r, c = np.nonzero(self.links[full] >= 0)
        owner, other = np.concatenate([r, np.searchsorted(full, to)]), np.concatenate([self.links[full[r], c], back])
        s = np.einsum("kd,kd->k", self.x[full[owner]], self.x[other])
        order = np.lexsort((other, -s, owner))
        owner, other, s = owner[order], other[order], s[order]
        _, start, count = np.unique(owner, return_index=True, return_counts=True)
        rank = np.arange(len(owner)) - np.repeat(start, count)
        ok = rank < 6 * LINKS
        near, at = np.full((len(full), 6 * LINKS), -2, dtype=np.float32), np.zeros((len(full), 6 * LINKS), dtype=np.int64)
        near[owner[ok], rank[ok]], at[owner[ok], rank[ok]] = s[ok], other[ok]
        for k in range(0, len(full), 256):
            v, sims = self.x[at[k : k + 256]], near[k : k + 256]
            keep = diverse(v @ v.transpose(0, 2, 1), sims, 2 * LINKS)
            spare = ~keep & (sims > -2)
            keep |= spare & (np.cumsum(spare, axis=1) + keep.sum(axis=1, keepdims=True) <= 2 * LINKS)
            r, c = np.nonzero(keep)
            self.links[full[k : k + 256]] = -1
            self.links[full[k + r], (np.cumsum(keep, axis=1) - 1)[r, c]] = at[k + r, c]

    def build(self, entries) -> None:
        """Insert all vectors in batches, each as large as what is there; entries(queries) gives starting nodes."""
        n, size = len(self.x), 0
        while size < n:
            new = np.arange(size, min(n, max(2 * size, 128), size + 2 * BLOCK))
            q = self.x[new]
            own = q @ q.T
            np.fill_diagonal(own, -2.0)
            own[np.triu_indices(len(new))] = -2.0  # earlier ones alone: links back make the rest
            k = min(BEAM, len(new))
            near = np.argpartition(-own, k - 1, axis=1)[:, :k]
            sims = np.take_along_axis(own, near, 1)
            near = np.where(sims > -2, new[near], -1)
            if size:
                start = entries(q)
                start = np.where(start < size, start, -1)  # nodes of the layer above may still be missing here
                start[(start < 0).all(axis=1), 0] = 0
                f, s = self.search(q, start, BEAM, size)
                near, sims = np.concatenate([near, f], axis=1), np.concatenate([sims, s], axis=1)
            self.link(new, near, sims)
            size += len(new)
        self.bridge()

    def bridge(self) -> None:
        """Lead to every node: nodes with few links to them get some back from their own nearest links, while those have room, and one that still
        no path leads to gets the last place of the nearest reachable node where that is free."""
        entered = np.bincount(self.links[self.links >= 0], minlength=len(self.x))
        few = np.flatnonzero(entered < ENTERED)
        u, v = np.repeat(few, ENTERED), self.links[few, :ENTERED].ravel()
        ok = v >= 0
        ok[ok] = ~(self.links[v[ok]] == u[ok, None]).any(axis=1)
        u, v = u[ok], v[ok]
        order = np.argsort(v, kind="stable")
        u, v = u[order], v[order]
        _, start, count = np.unique(v, return_index=True, return_counts=True)
        rank = np.arange(len(v)) - np.repeat(start, count)
        fits = rank < BRIDGES - 1
        self.links[v[fits], 2 * LINKS + rank[fits]] = u[fits]
        seen = np.zeros(len(self.x), dtype=bool)
        seen[:1] = True
        fresh, free = np.flatnonzero(seen), np.ones(len(self.x), dtype=bool)
        while True:
            while len(fresh):
                to = np.unique(self.links[fresh])
                fresh = to[(to >= 0) & ~seen[to]]
                seen[fresh] = True
            lost = np.flatnonzero(~seen)
            if not len(lost):
                return
            ends = np.flatnonzero(seen & free)
            v = ends[(self.x[ends] @ self.x[lost[0]]).argmax()]
            self.links[v, WIDTH - 1], free[v], seen[lost[0]], fresh = lost[0], False, True, lost[:1]


class Graph:
    """Layers over vectors ordered by falling level; the top layer is searched whole."""

    def __init__(self, x: np.ndarray, sizes: list[int], links: list[np.ndarray] | None = None):
        self.layers = [Layer(x[:n]) for n in sizes]  # from the base up
        if links is not None:
            for layer, have in zip(self.layers, links, strict=True):
                layer.links = have
        else:
            for i in reversed(range(len(sizes))):
                self.layers[i].build(lambda q, i=i: self.entries(q, i))

    @staticmethod
    def sizes(n: int) -> list[int]:
        """Each layer has one in LINKS nodes of the one below."""
        out = [n]
        while out[-1] > 8 * LINKS:
            out.append(math.ceil(out[-1] / LINKS))
        return out

    def entries(self, q: np.ndarray, to: int) -> np.ndarray:
        top = len(self.layers) - 1
        if to == top:
            return np.zeros((len(q), 1), dtype=np.int64)
        at = np.argsort(-(q @ self.layers[top].x.T), axis=1)[:, :ENTRIES]
        for i in range(top - 1, to, -1):
            at = self.layers[i].search(q, at, 4 * ENTRIES, len(self.layers[i].x))[0][:, :ENTRIES]
        return at

    def scan(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sims = q @ self.layers[0].x.T
        return np.broadcast_to(np.arange(sims.shape[1]), sims.shape), sims

    def near(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.layers) == 1:
            return self.scan(q)
        return self.layers[0].search(q, self.entries(q, 0), beam, len(self.layers[0].x))


def hits(graph: Graph, q: np.ndarray, least: float, beam: int):
    """Chunks of (query, node) of all found with similarity of at least `least`; beams full of hits are widened."""
    n = len(graph.layers[0].x)
    left, whole = np.arange(len(q)), len(graph.layers) == 1
    while len(left):
        full = np.zeros(len(left), dtype=bool)
        step = max(1, HELD // n)
        for k in range(0, len(left), step):
            some = left[k : k + step]
            found, sims = graph.scan(q[some]) if whole else graph.near(q[some], beam)
            over = np.zeros(len(some), dtype=bool) if whole else (sims >= least).sum(axis=1) > 0.7 * beam
            full[k : k + step] = over
            r, c = np.nonzero((sims >= least) & ~over[:, None])
            yield some[r], found[r, c]
        left, beam = left[full], beam * 4
        whole = whole or 2 * LINKS * beam >= n


def audited(graph: Graph, q: np.ndarray, least: float, beam: int) -> tuple[int, int, int]:
    """The beam, doubled until the recall of sampled queries passes; the links that the sample has, and those found."""
    n = len(graph.layers[0].x)
    for step in (AUDIT, AUDIT // 5):
        sample = q[::step]
        true = sum(int((sample[k : k + 256] @ graph.layers[0].x.T >= least).sum()) for k in range(0, len(sample), 256))
        if true >= TRUE:
            break
    while True:
        got = sum(len(a) for a, _ in hits(graph, sample, least, beam))
        if got >= RECALL * true or len(graph.layers) == 1 or 2 * LINKS * beam >= 4 * n:
            return beam, true, got
        beam *= 2


def join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of linked nodes; root points to smaller nodes and is flattened at the end."""
    while True:
        while (root[root] != root).any():
            root[:] = root[root]
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
        np.minimum.at(root, high, low)
        a, b = a[apart], b[apart]


def _packed(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, raw): the vector's bytes, null if it can't link."""
    kind = "<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"

    @pandas_udf("binary")
    def run(vectors: pd.Series) -> pd.Series:
        out = []
        for v in vectors:
            x = None if v is None else np.asarray(v, dtype=kind)
            out.append(x.tobytes() if x is not None and len(x) and np.isfinite(x).all() and np.linalg.norm(x.astype(float)) > 0 else None)
        return pd.Series(out)

    raw = F.col(vector) if kind == "<f4" else F.col(vector).cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("id"), run(raw).alias("raw"))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", least: float = 0.9, shard_rows: int = 100_000, shards: int = 4, beam: int = BEAM) -> DataFrame:
    """One row per row of df: id, n_links, component_id, kept.

    The number of shards is `shards`, or more so that none has over shard_rows classes on average.
    """
    kind = "<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"
    rows = materialise(_packed(df, id_col, vector), "vectors")
    classes = materialise(rows.where("id is not null and raw is not null").groupBy("raw").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "classes")
    # ids are unique names of classes unless rows repeat an id with other vectors: those share links
    sizes = {r.n: r.c for r in classes.groupBy(F.octet_length("raw").alias("n")).agg(F.count("*").alias("c")).collect()}  # a row for each vector length
    count = {n: max(shards if c > 1000 else 1, math.ceil(c / shard_rows)) for n, c in sizes.items()}
    if not count:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    per = F.create_map(*[F.lit(x) for kv in count.items() for x in kv])
    n = F.octet_length("raw")
    dealt = classes.withColumn("many", per[n]).withColumn("shard", F.pmod(F.xxhash64("id"), F.col("many")).cast("int"))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.iloc[np.argsort(pd.util.hash_array(part["id"].to_numpy()), kind="stable")].reset_index(drop=True)  # levels by a hash
        x = unit(part["raw"].tolist(), kind)[1]
        g = Graph(x, Graph.sizes(len(x)))
        part["place"] = np.arange(len(part))
        part["links"] = [b"".join(layer.links[i].tobytes() for layer in g.layers if i < len(layer.x)) for i in range(len(part))]
        return part[["size", "many", "shard", "place", "id", "copies", "raw", "links"]]

    graphs = dealt.select(n.alias("size"), "many", "shard", "id", "copies", "raw").groupBy("size", "shard").applyInPandas(build, "size int, many int, shard int, place int, id long, copies long, raw binary, links binary")
    graphs = materialise(graphs, "graphs")
    asked = graphs.select("size", F.col("shard").alias("s"), F.explode(F.sequence(F.col("shard"), F.col("many") - 1)).alias("t"), "id", "copies", "raw")
    held = graphs.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("shard")))).withColumn("t", F.col("shard")).select("size", "s", "t", "place", "id", "copies", "raw", "links")

    def search(key, ask: pd.DataFrame, hold: pd.DataFrame) -> pd.DataFrame:
        same = key[1] == key[2]
        if ask.empty or hold.empty:
            return pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
        hold = hold.sort_values("place", kind="stable").reset_index(drop=True)
        exact, x = unit(hold["raw"].tolist(), kind)
        sizes = Graph.sizes(len(x))
        width = 4 * WIDTH
        links = [np.frombuffer(b"".join(b[i * width : (i + 1) * width] for b in hold["links"][:m]), dtype=np.int32).reshape(m, -1) for i, m in enumerate(sizes)]
        g = Graph(x, sizes, links)
        if same:
            ask = hold
            q_exact, q = exact, x
        else:
            ask = ask.sort_values("id", kind="stable").reset_index(drop=True)
            q_exact, q = unit(ask["raw"].tolist(), kind)
        base = 0 if same else len(hold)
        names = hold["id"].to_numpy() if same else np.concatenate([hold["id"].to_numpy(), ask["id"].to_numpy()])
        copies, asked_copies = hold["copies"].to_numpy(), ask["copies"].to_numpy()
        count, root = np.zeros(len(names), dtype=np.int64), np.arange(len(names))
        wide, _, _ = audited(g, q, least - _SLACK, beam)
        for at in range(0, len(q), BLOCK):
            for a, b in hits(g, q[at : at + BLOCK], least - _SLACK, wide):
                a = a + at
                if same:
                    a, b = a[a != b], b[a != b]
                ok = np.concatenate([np.einsum("kd,kd->k", q_exact[a[k : k + 100_000]], exact[b[k : k + 100_000]]) >= least for k in range(0, len(a), 100_000)] or [np.zeros(0, dtype=bool)])
                a, b = a[ok], b[ok]
                np.add.at(count, base + a, copies[b])
                if not same:
                    np.add.at(count, b, asked_copies[a])
                join_roots(root, base + a, b)
        linked = count > 0
        return pd.DataFrame({"id": names[linked], "links": count[linked], "root": names[root[linked]]})

    found = asked.groupBy("size", "s", "t").cogroup(held.groupBy("size", "s", "t")).applyInPandas(search, "id long, links long, root long")
    found = materialise(found, "found")
    comps = materialise(connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))), "components")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    merged = classes.where("copies > 1").join(links, "id", "full_outer").select("id", F.coalesce("links", F.lit(0)).alias("links")).join(comps, "id", "left")
    named = materialise(classes.join(merged, "id").select(F.col("raw").alias("_raw"), "copies", (F.col("links") + F.col("copies") - 1).alias("_links"), F.coalesce("component", "id").alias("_component")), "named")
    long = max(1000, rows.count() // FEW)
    own = (F.col("raw") == F.col("_raw")) & F.col("id").isNotNull()
    common = rows.join(F.broadcast(named.where(F.col("copies") > long).drop("copies")), own, "left")  # at most FEW classes
    other = common.where("_raw is null").select(rows.columns).join(named.where(F.col("copies") <= long).drop("copies"), own, "left")
    joined = common.where("_raw is not null").unionByName(other)
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.col("_component"), F.col("id")))
    return joined.select(F.col("id").alias(id_col), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


VECTORS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
n AS (SELECT vec_id, x, SQRT(LIST_INNER_PRODUCT(x, x)) AS len FROM v WHERE x IS NOT NULL AND LIST_INNER_PRODUCT(x, x) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND LIST_INNER_PRODUCT(a.x, b.x) / (a.len * b.len) >= 0.9),
c AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a),
m AS (SELECT a AS vec_id, MIN(b) AS component_id FROM c GROUP BY a),
k AS (SELECT a AS vec_id, COUNT(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, COALESCE(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM m LEFT JOIN k USING (vec_id)
"""
