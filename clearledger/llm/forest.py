"""Nearest neighbours by a hash-prefix forest: TREES sorted arrays of BITS-bit hash strings, searched by longest common prefixes.

A hash string is the signs of projections on random directions, each cut at the median of a bounded sample. In each tree, the vectors whose hash
strings begin like a query's lie side by side. A query descends in all trees to its longest match and then ascends in all of them at once, one bit
at a time, until the ranges hold `width` entries; what they hold is compared by exact cosine in double precision. Each shard audits a sample of
its queries against a scan and widens until the recall passes; a width that reaches the shard's size is a scan, so an audit can't end unpassed.

Equal vectors are one class, which keeps its k + 1 smallest ids: no other id of the class can be among k nearest. Classes are dealt to shards of
shard_rows, queries to blocks of block_rows, and a task holds one shard and one block, so rows per task are bounded; a query's nearest of
all shards are merged by a ranking that is cut before its shuffle. Every shard is asked for every query: tasks grow with queries times rows.

Rows: null and zero vectors, vectors with null or non-finite components, and null ids take no part. Vectors of other lengths have no cosine
and are not compared. An id that several vectors share is an entry for each, and a query of that id is not answered by them, so it may get
fewer answers. Equal rows count once. Fewer candidates than k are all returned. Empty tables have no rows in the result. Further columns don't matter, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialise
from .vectors import _packed as packed

TREES, BITS, SAMPLE, AUDITED = 32, 64, 2000, 64
_BATCH = 256


def unit32(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def directions(sample: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(directions, cuts) of all trees' bits for unit vectors like the sample's."""
    d = np.random.default_rng(seed).standard_normal((sample.shape[1], TREES * BITS)).astype(np.float32)
    return d, np.median(sample @ d, axis=0)


def hash_strings(x: np.ndarray, planes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """(TREES, rows) hash strings as numbers, first bit highest."""
    out = np.empty((TREES, len(x)), dtype=np.uint64)
    for at in range(0, len(x), 10_000):
        bits = x[at : at + 10_000] @ planes[0] > planes[1]
        out[:, at : at + 10_000] = np.packbits(bits.reshape(-1, TREES, BITS), axis=2).view(">u8")[:, :, 0].T
    return out


class Forest:
    """Sorted hash strings of each tree, and the place of each entry's vector."""

    def __init__(self, keys: np.ndarray):
        self.place = np.argsort(keys, axis=1, kind="stable").astype(np.int32)
        self.keys = np.take_along_axis(keys, self.place, axis=1)

    def ranges(self, tree: int, key: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the entries whose first `length` bits are the key's."""
        rest = np.where(length > 0, (np.uint64(1) << (BITS - np.maximum(length, 1)).astype(np.uint64)) - np.uint64(1), np.uint64(2**64 - 1))
        return np.searchsorted(self.keys[tree], key & ~rest), np.searchsorted(self.keys[tree], key | rest, side="right")

    def longest(self, tree: int, key: np.ndarray) -> np.ndarray:
        """Bits of the longest common prefix of each key with any entry: one of its two neighbours has it."""
        held, at = self.keys[tree], np.searchsorted(self.keys[tree], key)
        near = np.minimum(held[np.minimum(at, len(held) - 1)] ^ key, held[np.maximum(at - 1, 0)] ^ key)
        high, low = (near >> np.uint64(32)).astype(float), (near & np.uint64(0xFFFFFFFF)).astype(float)
        return BITS - np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])

    def candidates(self, keys: np.ndarray, width: int) -> list[np.ndarray]:
        """Places found for each query (a column of keys): its ranges at the greatest common length at which they hold `width` entries together."""
        many = keys.shape[1]
        length = np.max([self.longest(t, keys[t]) for t in range(TREES)], axis=0)
        open_ = np.arange(many)
        while len(open_):  # all trees ascend together
            held = sum(np.subtract(*self.ranges(t, keys[t, open_], length[open_])[::-1]) for t in range(TREES))
            open_ = open_[(held < width) & (length[open_] > 0)]
            length[open_] -= 1
        bounds = [self.ranges(t, keys[t], length) for t in range(TREES)]
        out, seen = [], np.zeros(self.place.shape[1], dtype=bool)
        for q in range(many):
            for t in range(TREES):
                seen[self.place[t, bounds[t][0][q] : bounds[t][1][q]]] = True
            out.append(np.flatnonzero(seen))
            seen[out[-1]] = False
        return out


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the columns, summed in the order of the components."""
    total = np.zeros(x.shape[1])
    for component in x:
        total += component * component
    return np.sqrt(total)


def best(q: np.ndarray, q_norm: float, x: np.ndarray, x_norm: np.ndarray, ids: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(score, place) of the k + 1 best of the places (columns of x), nearest first and ties to smaller ids."""
    dot = np.zeros(len(places))
    for value, component in zip(q, x, strict=True):
        dot += value * component[places]
    score = dot / (q_norm * x_norm[places])
    order = np.lexsort((ids[places], -score))[: k + 1]
    return score[order], places[order]


def search_shard(hold: tuple[np.ndarray, np.ndarray], ask: np.ndarray, planes: tuple[np.ndarray, np.ndarray], k: int, width: int, recall: float) -> tuple[list[tuple[np.ndarray, np.ndarray]], int, float]:
    """((score, place) lists of each query, the width taken, its recall on the audited queries). hold: vectors and first ids."""
    x, ids = hold
    forest, keys, n = Forest(hash_strings(unit32(x), planes)), hash_strings(unit32(ask), planes), len(x)
    x, x_norm, a_norm = np.ascontiguousarray(x.T), norms(x.T), norms(ask.T)
    find = lambda qs, w: [best(ask[q], a_norm[q], x, x_norm, ids, c, k) for q, c in zip(qs, forest.candidates(keys[:, qs], w), strict=True)]
    sample = np.unique(np.linspace(0, len(ask) - 1, min(AUDITED, len(ask))).astype(int))
    truth = [best(ask[q], a_norm[q], x, x_norm, ids, np.arange(n), k)[1] for q in sample]
    while True:
        got = [p for _, p in find(sample, width)]
        found = sum(len(np.intersect1d(a, b)) for a, b in zip(got, truth, strict=True)) / max(1, sum(map(len, truth)))
        if found >= recall or width >= TREES * n:
            break
        width *= 2
    return [r for at in range(0, len(ask), _BATCH) for r in find(np.arange(at, min(at + _BATCH, len(ask))), width)], width, found


def nearest(queries: DataFrame, df: DataFrame, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", width: int = 16_000, recall: float = 0.97, shard_rows: int = 100_000, block_rows: int = 20_000, shards: int = 4) -> tuple[DataFrame, DataFrame]:
    """(query_id, rank, vec_id, score) of the k rows of df nearest to each query, and (shard, block, width, recall) of all audits.

    queries and df have vectors of the same type. A row of df with the query's id is no answer to it. width counts entries of all TREES trees,
    so a vector that every tree finds counts TREES times.
    """
    good = "id is not null and raw is not null"
    rows, asking = (materialise(packed(x, id_col, vector).where(good), "vectors") for x in (df, queries))
    kind, size = ("<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"), F.octet_length("raw").alias("size")
    held = rows.select("raw", "id").distinct().withColumn("_rk", F.row_number().over(W.partitionBy("raw").orderBy("id"))).where(F.col("_rk") <= k + 1)  # cut before its shuffle
    classes = materialise(held.groupBy("raw").agg(F.array_sort(F.collect_list("id")).alias("ids")), "classes")
    wanted = materialise(asking.select("raw").distinct(), "wanted")
    sizes = {r["size"]: r["count"] for r in classes.groupBy(size).count().collect()}  # a row for each vector length
    asks = {r["size"]: r["count"] for r in wanted.groupBy(size).count().collect()}
    step = np.dtype(kind).itemsize
    planes = {}
    for n in asks:  # at most SAMPLE vectors of each length, by a hash, fit the cuts
        some = classes.where(F.octet_length("raw") == n).orderBy(F.xxhash64("raw"), "raw").limit(SAMPLE).select("raw").collect()
        planes[n] = np.frombuffer(b"".join(r.raw for r in some), dtype=kind).reshape(-1, n // step)
    per = lambda count, each, least: F.create_map(*[F.lit(v) for n, c in count.items() for v in (n, max(least if c > 1000 else 1, math.ceil(c / each)))])[F.octet_length("raw")]
    if not asks:
        nothing = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        return nothing, df.sparkSession.createDataFrame([], "shard int, block int, width long, recall double")
    blocks, many = per(asks, block_rows, 1), per(sizes, shard_rows, shards)
    hold = classes.where(F.octet_length("raw").isin(*asks)).select(size, F.pmod(F.xxhash64("raw"), many).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "ids", "raw")
    ask = wanted.select(size, F.explode(F.sequence(F.lit(0), many - 1)).alias("shard"), F.pmod(F.xxhash64("raw", F.lit(1)), blocks).cast("int").alias("block"), "raw")

    def search(key, q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        columns = ["shard", "block", "raw", "ids", "score", "width", "recall"]
        if q.empty or x.empty:
            return pd.DataFrame({c: [] for c in columns})
        q, x = q.sort_values("raw").reset_index(drop=True), x.sort_values("raw").reset_index(drop=True)
        read = lambda raw: np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
        vectors, first = read(x["raw"]), np.array([i[0] for i in x["ids"]])
        found, wide, measured = search_shard((vectors, first), read(q["raw"]), directions(unit32(planes[key[0]].astype(np.float64))), k, width, recall)
        return pd.DataFrame([(key[1], key[2], q["raw"][j], x["ids"][p], s, wide, measured) for j, (scores, places) in enumerate(found) for s, p in zip(scores, places, strict=True)], columns=columns)

    found = ask.groupBy("size", "shard", "block").cogroup(hold.groupBy("size", "shard", "block")).applyInPandas(search, "shard int, block int, raw binary, ids array<long>, score double, width long, recall double")
    found = materialise(found, "found")
    audits = found.groupBy("shard", "block").agg(F.max("width").alias("width"), F.min("recall").alias("recall"))
    order = W.partitionBy("raw").orderBy(F.desc("score"), "id")
    near = found.select("raw", "score", F.explode("ids").alias("id")).withColumn("_rk", F.row_number().over(order)).where(F.col("_rk") <= k + 1)  # with the query's own
    lists = near.groupBy("raw").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "id"))).alias("near"))
    queries = asking.select(F.col("id").alias("query_id"), "raw").distinct().join(lists, "raw")
    own = queries.select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("rank", "one"))
    return own.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("one.id").alias("vec_id"), (-F.col("one.far")).alias("score")), audits


FOREST_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
n AS (SELECT vec_id, x, SQRT(LIST_INNER_PRODUCT(x, x)) AS len FROM v WHERE x IS NOT NULL AND LIST_INNER_PRODUCT(x, x) > 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, LIST_INNER_PRODUCT(a.x, b.x) / (a.len * b.len) AS score FROM n a JOIN n b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(ROW_NUMBER() OVER w AS INTEGER) AS rank, vec_id, score FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""
