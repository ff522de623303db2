"""Block-pair joins, graph orders and settled labels."""

from __future__ import annotations

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clearledger.config import Config
from clearledger.functions.pairs import blocked, pairs
from clearledger.operators import graph


def test_each_pair_is_made_once(spark):
    rows = [("hot", i, i * 2) for i in range(0, 600, 3)] + [("b", 5, 1), ("b", 2, 0), ("c", 9, 9), (None, 1, 1), (None, 2, 2)]
    df = spark.createDataFrame(rows, "k string, m long, x int").repartition(3)
    want = Counter((k, *sorted((a, b))) for k in ("hot", "b", "c") for a, b in itertools.combinations([(m, x) for q, m, x in rows if q == k], 2))
    for block in (7, 50, 1000):
        assert Counter((r.k, tuple(r.a), tuple(r.b)) for r in pairs(df, ["k"], "m", ["x"], block).collect()) == want


def test_a_member_of_very_many_is_spread_over_tasks(spark):
    """20,000 rows of one key: no pair of blocks has more than a few hundred on a side, and the pairs are all there."""
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("m"))
    left, right = blocked(df, ["k"], "m")
    for side in (left, right):
        sizes = side.groupBy("k", "_i", "_j").count().agg(F.max("count"), F.count("*")).first()
        assert sizes[0] < 700 and sizes[1] == 40 * 41 // 2
    sums = left.groupBy("_i", "_j").count().withColumnRenamed("count", "n").join(right.groupBy("_i", "_j").count(), ["_i", "_j"])
    assert sums.agg(F.sum(F.when(F.col("_i") == F.col("_j"), F.col("n") * (F.col("n") - 1) / 2).otherwise(F.col("n") * F.col("count")))).first()[0] == 20_000 * 19_999 // 2


def edges(spark, *rows):
    return spark.createDataFrame([(a, b, 5, 10, 10, float(w), 0.1) for a, b, w in rows], "pa long, pb long, shared long, sza long, szb long, pmi double, jaccard double")


def test_labels_settle_where_neighbours_would_swing(spark):
    e = edges(spark, (1, 2, 1), (3, 4, 2), (4, 5, 2), (3, 5, 2), (5, 6, 0.5), (6, 7, 2), (7, 8, 2), (6, 8, 2), (10, 11, 1), (10, 12, 1), (10, 13, 1))
    labels = graph.label_propagation(e)
    got = {r.id: r.community for r in labels.collect()}
    assert got[1] == got[2] and got[3] == got[4] == got[5] and got[6] == got[7] == got[8] != got[5] and len({got[i] for i in (10, 11, 12, 13)}) == 1
    parts = graph.modularity(e, labels).collect()
    m = 16.5
    want = sum(w / m for a, b, w in [(1, 2, 1), (3, 4, 2), (4, 5, 2), (3, 5, 2), (5, 6, 0.5), (6, 7, 2), (7, 8, 2), (6, 8, 2), (10, 11, 1), (10, 12, 1), (10, 13, 1)] if got[a] == got[b])
    want -= sum((d / (2 * m)) ** 2 for d in (2, 12.5, 12.5, 6))
    assert abs(sum(r.modularity for r in parts) - want) < 1e-9 and sum(r.members for r in parts) == 12
    with pytest.raises(RuntimeError, match="did not settle"):
        graph.label_propagation(e, rounds=1)


def test_edges_and_fanout_in_order(spark):
    e = edges(spark, (1, 2, 1), (1, 3, 3), (2, 3, 3), (4, 5, 2))
    assert [(r.pa, r.pb, r.place) for r in graph.top_edges(e, 3).collect()] == [(1, 3, 1), (2, 3, 2), (4, 5, 3)]
    paid = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 10), (3, 10), (3, 11)], "member_id long, billing_id long")
    assert [tuple(r) for r in graph.member_fanout_table(paid).collect()] == [(1, 2), (3, 2), (2, 1)]
    assert graph.biller_pairs(paid, Config(panel_min=1, shared_min=2, pmi_min=-9.0)).count() == 1
