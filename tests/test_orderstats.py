"""Order statistics, ranks and evidence against pandas and plain code, with nulls, ties and values that most rows share."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clearledger.config import Config
from clearledger.functions.expressions import minutes_per_unit
from clearledger.functions.orderstats import deviation, percentiles, ranked_values, with_average_rank, with_percent_rank
from clearledger.operators import evidence, rules, scoring
from clearledger.operators.prep import prep

from .test_units import claims


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("abc"), rng.choice([None, 0.0, 0.0, 0.0, rng.uniform(-5, 5), float(rng.randint(0, 4))])) for i in range(3000)] + [(-1, "d", None), (-2, "d", None), (-3, "e", 7.0), (-4, None, 1.0), (-5, None, 3.0)]
    return spark.createDataFrame(rows, "i int, g string, v double").repartition(5), pd.DataFrame(rows, columns=["i", "g", "v"])


PLACES = {"lo": 0.0, "q": 0.25, "med": 0.5, "high": 0.995, "hi": 1.0}


def test_percentiles_of_groups_and_of_all(table):
    df, pdf = table
    got = {r.g: r for r in percentiles(df, "v", PLACES, ["g"]).collect()}
    want = {None if pd.isna(g) else g: x.dropna() for g, x in pdf.groupby("g", dropna=False)["v"]}
    assert set(got) == {"a", "b", "c", "e", None}
    for g, r in got.items():
        assert np.allclose([r[n] for n in PLACES], np.quantile(want[g], list(PLACES.values())), atol=1e-12)
    one = percentiles(df, "v", PLACES).collect()
    assert len(one) == 1 and np.allclose([one[0][n] for n in PLACES], pdf["v"].dropna().quantile(list(PLACES.values())), atol=1e-12)


def test_percentiles_of_nothing(table):
    df, _ = table
    assert [tuple(r) for r in percentiles(df.limit(0), "v", {"a": 0.5}).collect()] == [(None,)] and percentiles(df.where("g = 'd'"), "v", {"a": 0.5}, ["g"]).collect() == []


def test_deviation_of_groups(table):
    df, pdf = table
    for r in deviation(df, "v", ["g"]).where("g in ('a', 'b', 'c')").collect():
        x = pdf[pdf.g == r.g]["v"].dropna()
        assert np.isclose(r.med, x.median()) and np.isclose(r["mad"], (x - x.median()).abs().median() or 1e-9)
    assert deviation(df.where("g = 'e'"), "v").first() == (7.0, 1e-9)


def test_ranks_match_pandas(table):
    df, pdf = table
    got = with_percent_rank(with_average_rank(df, "v", ["g"], "avg"), "v", ["g"], "pct").toPandas().set_index("i")
    assert len(got) == len(pdf)
    pdf = pdf.set_index("i")
    avg = pdf.groupby("g", dropna=False)["v"].rank(pct=True)
    low = pdf["v"].fillna(-1e9)
    pct = (low.groupby(pdf["g"], dropna=False).rank(method="min") - 1) / (low.groupby(pdf["g"], dropna=False).transform("size") - 1) * 100
    assert np.allclose(got["avg"].reindex(pdf.index), avg, equal_nan=True) and np.allclose(got["pct"].reindex(pdf.index), pct.fillna(0.0))


def test_no_task_holds_all_values(spark):
    """200,000 distinct values over 4 partitions: the plan has no window or aggregate without a partition key that grows with them."""
    df = spark.range(200_000).select((F.col("id") * 37 % 200_003).cast("double").alias("v"))
    placed = ranked_values(df, "v")
    per = placed.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per) == 200_000 and max(r["count"] for r in per) < 120_000
    assert percentiles(df, "v", {"m": 0.5}).first()[0] == float(df.selectExpr("percentile(v, 0.5)").first()[0])


def test_long_numbers_in_descriptions(spark):
    texts = {"PER 99999999999 MINUTES": 99999999999.0, "UP TO 00000000000000000015 MINUTES": 15.0, "EACH 99999999999999999999 HOUR": 6e21, f"PER {'9' * 400} MINUTES": float("inf")}
    got = spark.createDataFrame([(k,) for k in texts], "d string").select("d", minutes_per_unit(F.col("d")).alias("m")).collect()
    assert {r.d: r.m for r in got} == texts


def test_a_hit_with_very_many_lines_carries_a_few_ids(spark):
    many = [{"billing_id": 10 + i % 40, "servicing_id": 77, "member_id": i, "tax_id": i % 9, "qty": 0.0} for i in range(4000)] + [{"servicing_id": s, "member_id": 9000 + s, "qty": 0.0} for s in range(100, 400)]
    cfg = Config(billers_pctile=0.9)
    paid = prep(claims(spark, *many), cfg)
    what = rules.with_evidence(rules.many_billers(paid, cfg), cfg)
    hit = what.hits.collect()
    assert len(hit) == 1 and hit[0].entity_id == 77 and hit[0].n_lines == 4000 == what.lines.count() and hit[0].first_keys == sorted(f"l{i}" for i in range(4000))[: cfg.evidence_keys] and hit[0].severity == 40.0
    lines = scoring.flagged_lines(what, paid)
    assert lines.count() == 4000 and not [f for f in what.hits.schema if f.name == "line_keys"]
    stats = evidence.rule_stats(what.hits).first()
    assert stats.example_keys == hit[0].first_keys[:5] and stats.occasions == 1


def test_null_keys_are_groups(spark):
    rows = [{"cos": None, "qty": 0.0}] * 30 + [{"cos": "X", "member_id": m, "qty": 0.0} for m in range(300)]
    cfg = Config()
    what = rules.with_evidence(rules.member_day_volume(prep(claims(spark, *rows), cfg), cfg), cfg)
    assert [(r.cos, r.n_lines, r.metric) for r in what.hits.collect()] == [(None, 30, 30.0)]


def test_rules_run_side_by_side_as_one_by_one(spark):
    """The same hits and lines, whatever runs at a time; a rule that fails fails the run."""
    rows = [{"member_id": m % 7, "claim_id": m, "servicing_id": m % 11, "qty": float(m % 5)} for m in range(60)]
    few = {r: rules.RULES[r] for r in ("R6", "R7", "R8A")}
    base = {"volume_pctile": 0.5, "renderers_pctile": 0.1, "renderers_floor": 0}
    seen = []
    for n in (1, 3):
        cfg = Config(rules_at_once=n, **base)
        what = rules.run_rules(prep(claims(spark, *rows), cfg), cfg, few)
        seen.append((sorted(map(str, what.hits.collect())), sorted(map(str, what.lines.collect()))))
    assert seen[0] == seen[1] and seen[0][0]

    def fails(paid, cfg):
        raise KeyError("no such column")

    with pytest.raises(KeyError):
        rules.run_rules(prep(claims(spark, *rows), cfg), cfg, {**few, "R0": fails})
