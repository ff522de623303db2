"""Flagged lines in one pass, and the window as a constant of the plan."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clearledger.config import Config
from clearledger.operators import rules, scoring
from clearledger.operators.prep import last_day, prep
from clearledger.plans import queries

from .test_units import claims

LAX = Config(volume_pctile=0.5, renderers_pctile=0.1, renderers_floor=0, billers_pctile=0.1, billers_floor=0, units_pctile=0.1, fanout_pctile=0.1, facility="CARE", facility_min_lines=0, match_units=False)


def shown(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("ids", ["own", "repeated", "null"])
def test_lines_at_once_are_the_flagged_lines(spark, ids):
    """Also where several claim lines have one id: each flagged id has all lines of it, once for each rule and entity."""
    name = {"own": lambda i: f"l{i}", "repeated": lambda i: f"l{i // 2 * 2}", "null": lambda i: None if i % 3 == 0 else f"l{i}"}[ids]
    pick = random.Random(1)
    rows = [{"line_id": name(i), "claim_id": i % 25, "member_id": pick.choice((1, 1, 2, 3)), "billing_id": 10 + int(pick.random() ** 2 * 5), "servicing_id": 20 + int(pick.random() ** 2 * 6), "cos": pick.choice(("CARE", "CARE", None)), "qty": float(i % 90), "paid": 1.5 * (i % 20)} for i in range(60)]
    paid = prep(claims(spark, *rows), LAX)
    want = scoring.flagged_lines(rules.run_rules(paid, LAX), paid)
    got = scoring.lines_at_once(paid, LAX)
    assert shown(got) == shown(want) and len({r.rule_id for r in got.collect()}) > 4
    roles = spark.createDataFrame([(10, "servicing"), (21, "billing")], "provider_key long, expected_role string")
    few = {"R6": rules.repeated_claims}
    assert shown(scoring.lines_at_once(paid, LAX, few, roles)) == shown(scoring.flagged_lines(rules.run_rules(paid, LAX, few, roles), paid))


def test_the_query_writes_no_hits_and_no_line_ids_of_them(spark, sf_dir):
    names = {p.split("/")[-2].rsplit("-", 1)[0] for p in queries.flagged_lines(spark, sf_dir).inputFiles()}
    assert "flagged" in names and not names & {"hits", "hit_lines"}


def test_the_window_holds_before_any_join(spark):
    """The anchor was a row joined to all lines, so the window's filter stayed above the joins of the claims."""
    days = claims(spark, {"svc_dt": dt.date(2001, 5, 1)}, {"svc_dt": dt.date(1999, 5, 1)}, {"svc_dt": dt.date(1999, 4, 30)}).join(spark.range(30).withColumnRenamed("id", "claim_id"), "claim_id")
    p = prep(days, Config())
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and any("Filter" in x and ">= 1999-05-01" in x for x in plan.split("Join")[1].splitlines())
    assert sorted(r.svc_dt for r in p.collect()) == [dt.date(1999, 5, 1), dt.date(2001, 5, 1)]


def test_last_day(spark):
    until = dt.date(2001, 12, 31)
    for last in (dt.date(2001, 12, 31), dt.date(2001, 10, 1), dt.date(2001, 9, 30), dt.date(1999, 12, 31), dt.date(1970, 1, 1)):
        df = spark.createDataFrame([(last,), (dt.date(1960, 1, 1),), (None,)], "svc_dt date")
        assert last_day(df, until) == last
    assert last_day(df.where("svc_dt is null"), until) is None
    assert prep(claims(spark, {"status": "V"}), Config()).isEmpty()


def test_repeated_claims_count_known_claims(spark):
    rows = [{"claim_id": 1}, {"claim_id": 1}, {"member_id": 2, "claim_id": 1}, {"member_id": 2, "claim_id": None}, {"member_id": 3, "claim_id": 4}, {"member_id": 3, "claim_id": 5}, {"member_id": 4, "claim_id": None}, {"member_id": 4, "claim_id": None}]
    paid = prep(claims(spark, *rows), Config())
    assert [(r.member_id, r.metric) for r in rules.repeated_claims(paid, Config()).hits.collect()] == [(3, 2.0)]
    groups = rules.repeated_claims(paid.withColumn("claim_id", F.lit(7)), Config())
    assert groups.hits.isEmpty() and groups.lines.isEmpty()
