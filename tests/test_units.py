"""Rules and measures on hand-made rows at production settings."""

from __future__ import annotations

import datetime as dt
import itertools
import random
import uuid
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clearledger.config import Config
from clearledger.contracts import CLAIMS, check_schema
from clearledger.functions.expressions import minutes_per_unit, ratio, share_over, up_to
from clearledger.functions.orderstats import deviation, percentiles, with_average_rank, with_percent_rank
from clearledger.functions.scratch import connected_components, drop_scratch, materialise, scratch
from clearledger.operators import duplicates, evidence, gate, patterns, rules, scoring, screen
from clearledger.operators.prep import in_windows, prep, service_lines
from clearledger.sources import editfiles, loads, sinks

DAY = dt.date(2001, 5, 1)
BASE = dict(line_id="a", claim_id=1, member_id=1, billing_id=10, servicing_id=20, code="T1", code_desc="CARE, PER 15 MINUTES", cos="CARE", qty=1.0, paid=10.0, svc_dt=DAY, svc_end=None, lob=None, tax_id=5, mod1=None, mod2=None, mod3=None, mod4=None, status="A")


def claims(spark, *rows):
    full = [BASE | {"line_id": f"l{i}"} | r for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f.name] for f in CLAIMS) for r in full], CLAIMS)


def test_minutes_from_descriptions(spark):
    texts = {"CARE, PER 15 MINUTES": 15, "Each additional 30 minutes": None, "EACH 30 MINUTES": 30, "UP TO 15 MINUTES": 15, "2 HOURS": None, "OBSERVATION 24 HOUR STAY": None, "PER 2 HOURS": 120, "PER HOUR": 60, "CARE, EACH HOUR": 60, "UP TO HOUR": 60, "MINI-BUS": None, "": None, None: None}
    got = spark.createDataFrame([(k,) for k in texts], "d string").select("d", minutes_per_unit(F.col("d")).alias("m"), up_to(F.col("d")).alias("u")).collect()
    assert {r.d: r.m for r in got} == texts
    assert [r.d for r in got if r.u] == ["UP TO 15 MINUTES"]


def test_prep_window_nulls_and_future(spark):
    c = claims(spark, {}, {"svc_dt": None}, {"svc_dt": dt.date(2030, 1, 1)}, {"status": "V"}, {"svc_dt": dt.date(1998, 1, 1)}, {"paid": None, "qty": None})
    p = prep(c, Config()).orderBy("line_id").collect()
    assert [r.line_id for r in p] == ["l0", "l5"] and p[1].paid == 0.0 and p[1].qty == 0.0 and all(r.in_detection_window for r in p)


def test_hours_rule_tiers_and_spans(spark):
    rows = [{"qty": 100.0}, {"member_id": 2, "qty": 60.0}, {"member_id": 2, "qty": 60.0, "code": "T2"}, {"member_id": 3, "qty": 100.0, "svc_end": dt.date(2001, 5, 3)}, {"member_id": 4, "qty": 100.0, "code_desc": "UP TO 15 MINUTES"}, {"member_id": 5, "qty": 500.0, "billing_id": -1}]
    got = {r.member_id: r for r in rules.with_evidence(rules.impossible_hours(prep(claims(spark, *rows), Config()), Config()), Config()).hits.collect()}
    assert sorted(got) == [1, 2, 4] and got[1].tier == 1 and got[2].tier == 2 and got[4].tier == 2
    assert got[1].severity == round(1500 / 1440, 3) and got[2].first_keys == ["l1", "l2"] and got[2].evidence_keys == "l1|l2" and got[2].n_lines == 2 and "several codes" in got[2].detail


def test_transport_within_a_day(spark):
    t = {"cos": "NON-EMERGENCY TRANSPORTATION"}
    rows = [t | {"member_id": m, "svc_dt": dt.date(2001, 5, 10)} for m in range(1, 9)] + [{"member_id": m, "svc_dt": dt.date(2001, 5, 11)} for m in range(1, 8)] + [{"member_id": 8, "svc_dt": dt.date(2001, 5, 12)}]
    got = rules.unanchored_transport(prep(claims(spark, *rows), Config()), Config()).hits.collect()
    assert [r.member_id for r in got] == [8]
    none = rules.unanchored_transport(prep(claims(spark, *rows[:8]), Config()), Config())  # all trips alone: too common to mean anything
    assert none.hits.isEmpty() and none.lines.isEmpty()


def test_cross_biller_keeps_lines_without_payer(spark):
    rows = [{"billing_id": 10}, {"billing_id": 11, "paid": 7.0}, {"billing_id": 12, "lob": "MSP"}, {"billing_id": 10, "qty": 2.0}]
    got = {r.entity_id: r.hit_dollars for r in rules.cross_biller(prep(claims(spark, *rows), Config()), Config()).hits.collect()}
    assert got == {10: 10.0, 11: 7.0}


def test_deviation_of_equal_values(spark):
    assert deviation(spark.createDataFrame([(1.0,)] * 3, "v double"), "v").first() == (1.0, 1e-9)


def fold(families, limit=0.5):
    counted, seen, tier1 = [], set(), False
    for f in sorted(families, key=lambda x: (-len(x[1]), x[0])):
        k = set(f[1])
        if k and (not counted or len(k & seen) / len(k) < limit):
            counted.append(f[0])
            tier1 = tier1 or f[2]
        seen |= k
    return counted, tier1


def test_fold_matches_plain_version(spark):
    r = random.Random(3)
    cases = [[(n, [str(x) for x in r.sample(range(12), r.randint(0, 8))], r.random() < 0.3) for n in "abcde"[: r.randint(1, 5)]] for _ in range(60)]
    rows = []
    for i, c in enumerate(cases):
        by_set = Counter(tuple(sorted(f for f, keys, _ in c if k in keys)) for k in {k for _, keys, _ in c for k in keys})
        rows.append((i, [(f, len(keys), t) for f, keys, t in c if keys], [(list(names), n) for names, n in by_set.items()]))
    df = spark.createDataFrame(rows, "i int, f array<struct<family:string,size:long,tier1:boolean>>, s array<struct<families:array<string>,n:long>>")
    for x in df.select("i", scoring.fold_families(F.col("f"), F.col("s"), 0.5).alias("r")).collect():
        assert (x.r.counted, x.r.tier1) == fold(cases[x.i])


def test_average_rank_matches_pandas(spark):
    v = [3.0, 1.0, 3.0, None, 2.0, 3.0]
    got = spark.createDataFrame(list(enumerate(v)), "i int, v double").withColumn("g", F.lit(1)).transform(lambda d: with_average_rank(d, "v", ["g"], "r")).orderBy("i").toPandas()["r"]
    assert got.round(9).tolist()[:3] == pd.Series(v).rank(pct=True).round(9).tolist()[:3] and pd.isna(got[3])


def test_shares_and_ratios(spark):
    d = spark.createDataFrame([(1, 9.0), (1, None), (2, None)], "k int, h double")
    assert {r.k: r.s for r in d.groupBy("k").agg(share_over(F.col("h"), 8).alias("s")).collect()} == {1: 50.0, 2: None}
    one = spark.range(1)
    assert one.select(ratio(F.lit(3.0), F.lit(2.0)), ratio(F.lit(3.0), F.lit(0.0)), ratio(F.lit(3.0), F.lit(None).cast("double"))).first() == (1.5, None, None)


def test_trends(spark):
    f = lambda x: {w: F.lit(w in x) for w in ("Full", "1Y", "6M")}
    s = lambda last: {"Full": F.lit("clear"), "1Y": F.lit("clear"), "6M": F.lit(last)}
    cases = {("Full", "1Y", "6M"): "Persistent", ("6M",): "Emerging", ("1Y", "6M"): "Emerging", ("Full", "6M"): "Active - intermittent", ("Full", "1Y"): "Recently normalized", ("Full",): "Historical - pattern stopped"}
    for x, want in cases.items():
        assert spark.range(1).select(screen.trend_label(f(x), s("clear"))).first()[0] == want
    assert spark.range(1).select(screen.trend_label(f(("Full",)), s("inactive"))).first()[0] == "Historical - no recent billing"
    assert spark.range(1).select(screen.trend_label(f(("Full",)), s("not run"))).first()[0] == "Unclassified (window skipped)"


def test_windows_are_nested(spark):
    c = claims(spark, *[{"svc_dt": dt.date(2001 - i // 12, 12 - i % 12, 1)} for i in range(30)])
    got = {r.window: r.n for r in in_windows(c, Config()).groupBy("window").agg(F.count("*").alias("n")).collect()}
    assert got == {"Full": 30, "1Y": 13, "6M": 7}


def test_pattern_label_with_no_own_billing(spark):
    cfg = Config(unit_minutes=(("T1", 15),))
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    rows = [{"svc_dt": d, "qty": 100.0} for d in days] + [{"servicing_id": 10, "svc_dt": d, "qty": 100.0} for d in days]
    from clearledger.operators.hours import clinician_days

    n = service_lines(claims(spark, *rows), cfg)
    got = {r.servicing_id: r.pattern for r in patterns.pattern_table(n, clinician_days(n, cfg), cfg).collect()}
    assert got == {20: patterns.CLOSE, 10: patterns.IMPOSSIBLE}


def test_a_duplicate_never_lowers_the_total(spark):
    rows = [{"billing_id": b, "paid": 5.0 + b} for b in (10, 11)]
    total = lambda x: duplicates.duplicate_groups(duplicates.by_biller(claims(spark, *x), Config())).agg(F.sum("possible_duplicate_paid")).first()[0]
    assert total(rows) == 15.0 and total([*rows, {"billing_id": 12, "paid": 1.0}]) == 16.0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(51)} == {0} and {got[i] for i in range(100, 140)} == {100}


def test_final_orders(spark):
    rows = [(1, False, "Both", "Emerging"), (2, False, "Both", "Active - intermittent"), (3, True, "Percentile only", "Unclassified (window skipped)"), (4, False, "Pattern only", "Persistent"), (5, False, "Both", "Persistent"), (6, False, "Both", "Emerging")]
    table = spark.createDataFrame(rows, "id long, is_reference boolean, match_basis string, trend string")
    dollars = spark.createDataFrame([(1, 10.0, 5.0, 1.0), (2, 9.0, 1.0, 7.0), (6, 9.0, 9.0, 1.0)], "id long, total_paid double, tier2 double, tier1 double")
    assert [r.id for r in screen.combined_in_order(table, dollars, "id").collect()] == [3, 5, 2, 6, 1, 4]
    scored = spark.createDataFrame([("1Y", 1, False, 0.9, 0.9), ("1Y", 2, True, None, 0.5), ("1Y", 3, True, 0.4, 0.1), ("1Y", 4, True, 0.4, 0.2)], "window string, id long, is_hit boolean, signature_match double, similarity double")
    assert [r.id for r in screen.scores_in_order(scored, "id").collect()] == [4, 3, 2, 1]


def test_gate_notes(spark):
    p = lambda t, a=None, b=None, c=None, mi=None, g=None, why=None: (t, a, b, c, None, mi, g, why)
    base = lambda name, pred, codes=("A1",), population="all", able=True, reason=None, fields=(): (name, "manual", "s", "x", list(codes), population, able, False, reason, list(fields), pred)
    rows = [
        base("pair_first", p("code_pair_prohibited", "A1", "A1", mi="9")), base("indicator", p("code_pair_prohibited", "A1", "A2", mi="9")), base("both", p("code_pair_prohibited", "A1", "A2", mi=" 1"), codes=(" a1",), population="adults"),
        base("aged_pair", p("code_pair_prohibited", "A1", "A2", mi=" 1", g=(21, None)), codes=(" a1",), population="adults"), base("said", p("not_checkable", why="paper only")), base("off", p("odd"), able=False, reason="mine"),
        base("idle", p("frequency_limit"), reason="mine"), base("age", p("age_limit", g=(30, 20))), base("lacks", p("unit_limit", c="A1"), fields=("z", "y")),
    ]
    ok, _ = gate.gate(spark.createDataFrame(rows, gate.RULES), ["code"])
    got = {r.rule_id: (r.validation_status, r.not_checkable_reason, r.gate_notes) for r in ok.collect()}
    assert got == {
        "pair_first": ("downgraded", "ambiguous_source", "a pair needs two different codes"), "indicator": ("downgraded", "ambiguous_source", "unusable modifier indicator: 9"),
        "both": ("downgraded", "requires_member_attribute", "codes tidied; no condition selects the population adults"),
        "aged_pair": ("patched", None, "codes tidied; age stands for the population adults; modifier indicator set to 1"), "said": ("needs_review", "paper only", ""), "off": ("needs_review", "mine", ""),
        "idle": ("downgraded", "mine", "nothing runs predicates of type frequency_limit"), "age": ("downgraded", "ambiguous_source", "an age limit has no usable age"), "lacks": ("downgraded", "missing_claim_field", "claims lack y, z"),
    }


def test_gate_statuses(spark):
    age = (21, None)
    p = lambda t, a=None, b=None, c=None, mi=None, g=None: (t, a, b, c, None, mi, g, None)
    rows = [
        ("clean", "manual", "s", "x", ["A1"], "all", True, False, None, [], p("unit_limit", c="A1")), ("patched", "manual", "s", "x", [" a1 "], "all", True, False, None, [], p("unit_limit", c="A1")),
        ("derived", "manual", "s", "x", None, None, True, False, None, None, p("unit_limit", c="b2")), ("grammar", "manual", "s", "x", ["A1"], "all", True, False, None, [], p("odd")),
        ("self_pair", "manual", "s", "x", ["A1"], "all", True, False, None, [], p("code_pair_prohibited", "A1", " a1")), ("blank_mi", "manual", "s", "x", ["A1"], "all", True, False, None, [], p("code_pair_prohibited", "A1", "A2")),
        ("scoped", "manual", "s", "x", ["A1"], "adults", True, False, None, [], p("unit_limit", c="A1")), ("aged", "manual", "s", "x", ["A1"], "adults", True, False, None, [], p("unit_limit", c="A1", g=age)),
        ("fields", "manual", "s", "x", ["A1"], "all", True, False, None, ["nope"], p("unit_limit", c="A1")), ("review", "manual", "s", "x", ["A1"], "all", True, True, None, [], p("unit_limit", c="A1")),
        ("none", "manual", " ", "x", ["A1"], "all", True, False, None, [], p("unit_limit", c="A1")),
    ]
    ok, no = gate.gate(spark.createDataFrame(rows, gate.RULES), ["code"])
    got = {r.rule_id: r.validation_status for r in ok.collect()}
    assert got == {"clean": "clean", "patched": "patched", "derived": "patched", "grammar": "downgraded", "self_pair": "downgraded", "blank_mi": "patched", "scoped": "downgraded", "aged": "clean", "fields": "downgraded", "review": "needs_review"}
    assert [(r.rule_id, r.reject_reason) for r in no.collect()] == [("none", "no statement")]
    assert {r.rule_id: r.codes for r in ok.collect()}["derived"] == ["B2"]


def test_edit_files_load_once(spark, tmp_path):
    drop, target = tmp_path / "drop", str(tmp_path / "target")
    drop.mkdir()
    head = "column_one\tcolumn_two\teffective_date\tdeletion_date\tmodifier_indicator"
    (drop / "ptp_practitioner_2024q1_r0.txt").write_text(f"{head}\nA\tB\t20240101\t*\t1\nSource: public\n")
    (drop / "ptp_practitioner_2024q1_r1.txt").write_text(f"A title\nZ\tZ\t20240101\t*\t1\n{head}\nA\tB\t20240101\t*\t1\nA\tC\t20240101\t*\t0\n")
    (drop / "mue_dme_2024q1_r0.txt").write_text("code\tunit_limit\nA\tmany\n")
    (drop / "my_edit_list.txt").write_text("x")
    (drop / "readme.txt").write_text("x")
    log = {r.path.split("/")[-1]: r for r in loads.load(spark, str(drop), target, "one").collect()}
    assert {k: v.status for k, v in log.items()} == {"ptp_practitioner_2024q1_r0.txt": "superseded", "ptp_practitioner_2024q1_r1.txt": "loaded", "mue_dme_2024q1_r0.txt": "failed", "my_edit_list.txt": "failed"}
    assert loads.table(spark, target, "ptp").count() == 2
    again = {r.path.split("/")[-1]: r.status for r in loads.load(spark, str(drop), target, "two").collect()}
    assert again["ptp_practitioner_2024q1_r1.txt"] == "skipped_exists" and loads.table(spark, target, "ptp").count() == 2
    with pytest.raises(RuntimeError):
        editfiles.go(loads.log(spark, target))


def test_schema_check(spark):
    c = claims(spark, {})
    assert check_schema(c) == []
    assert [x.column for x in check_schema(c.drop("code_desc"))] == ["code_desc"]
    with pytest.raises(ValueError):
        check_schema(c.drop("line_id"))


def test_report_sink(spark, tmp_path):
    m = sinks.to_report(spark, {"A sheet with a name that is far too long": spark.range(2), "Empty": spark.range(0)}, str(tmp_path)).collect()
    assert [(r.rows, r.note) for r in m] == [(2, ""), (0, "none found")] and len(m[0].sheet) == 31


def test_wrapped_text(spark):
    text = " ".join(f"word{i}" for i in range(40))
    got = spark.range(1).select(evidence.wrapped(F.lit(text))).first()[0]
    assert max(map(len, got.split("\n"))) <= 70 and got.split() == text.split()


def test_invariants_hold(spark, sf_dir):
    from clearledger.plans.queries import check_leads, invariants

    assert all(r.violations == 0 for r in itertools.chain(invariants(spark, sf_dir).collect(), check_leads(spark, sf_dir).collect()))


def test_scratch_tables_are_deleted_on_request(spark):
    """Only this application's tables go; later ones are written as before."""
    folder = Path(scratch(spark, "x").removeprefix("file://")).parent
    other = folder.parent / f"another-application-{uuid.uuid4().hex}"
    other.mkdir(parents=True)
    table = materialise(spark.range(5), "five")
    assert table.count() == 5 and len(list(folder.glob("five-*"))) == 1
    assert drop_scratch(spark) and not folder.exists() and other.is_dir() and not drop_scratch(spark)
    assert materialise(spark.range(3), "three").count() == 3
    other.rmdir()
