"""Assembly of the screen's combined table."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from clearledger.config import Config
from clearledger.operators import hours, patterns, screen
from clearledger.operators.prep import service_lines, with_level

from .test_units import claims

CFG = Config()


def test_details_come_from_the_widest_window(spark):
    scored = spark.createDataFrame([("1Y", 1, "a, b"), ("6M", 1, "c"), ("6M", 2, "")], "window string, id long, red_flags string")
    features = spark.createDataFrame([("Full", 1, 9.0, "Z"), ("1Y", 1, 1.5, "X"), ("6M", 1, 2.5, "Y"), ("6M", 2, None, "W")], "window string, id long, tier2_per_month double, top_code string")
    got = {r.id: r for r in screen.window_details(scored, features, "id", CFG).collect()}
    assert (got[1]["red_flags_1Y"], got[1]["red_flags_6M"], got[1]["red_flags_Full"], got[1]["tier2_per_month_1Y"], got[1].top_code) == ("a, b", "c", None, 1.5, "X")
    assert got[2].top_code is None and got[2]["red_flags_6M"] == ""  # the widest window that has scores does not hold it
    assert screen.window_details(scored.limit(0), features, "id", CFG).collect() == []


def test_pattern_details_by_clinician(spark):
    cols = "window string, servicing_id long, " + ", ".join(f"{c} double" for c in screen.PATTERN_DETAIL)
    rows = [("6M", 1, *[1.0] * 8), ("Full", 1, *[2.0] * 8), ("1Y", 2, *[None] * 8), ("6M", 2, *[9.0] * 8)]
    got = {r.servicing_id: (r.pattern_window, r.units_ratio) for r in screen.pattern_details(spark.createDataFrame(rows, cols), CFG).collect()}
    assert got == {1: ("Full", 2.0), 2: ("1Y", None)}


def test_entities_that_share_lines_with_the_reference(spark):
    lines = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 10), (3, None)], "servicing_id long, billing_id long")
    assert sorted(r.servicing_id for r in screen.bills_with(lines, "servicing_id", "billing_id", 10, "via").collect()) == [1, 2]
    assert screen.bills_with(lines, "servicing_id", "billing_id", 99, "via").collect() == []


def test_patterns_of_nested_windows_are_those_of_each_window(spark):
    """Days at the edges of windows, unknown billers and lines without amounts: level by level as by window."""
    cfg = replace(CFG, unit_minutes=(("T1", 15), ("T2", 60)))
    r = random.Random(4)
    rows = [
        {"servicing_id": r.choice([1, 2, 3, None]), "billing_id": r.choice([1, 2, 3, 4, None]), "member_id": m % 9, "svc_dt": r.choice([date(2001, 6, 30), date(2001, 1, 1), date(2000, 12, 30), date(2000, 6, 30), date(2000, 6, 29), date(1999, 3, 3), date(2000, 12, 31)]), "code": r.choice(["t1", "T2 ", "X"]), "qty": float(r.choice([0, 4, 12])), "paid": r.choice([None, 10.0, 2.5])}
        for m in range(300)
    ]
    lines = service_lines(claims(spark, *rows), cfg)
    days = hours.clinician_days(lines, cfg)
    anchor = lines.agg(F.max("svc_dt").alias("_anchor"))
    got = patterns.nested_pattern_table(with_level(lines, cfg, anchor=anchor), with_level(days, cfg, anchor=anchor), cfg).toPandas()
    parts = []
    for name, months in cfg.windows:
        own = lambda df: df if months is None else df.crossJoin(anchor).where(F.col("svc_dt") >= F.add_months("_anchor", -months)).drop("_anchor")  # noqa: B023, E731
        parts.append(patterns.pattern_table(own(lines), own(days), cfg).toPandas().assign(window=name))
    want = pd.concat(parts)
    order = ["window", "servicing_id"]
    assert len(got) == len(want) >= 9 and set(got.columns) == set(want.columns)
    a, b = (x.sort_values(order).reset_index(drop=True)[sorted(want.columns)] for x in (got, want))
    pd.testing.assert_frame_equal(a[a.servicing_id.notna()].reset_index(drop=True), b[b.servicing_id.notna()].reset_index(drop=True), check_dtype=False)
