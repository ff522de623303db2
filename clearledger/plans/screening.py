"""The lookalike screen over all windows, from claims to trends, links and summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.scratch import materialise
from ..operators import duplicates, hours, patterns, screen
from ..operators.prep import in_windows, last_months, service_lines, with_level


@dataclass
class Base:
    """The tables that every part of the screen starts from; lines_w: lines once for each window, for the reports; leveled: lines, days and exposed lines with _level, for the features."""

    lines: DataFrame
    days: DataFrame
    exposed: DataFrame
    lines_w: DataFrame
    leveled: tuple[DataFrame, DataFrame, DataFrame]


def base(claims: DataFrame, cfg: Config) -> Base:
    lines = service_lines(claims, cfg)
    days = hours.clinician_days(lines, cfg)
    exposed = hours.line_exposure(lines, days)
    anchor = lines.agg(F.max("svc_dt").alias("_anchor"))
    return Base(lines, days, exposed, in_windows(lines, cfg, anchor=anchor), tuple(with_level(df, cfg, anchor=anchor) for df in (lines, days, exposed)))


def features(b: Base, cfg: Config) -> tuple[DataFrame, DataFrame]:
    serving = materialise(screen.servicing_features(*b.leveled, cfg), "serving")
    return serving, screen.billing_features(*b.leveled, serving, cfg)


def labels(b: Base, cfg: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pattern table, labels of clinicians, labels of billers)."""
    t = patterns.nested_pattern_table(*b.leveled[:2], cfg)
    return t, t.select("window", "servicing_id", "pattern"), screen.primary_billers(t).withColumn("pattern", F.lit(screen.PRIMARY))


def trends(b: Base, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Combined tables of clinicians and billers."""
    serving, billing = features(b, cfg)
    _, own, main = labels(b, cfg)
    s = screen.score_lookalikes(serving, "servicing_id", cfg.reference_servicing, screen.SERVICING_FEATURES, cfg)
    t = screen.score_lookalikes(billing, "billing_id", cfg.reference_billing, screen.BILLING_FEATURES, cfg)
    return screen.combine(s, own, "servicing_id", cfg.reference_servicing, cfg), screen.combine(t, main, "billing_id", cfg.reference_billing, cfg)


def recovery_lines(b: Base, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Lines and exposed lines of the recovery window."""
    return last_months(b.lines, cfg.recovery_months, cfg), last_months(b.exposed, cfg.recovery_months, cfg)


@dataclass
class Screen:
    """The screen's tables: see run()."""

    servicing: DataFrame
    billing: DataFrame
    links: DataFrame
    summary: DataFrame
    calibration: DataFrame
    signatures: DataFrame
    pattern: DataFrame
    duplicates: DataFrame
    duplicate_pairs: DataFrame
    self_listed: DataFrame


def run(claims: DataFrame, cohort_claims: DataFrame, cfg: Config) -> Screen:
    """The whole screen: claims are all paid lines, cohort_claims those of the cohort.

    Combined tables of clinicians and billers with all columns, network links, exposure by trend, calibration, signatures, patterns, and duplicates and
    self-listed billers of the recovery window.
    """
    b = base(materialise(cohort_claims, "cohort"), cfg)
    serving, billing = features(b, cfg)
    serving, billing = serving, materialise(billing, "billing")
    pattern, own, main = labels(b, cfg)
    pattern = materialise(pattern, "pattern")
    own, main = pattern.select("window", "servicing_id", "pattern"), screen.primary_billers(pattern).withColumn("pattern", F.lit(screen.PRIMARY))
    look = lambda f, key, ref, names: materialise(screen.score_lookalikes(f, key, ref, names, cfg), "scores")
    s = look(serving, "servicing_id", cfg.reference_servicing, screen.SERVICING_FEATURES)
    t = look(billing, "billing_id", cfg.reference_billing, screen.BILLING_FEATURES)
    lines, exposed = recovery_lines(b, cfg)
    recent = lambda df: df if cfg.recovery_months is None else df.crossJoin(F.broadcast(b.lines.agg(F.max("svc_dt").alias("_anchor")))).where(F.col("svc_dt") >= F.add_months("_anchor", -cfg.recovery_months)).drop("_anchor")  # noqa: E731  one row
    per = materialise(duplicates.by_biller(recent(duplicates.duplicate_scope(claims, cohort_claims)), cfg), "per_biller")
    groups = materialise(duplicates.duplicate_groups(per), "groups")
    listed = materialise(duplicates.self_listed(recent(duplicates.role_scope(claims, cohort_claims))), "listed")
    involved = duplicates.duplicate_involvement(groups).select("provider", F.col("services").alias("dup_services"), F.col("possible_duplicate_paid").alias("dup_paid"))
    matched = main.groupBy("billing_id").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("matched_clinicians")))), ", ").alias("matched_clinicians"))
    roles = listed.select("billing_id", "self_lines", "pct_self_lines", "self_paid")
    money = {k: materialise(screen.recovery(lines, exposed, k), "recovery") for k in ("servicing_id", "billing_id")}
    narrow = {"servicing_id": screen.combine(s, own, "servicing_id", cfg.reference_servicing, cfg), "billing_id": screen.combine(t, main, "billing_id", cfg.reference_billing, cfg)}
    narrow = {k: materialise(x, "combined") for k, x in narrow.items()}
    flag = lambda df, name: df.withColumn(name, F.coalesce(name, F.lit(False)))
    via = screen.bills_with(b.lines, "servicing_id", "billing_id", cfg.reference_billing, "bills_through_reference")
    here = screen.bills_with(b.lines, "billing_id", "servicing_id", cfg.reference_servicing, "reference_bills_here")
    serv = screen.assemble(narrow["servicing_id"], "servicing_id", money["servicing_id"], screen.window_details(s, serving, "servicing_id", cfg), [via, screen.pattern_details(pattern, cfg), involved.withColumnRenamed("provider", "servicing_id")])
    bill = screen.assemble(narrow["billing_id"], "billing_id", money["billing_id"], screen.window_details(t, billing, "billing_id", cfg), [here, matched, roles, involved.withColumnRenamed("provider", "billing_id")])
    summary = screen.exposure_summary(narrow["servicing_id"], money["servicing_id"], "servicing_id", "Servicing").unionByName(screen.exposure_summary(narrow["billing_id"], money["billing_id"], "billing_id", "Billing"))
    marks = screen.signatures(serving, "servicing_id", cfg.reference_servicing, screen.SERVICING_FEATURES, cfg, "servicing").unionByName(screen.signatures(billing, "billing_id", cfg.reference_billing, screen.BILLING_FEATURES, cfg, "billing"))
    return Screen(
        flag(serv, "bills_through_reference"), flag(bill, "reference_bills_here"), screen.network_links(lines, narrow["servicing_id"], narrow["billing_id"]), summary,
        screen.calibration(pattern, cfg.reference_servicing, cfg), marks, pattern, groups, duplicates.duplicate_pairs(per, groups), listed,
    )
