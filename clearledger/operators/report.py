"""Comparison of entities with their peers. K is the clinician or the biller; other roles are counterparties.

Whatever a report needs for one entity is computed for all entities in one grouped plan; a target is a filter at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.expressions import money, ratio, share_over
from ..functions.orderstats import with_percent_rank
from ..functions.scratch import materialise
from .patterns import cookie_cutter, repeat_packages

OTHER = {"servicing_id": "billing_id", "billing_id": "servicing_id"}


def daily(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Units, members, counterparties, lines and timed hours by keys and day."""
    other = OTHER[[k for k in keys if k in OTHER][0]]
    return lines.groupBy(*keys, "svc_dt").agg(F.sum("qty").alias("units"), F.countDistinct("member_id").alias("members"), F.countDistinct(other).alias("counterparties"), F.count("*").alias("lines"), (F.sum("minutes") / 60).alias("hours"))


def daily_volume(days: DataFrame, keys: list[str]) -> DataFrame:
    """Averages, medians and maxima of an entity's days."""
    med = lambda c: F.percentile_approx(c, 0.5, 10_000).alias(f"med_{c}_day")
    return days.groupBy(*keys).agg(F.count("*").alias("days"), *[f(c).alias(f"{n}_{c}_day") for c in ("units", "members", "hours") for n, f in (("avg", F.avg), ("max", F.max))], med("units"), med("members"), med("hours"))


def thresholds(days: DataFrame, keys: list[str], cfg: Config) -> DataFrame:
    """Percentage of days over each number of hours."""
    return days.groupBy(*keys).agg(*[share_over(F.col("hours"), h).alias(f"pct_days_over_{h}h") for h in cfg.thresholds])


def members_per_day(days: DataFrame, keys: list[str]) -> DataFrame:
    return days.groupBy(*keys).agg(F.avg("members").alias("avg_members"), F.percentile_approx("members", 0.5, 10_000).alias("med_members"), F.max("members").alias("max_members"))


def totals(lines: DataFrame, keys: list[str]) -> DataFrame:
    other = OTHER[[k for k in keys if k in OTHER][0]]
    return lines.groupBy(*keys).agg(F.sum("qty").alias("units"), money("paid").alias("paid"), F.countDistinct("member_id").alias("members"), F.countDistinct(other).alias("counterparties"), F.countDistinct("code").alias("codes"), F.count("*").alias("lines"))


def clinician_day_mix(lines: DataFrame, clinician_days: DataFrame, cfg: Config) -> DataFrame:
    """Of each biller's clinicians: average hours a day over all billers, and shares over the thresholds."""
    own = lines.select("billing_id", "servicing_id", "svc_dt").distinct().join(clinician_days.select("servicing_id", "svc_dt", "hours"), ["servicing_id", "svc_dt"])
    return own.groupBy("billing_id").agg(F.count("*").alias("clinician_days"), F.avg("hours").alias("avg_hours"), *[share_over(F.col("hours"), h).alias(f"pct_over_{h}h") for h in cfg.thresholds])


def peer_medians(table: DataFrame, key: str, target: object, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Medians of columns over all entities but the target; one row, or one by `by`."""
    peers = table.where(F.col(key) != F.lit(target))
    return peers.groupBy(*(by or [])).agg(*[F.percentile_approx(c, 0.5, 10_000).alias(c) for c in columns])


def counterparty_breakdown(lines: DataFrame, key: str) -> DataFrame:
    """Lines, dollars, units, members, days and hours of an entity by counterparty."""
    return lines.groupBy(key, OTHER[key]).agg(F.count("*").alias("lines"), money("paid").alias("paid"), F.sum("qty").alias("units"), F.countDistinct("member_id").alias("members"), F.countDistinct("svc_dt").alias("days"), (F.sum("minutes") / 60).alias("hours"))


def counterparty_daily(lines: DataFrame, key: str) -> DataFrame:
    """Average units, hours and members a day, and most hours, by counterparty: one plan for all of them."""
    d = lines.groupBy(key, OTHER[key], "svc_dt").agg(F.sum("qty").alias("units"), F.countDistinct("member_id").alias("members"), (F.sum("minutes") / 60).alias("hours"))
    return d.groupBy(key, OTHER[key]).agg(F.avg("units").alias("avg_units"), F.avg("hours").alias("avg_hours"), F.max("hours").alias("max_hours"), F.avg("members").alias("avg_members"), F.count("*").alias("days"))


def outlier_clinicians(lines: DataFrame, times: float = 2.0) -> DataFrame:
    """Clinicians whose units a day pass `times` the cohort's median."""
    own = daily(lines, ["servicing_id"]).groupBy("servicing_id").agg(F.avg("units").alias("units_day"))
    med = own.agg(F.percentile_approx("units_day", 0.5, 10_000).alias("cohort_median"))
    return own.crossJoin(F.broadcast(med)).where(F.col("units_day") > times * F.col("cohort_median"))  # one row


def percent_ranks(volume: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """percent_rank times 100 of each column among all entities; keys before the last one partition, and all keys name one row.

    All columns are ranked in one pass, as rows of (metric, value); values compare as doubles.
    """
    long = volume.unpivot(keys, [F.col(c).cast("double").alias(c) for c in columns], "_metric", "_value")
    ranked = with_percent_rank(materialise(long, "volume"), "_value", [*keys[:-1], "_metric"], "_rank")
    return ranked.groupBy(*keys).agg(*[F.max(F.when(F.col("_metric") == c, F.col("_rank"))).alias(f"rank_{c}") for c in columns])


def code_profile(lines: DataFrame, key: str, cfg: Config) -> DataFrame:
    """By code and entity: volumes, averages, sessions and threshold shares. One plan for all codes."""
    k = ["code", key]
    timed = F.sum("minutes")
    base = lines.groupBy(*k).agg(F.sum("qty").alias("units"), F.countDistinct("member_id").alias("members"), F.countDistinct("svc_dt").alias("days"), F.count("*").alias("lines"), money("paid").alias("paid"), timed.alias("minutes"))
    d = lines.groupBy(*k, "svc_dt").agg(F.countDistinct("member_id").alias("m"), F.when(timed > 0, timed / 60).alias("hours"))
    days = d.groupBy(*k).agg(F.avg("m").alias("members_day"), F.percentile_approx("m", 0.5, 10_000).alias("med_members_day"), F.max("m").alias("max_members_day"), *[share_over(F.col("hours"), h).alias(f"pct_days_over_{h}h") for h in cfg.thresholds])
    s = lines.groupBy(*k, "member_id", "svc_dt").agg((timed / 60).alias("h")).where("h > 0").groupBy(*k).agg(F.avg("h").alias("avg_session"), F.percentile_approx("h", 0.5, 10_000).alias("med_session"), F.max("h").alias("max_session"))
    t = base.join(days, k, "left").join(s, k, "left")
    hours = F.when(F.col("minutes") > 0, F.col("minutes") / 60)
    return t.withColumn("hours", hours).withColumn("units_day", F.try_divide("units", "days")).withColumn("hours_day", F.try_divide("hours", "days")).withColumn("units_member", F.try_divide("units", "members")).withColumn("paid_unit", F.try_divide("paid", "units")).drop("minutes")


CODE_RATIOS = ["units", "units_day", "units_member", "paid"]


def code_report(lines: DataFrame, key: str, target: object, cfg: Config) -> DataFrame:
    """The target's codes beside peer medians, ratios, rank of units a day, and pattern shares, most unusual first."""
    p = code_profile(lines, key, cfg)
    columns = [c for c in p.columns if c not in ("code", key)]
    peers = peer_medians(p, key, target, columns, ["code"]).select("code", *[F.col(c).alias(f"peer_{c}") for c in columns])
    ranks = percent_ranks(p, ["code", key], ["units_day"])
    own = p.where(F.col(key) == F.lit(target)).join(peers, "code", "left").join(ranks, ["code", key]).join(code_patterns(lines, key), ["code", key], "left")
    for c in CODE_RATIOS:
        own = own.withColumn(f"ratio_{c}", ratio(F.col(c), F.col(f"peer_{c}")))
    return own.orderBy(F.desc_nulls_last("ratio_units_day"), "code")


def code_patterns(lines: DataFrame, key: str) -> DataFrame:
    """By code and entity: share of days with a shared signature, share of members with repeated packages."""
    k = ["code", key]
    a, b = cookie_cutter(lines, k, k), repeat_packages(lines, k, k)
    j = a.join(b, k, "left")
    return j.select(*k, (F.col("dup_days") * F.lit(100.0) / F.col("days")).alias("pct_days_dup"), F.try_divide(F.coalesce("repeat_members", F.lit(0)) * F.lit(100.0), F.col("members")).alias("pct_members_repeat"))


def anomalous(report: DataFrame, cfg: Config) -> DataFrame:
    """Codes with a ratio of units, units a day or dollars above the limit; no peers count as 0."""
    over = lambda c: F.coalesce(F.col(f"ratio_{c}"), F.lit(0.0)) > cfg.anomalous_ratio
    return report.where(over("units") | over("units_day") | over("paid"))


def code_counterparty(lines: DataFrame, key: str) -> DataFrame:
    g = lines.groupBy(key, "code", OTHER[key]).agg(F.sum("qty").alias("units"), money("paid").alias("paid"), F.countDistinct("member_id").alias("members"), F.countDistinct("svc_dt").alias("days"), F.count("*").alias("lines"))
    return g.withColumn("units_day", F.try_divide("units", "days"))


def self_listing(lines: DataFrame, target: object) -> DataFrame:
    """The target biller's lines by whether it lists itself."""
    own = lines.where(F.col("billing_id") == F.lit(target))
    return own.groupBy(F.coalesce(F.col("billing_id") == F.col("servicing_id"), F.lit(False)).alias("lists_itself")).agg(F.count("*").alias("lines"), F.countDistinct("member_id").alias("members"), F.sum("qty").alias("units"), money("paid").alias("paid"), F.min("svc_dt").alias("first"), F.max("svc_dt").alias("last"))


def consolidated(table: DataFrame, key: str, target: object, columns: list[str]) -> DataFrame:
    """(metric, target, peer_median, ratio), a row a metric."""
    own = table.where(F.col(key) == F.lit(target)).unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "metric", "target")
    peers = peer_medians(table, key, target, columns).unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "metric", "peer_median")
    return peers.join(own, "metric", "left").select("metric", "target", "peer_median", ratio(F.col("target"), F.col("peer_median")).alias("ratio"))


def cohort_overview(lines: DataFrame, key: str, target: object) -> DataFrame:
    is_target: Column = F.col(key) == F.lit(target)
    return lines.agg(F.countDistinct(key).alias("entities"), F.count("*").alias("lines"), F.sum(is_target.cast("long")).alias("target_lines"), F.min("svc_dt").alias("first"), F.max("svc_dt").alias("last"))


def report(lines: DataFrame, key: str, target: object, cfg: Config) -> dict[str, DataFrame]:
    """The sheets of one window for one entity, by name."""
    d = daily(lines, [key])
    volume = reduce(lambda a, b: a.join(b, [key], "left"), [daily_volume(d, [key]), thresholds(d, [key], cfg), totals(lines, [key])])
    metrics = [c for c in volume.columns if c != key]
    codes = code_report(lines, key, target, cfg)
    own = lambda df: df.where(F.col(key) == F.lit(target))
    return {
        "Overall": consolidated(volume, key, target, metrics), "All_Codes": codes, "Anomalous": anomalous(codes, cfg), "Counterparties": own(counterparty_breakdown(lines, key)).orderBy(F.desc("paid"), OTHER[key]),
        "Counterparty_Daily": own(counterparty_daily(lines, key)), "By_Code": own(code_counterparty(lines, key)).orderBy("code", F.desc("units"), OTHER[key]), "Patterns": own(cookie_cutter(lines, [key], [key])),
        "Packages": own(repeat_packages(lines, [key], [key])),
    }


def all_windows(lines_in_windows: DataFrame, key: str, target: object, cfg: Config) -> dict[str, DataFrame]:
    """Sheets of every window, named with the window."""
    return {f"{name}_{w}": sheet for w, _ in cfg.windows for name, sheet in report(lines_in_windows.where(F.col("window") == w), key, target, cfg).items()}
