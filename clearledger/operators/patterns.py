"""Repetitive billing: same signatures, repeated day packages, session lengths, leading codes, and the absolute pattern test."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..config import Config
from ..functions.expressions import money
from .prep import spread

FULL, CLOSE, IMPOSSIBLE = "Full", "Close", "Impossible only"


def cookie_cutter(lines: DataFrame, keys: list[str], unit: list[str]) -> DataFrame:
    """By keys: days, days with one signature for two members or more, members, members in such patterns.

    unit names what a day belongs to: for billers (biller, clinician), so that many clinicians are no pattern.
    One aggregate per day and signature, one per day, one per member; a member's rows are never collected.
    """
    day = [*unit, "svc_dt"]
    per = lines.groupBy(*day, "signature", "member_id").agg(F.lit(1).alias("one"))
    sized = per.join(per.groupBy(*day, "signature").agg(F.count("*").alias("size")), [*day, "signature"])
    days = sized.groupBy(*day).agg(F.max("size").alias("most")).groupBy(*keys).agg(F.count("*").alias("days"), F.sum((F.col("most") >= 2).cast("long")).alias("dup_days"))
    members = sized.groupBy(*keys, "member_id").agg(F.max("size").alias("most")).groupBy(*keys).agg(F.count("member_id").alias("members"), F.sum(((F.col("most") >= 2) & F.col("member_id").isNotNull()).cast("long")).alias("dup_members"))
    return days.join(members, keys)


def pattern_sizes(lines: DataFrame, keys: list[str], unit: list[str]) -> DataFrame:
    """By keys: number of patterns, their average and largest number of members."""
    dup = lines.groupBy(*dict.fromkeys([*keys, *unit]), "svc_dt", "signature").agg(F.countDistinct("member_id").alias("n")).where("n >= 2")
    return dup.groupBy(*keys).agg(F.count("*").alias("patterns"), F.avg("n").alias("avg_members"), F.max("n").alias("max_members"))


def repeat_packages(lines: DataFrame, keys: list[str], unit: list[str]) -> DataFrame:
    """By keys: members whose whole day of signatures comes back on another day; average and most repeats."""
    held = list(dict.fromkeys([*keys, *unit]))
    package = lines.groupBy(*held, "member_id", "svc_dt").agg(F.sort_array(F.collect_list("signature")).alias("p"))
    again = package.groupBy(*held, "member_id", F.md5(F.array_join("p", "\n").cast("binary")).alias("p")).agg(F.count("*").alias("n")).where("n > 1")
    return again.groupBy(*keys).agg(F.countDistinct("member_id").alias("repeat_members"), F.avg("n").alias("avg_repeats"), F.max("n").alias("max_repeats"))


def session_hours(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Average timed hours of a member-day that has any."""
    s = lines.groupBy(*keys, "member_id", "svc_dt").agg(F.sum("minutes").alias("m")).where("m > 0")
    return s.groupBy(*keys).agg((F.avg("m") / 60).alias("avg_session_hours"))


def top_code(lines: DataFrame, keys: list[str]) -> DataFrame:
    """The code with the most dollars, ties by code, and its percentage of all."""
    c = lines.groupBy(*keys, "code").agg(money("paid").alias("p"))
    w = W.partitionBy(*keys)
    ranked = c.withColumn("total", F.sum("p").over(w)).withColumn("rk", F.row_number().over(w.orderBy(F.desc("p"), "code"))).where("rk = 1")
    return ranked.select(*keys, F.col("code").alias("top_code"), (F.try_divide("p", "total") * 100).alias("top_code_share"))


def pattern_features(lines: DataFrame, keys: list[str], unit: list[str]) -> DataFrame:
    """The five pattern measures by keys; those without any pattern have 0, without timed sessions null."""
    parts = [cookie_cutter(lines, keys, unit), repeat_packages(lines, keys, unit).select(*keys, "repeat_members"), session_hours(lines, keys), top_code(lines, keys)]
    j = reduce(lambda a, b: a.join(b, keys, "left"), parts)
    pct = lambda a, b: F.try_divide(F.coalesce(F.col(a), F.lit(0)) * F.lit(100.0), F.col(b))
    return j.select(*keys, pct("dup_days", "days").alias("pct_days_dup_pattern"), pct("dup_members", "members").alias("pct_members_in_dup"), pct("repeat_members", "members").alias("pct_members_repeat_pkg"), "avg_session_hours", "top_code", "top_code_share")


def nested_features(lines: DataFrame, key: str, unit: list[str], cfg: Config) -> DataFrame:
    """pattern_features of every window at once, from lines with _level (see prep.with_level): each line is read once.

    A day's patterns are the same in every window that holds the day; a member is in a pattern, or repeats a package, in the windows that hold the
    latest such day (of a package: the latest but one), so the highest level decides. Money and minutes are added up by level.
    """
    day = [*unit, "svc_dt"]
    k = ["window", key]
    per = lines.groupBy(*day, "signature", "member_id").agg(F.max("_level").alias("_level"))
    sized = per.join(per.groupBy(*day, "signature").agg(F.count("*").alias("size")), [*day, "signature"])
    dup = F.col("size") >= 2
    days = sized.groupBy(*day).agg(F.max("_level").alias("_level"), F.max(dup).alias("dup")).groupBy(key, "_level").agg(F.count("*").alias("days"), F.sum(F.col("dup").cast("long")).alias("dup_days"))
    days = spread(days, cfg).groupBy(*k).agg(F.sum("days").alias("days"), F.sum("dup_days").alias("dup_days"))
    latest = sized.where("member_id is not null").groupBy(key, "member_id").agg(F.max("_level").alias("_level"), F.coalesce(F.max(F.when(dup, F.col("_level"))), F.lit(0)).alias("_dup"))
    held = list(dict.fromkeys([key, *unit]))
    package = lines.groupBy(*held, "member_id", "svc_dt").agg(F.max("_level").alias("_level"), F.md5(F.array_join(F.sort_array(F.collect_list("signature")), "\n").cast("binary")).alias("p"))
    two = F.row_number().over(W.partitionBy(*held, "member_id", "p").orderBy(F.desc("svc_dt")))
    again = package.withColumn("_rk", two).where("_rk <= 2").where("_rk = 2").where("member_id is not null").groupBy(key, "member_id").agg(F.max("_level").alias("_again"))
    seen = latest.join(again, [key, "member_id"], "left").select(key, F.explode(F.array(*[F.struct(F.lit(what).alias("what"), level.alias("_level")) for what, level in (("members", F.col("_level")), ("dup", F.col("_dup")), ("again", F.coalesce("_again", F.lit(0))))])).alias("e"))
    counts = seen.select(key, "e.*").where("_level > 0").groupBy(key, "what", "_level").agg(F.count("*").alias("n"))
    of = lambda what: F.coalesce(F.sum(F.when(F.col("what") == what, F.col("n"))), F.lit(0))
    members = spread(counts, cfg).groupBy(*k).agg(of("members").alias("members"), of("dup").alias("dup_members"), of("again").alias("repeat_members"))
    session = lines.groupBy(key, "member_id", "svc_dt").agg(F.max("_level").alias("_level"), F.sum("minutes").alias("m")).where("m > 0").groupBy(key, "_level").agg(F.sum("m").alias("m"), F.count("*").alias("n"))
    session = spread(session, cfg).groupBy(*k).agg((F.sum("m") / F.sum("n") / 60).alias("avg_session_hours"))
    code = spread(lines.groupBy(key, "code", "_level").agg(F.sum(F.col("paid").cast("decimal(18,2)")).alias("p")), cfg).groupBy(*k, "code").agg(F.sum("p").cast("double").alias("p"))
    w = W.partitionBy(*k)
    top = code.withColumn("total", F.sum("p").over(w)).withColumn("rk", F.row_number().over(w.orderBy(F.desc("p"), "code"))).where("rk = 1")
    top = top.select(*k, F.col("code").alias("top_code"), (F.try_divide("p", "total") * 100).alias("top_code_share"))
    j = days.join(members, k, "left").join(session, k, "left").join(top, k, "left")
    pct = lambda a, b: F.try_divide(F.coalesce(F.col(a), F.lit(0)) * F.lit(100.0), F.col(b))
    return j.select(*k, pct("dup_days", "days").alias("pct_days_dup_pattern"), pct("dup_members", "members").alias("pct_members_in_dup"), pct("repeat_members", "members").alias("pct_members_repeat_pkg"), "avg_session_hours", "top_code", "top_code_share")


def pattern_table(lines: DataFrame, days: DataFrame, cfg: Config) -> DataFrame:
    """One row per clinician: days over 24 hours, own and others' billing, and the label, empty if none fits (see _labelled)."""
    k = ["servicing_id"]
    own, other = F.col("channel") == "self", F.col("channel") == "other"
    when = lambda c, v: F.when(c, F.col(v))
    long = F.col("minutes") > 1440
    d = days.groupBy(*k).agg(F.sum(long.cast("long")).alias("days_over_24h"), F.sum((long & (F.col("other_minutes") > 0)).cast("long")).alias("days_over_24h_with_other"))
    timed = lambda c: c & F.col("is_timed")
    c = lines.groupBy(*k).agg(
        F.coalesce(money(when(own, "paid")), F.lit(0.0)).alias("self_paid"), F.coalesce(money(when(other, "paid")), F.lit(0.0)).alias("other_paid"), F.sum(own.cast("long")).alias("self_lines"), F.sum(other.cast("long")).alias("other_lines"),
        F.countDistinct(when(other, "billing_id")).alias("n_other_billers"), F.coalesce(F.sum(when(timed(own), "qty")), F.lit(0.0)).alias("self_units"), F.countDistinct(when(timed(own), "svc_dt")).alias("self_days"),
        F.coalesce(F.sum(when(timed(other), "qty")), F.lit(0.0)).alias("other_units"), F.countDistinct(when(timed(other), "svc_dt")).alias("other_days"),
    )
    o = lines.where(other).groupBy(*k, "billing_id").agg(money("paid").alias("p"))
    top = o.withColumn("rk", F.row_number().over(W.partitionBy(*k).orderBy(F.desc("p"), "billing_id"))).where("rk = 1").select(*k, F.col("billing_id").alias("top_other_biller"))
    return _labelled(c.join(d, k, "left").join(top, k, "left"), cfg)


def nested_pattern_table(lines: DataFrame, days: DataFrame, cfg: Config) -> DataFrame:
    """pattern_table of every window at once, from lines and days with _level (see prep.with_level): lines are read and shuffled once.

    Lines become sums by clinician, biller and day, whose rows are added up by level; a biller counts in the windows that hold its latest day.
    """
    k = ["window", "servicing_id"]
    own, other = F.col("channel") == "self", F.col("channel") == "other"
    long = F.col("minutes") > 1440
    total = lambda c, v: F.sum(F.when(c, F.col(v)))
    per = lines.groupBy("servicing_id", "billing_id", "channel", "svc_dt", "_level").agg(
        F.sum(F.col("paid").cast("decimal(18,2)")).alias("p"), F.count("*").alias("n"), total(F.col("is_timed"), "qty").alias("u"), F.max("is_timed").alias("timed"),
    )
    by_day = per.groupBy("servicing_id", "svc_dt", "_level").agg(
        *[total(c, v).alias(f"{who}_{name}") for who, c in (("self", own), ("other", other)) for v, name in (("p", "paid"), ("n", "lines"), ("u", "units"))],
        F.max((own & F.col("timed")).cast("long")).alias("self_days"), F.max((other & F.col("timed")).cast("long")).alias("other_days"),
    )
    sums = [c for c in by_day.columns if c not in ("servicing_id", "svc_dt", "_level")]
    c = spread(by_day.groupBy("servicing_id", "_level").agg(*[F.sum(x).alias(x) for x in sums]), cfg)
    kind = lambda x: "double" if x.endswith(("paid", "units")) else "long"
    c = c.groupBy(*k).agg(*[F.coalesce(F.sum(x), F.lit(0)).cast(kind(x)).alias(x) for x in sums])
    latest = per.where(other & F.col("billing_id").isNotNull()).groupBy("servicing_id", "billing_id").agg(F.max("_level").alias("_level"))
    billers = spread(latest.groupBy("servicing_id", "_level").agg(F.count("*").alias("n")), cfg).groupBy(*k).agg(F.sum("n").alias("n_other_billers"))
    d = spread(days.groupBy("servicing_id", "_level").agg(F.sum(long.cast("long")).alias("a"), F.sum((long & (F.col("other_minutes") > 0)).cast("long")).alias("b")), cfg)
    d = d.groupBy(*k).agg(F.sum("a").alias("days_over_24h"), F.sum("b").alias("days_over_24h_with_other"))
    o = spread(per.where(other).groupBy("servicing_id", "billing_id", "_level").agg(F.sum("p").alias("p")), cfg).groupBy(*k, "billing_id").agg(F.sum("p").cast("double").alias("p"))
    top = o.withColumn("rk", F.row_number().over(W.partitionBy(*k).orderBy(F.desc("p"), "billing_id"))).where("rk = 1").select(*k, F.col("billing_id").alias("top_other_biller"))
    return _labelled(c.join(billers, k, "left").join(d, k, "left").join(top, k, "left").na.fill(0, ["n_other_billers"]), cfg)


def _labelled(t: DataFrame, cfg: Config) -> DataFrame:
    """Shares, averages and the label from sums by clinician.

    Where others bill but the clinician does not, the units ratio is open and others carry the case; where neither has timed
    days it is not.
    """
    t = t.na.fill(0, ["days_over_24h", "days_over_24h_with_other"])
    t = t.withColumn("other_share", F.when(F.col("self_paid") + F.col("other_paid") > 0, F.try_divide(F.col("other_paid"), F.col("self_paid") + F.col("other_paid"))))
    per = lambda units, n: F.when(F.col(n) > 0, F.try_divide(units, n))
    t = t.withColumn("self_units_per_day", per("self_units", "self_days")).withColumn("other_units_per_day", per("other_units", "other_days")).withColumn("units_ratio", F.try_divide("other_units_per_day", "self_units_per_day"))
    # an own average of 0 makes any other average infinitely larger
    steep = F.coalesce(F.when((F.col("self_units_per_day") == 0) & (F.col("other_units_per_day") > 0), F.lit(True)).otherwise(F.col("units_ratio") >= cfg.min_units_ratio), F.lit(False))
    driven = F.coalesce(F.col("other_share") >= cfg.min_other_share, F.lit(False)) & ((F.col("self_lines") == 0) | steep)
    with_other, any_ = F.col("days_over_24h_with_other") >= cfg.min_impossible_days, F.col("days_over_24h") >= cfg.min_impossible_days
    both = (F.col("self_lines") > 0) & (F.col("other_lines") > 0)
    return t.withColumn("pattern", F.when(with_other & both & driven, FULL).when(with_other & driven, CLOSE).when(any_, IMPOSSIBLE).otherwise(""))
