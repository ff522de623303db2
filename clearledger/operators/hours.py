"""Clinician-days and the exposure of lines on days that are too long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.expressions import money


def _part_over(minutes: Column, limit: int) -> Column:
    return F.when(minutes > limit, (minutes - limit) / minutes).otherwise(0.0)


def clinician_days(lines: DataFrame, cfg: Config) -> DataFrame:
    """(servicing_id, svc_dt): minutes, members, minutes billed by others, hours, and the parts over 24 hours and over the cap."""
    other = F.when(F.col("channel") == "other", F.col("minutes")).otherwise(0.0)
    g = lines.groupBy("servicing_id", "svc_dt").agg(F.sum("minutes").alias("minutes"), F.countDistinct("member_id").alias("members"), F.sum(other).alias("other_minutes"))
    m = F.col("minutes")
    return g.withColumn("hours", m / 60).withColumn("r24", _part_over(m, 1440)).withColumn("rcap", _part_over(m, cfg.cap_hours * 60))


def line_exposure(lines: DataFrame, days: DataFrame) -> DataFrame:
    """Timed lines with their dollars over 24 hours, over the cap, and on capped days."""
    r = days.select("servicing_id", "svc_dt", "r24", "rcap")
    return lines.where("is_timed").join(r, ["servicing_id", "svc_dt"]).select(
        "servicing_id", "billing_id", "svc_dt", "paid", (F.col("paid") * F.col("r24")).alias("over24"), (F.col("paid") * F.col("rcap")).alias("overcap"), F.when(F.col("rcap") > 0, F.col("paid")).otherwise(0.0).alias("on_cap_days")
    )


def exposure_by(exposed: DataFrame, keys: list[str]) -> DataFrame:
    """timed_paid, paid_on_cap_days, tier2 (over the cap) and tier1 (over 24 hours) by keys."""
    part = lambda c: F.sum(F.col(c).cast("decimal(24,6)")).cast("double")
    return exposed.groupBy(*keys).agg(money("paid").alias("timed_paid"), money("on_cap_days").alias("paid_on_cap_days"), part("overcap").alias("tier2"), part("over24").alias("tier1"))
