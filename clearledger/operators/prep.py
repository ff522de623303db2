"""Preparation of claims: the paid lines of a window, and nested windows as a column."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.expressions import in_group
from ..functions.scratch import materialise


def anchored(df: DataFrame, cfg: Config, day: str = "svc_dt") -> DataFrame:
    """df with _anchor: the last day in the data, or the given one. One row is joined to all."""
    if cfg.anchor == "as_of":
        return df.withColumn("_anchor", F.lit(cfg.as_of))
    return df.crossJoin(F.broadcast(df.agg(F.max(day).alias("_anchor"))))  # one row


def last_day(df: DataFrame, until: date, day: str = "svc_dt") -> date | None:
    """The last day of df, whose days are not after `until`: looked for in the months before it first, so that few rows are joined to find it."""
    for months in (3, 24):
        if found := df.where(F.col(day) > F.add_months(F.lit(until), -months)).agg(F.max(day)).first()[0]:
            return found
    return df.agg(F.max(day)).first()[0]


def prep(claims: DataFrame, cfg: Config) -> DataFrame:
    """Paid lines with a service date not after as_of, in the window before the anchor; null money and quantity become 0.

    Adds member_day and in_detection_window; with context_months, older lines of that longer window stay too. The anchor is read first and is a constant
    of the plan, so the window holds where the lines are read, before they are joined to anything.
    """
    known = (
        claims.where((F.col("status") == cfg.paid_status) & F.col("svc_dt").isNotNull() & (F.col("svc_dt") <= F.lit(cfg.as_of)))
        .withColumn("paid", F.coalesce(F.col("paid").cast("double"), F.lit(0.0)))
        .withColumn("qty", F.coalesce(F.col("qty").cast("double"), F.lit(0.0)))
    )
    anchor = F.lit(cfg.as_of if cfg.anchor == "as_of" else last_day(known, cfg.as_of)).cast("date")
    start = F.add_months(anchor, -cfg.window_months)
    first = F.add_months(anchor, -cfg.context_months) if cfg.context_months else start
    kept = known.where(F.col("svc_dt") >= first).withColumn("in_detection_window", F.col("svc_dt") >= start)
    return kept.withColumn("member_day", F.concat_ws("|", "member_id", "svc_dt"))


def active_entities(paid: DataFrame) -> DataFrame:
    """(entity_id, entity_type) of all billers and servicers in the detection window."""
    recent = paid.where("in_detection_window")
    billing = recent.select(F.col("billing_id").alias("entity_id"), F.lit("billing").alias("entity_type"))
    return billing.unionByName(recent.select(F.col("servicing_id").alias("entity_id"), F.lit("servicing").alias("entity_type"))).distinct()


def restrict_to_detection(hits: DataFrame, paid: DataFrame) -> DataFrame:
    """Hits of entities that are active in the detection window in the role they were flagged in."""
    return hits.join(materialise(active_entities(paid), "active"), ["entity_id", "entity_type"], "left_semi")


def service_lines(claims: DataFrame, cfg: Config) -> DataFrame:
    """Lines as the screen and the reports use them: signature, timed minutes, channel and month."""
    mods = [F.col(f"mod{i}") for i in range(1, 5) if f"mod{i}" in claims.columns]
    code = F.upper(F.trim("code"))
    minutes = F.create_map(*[F.lit(x) for kv in cfg.unit_minutes for x in kv])[F.col("code")] if cfg.unit_minutes else F.lit(None).cast("int")
    single = F.coalesce("svc_end", "svc_dt") == F.col("svc_dt") if "svc_end" in claims.columns else F.lit(True)
    d = claims.withColumn("code", code).withColumn("signature", F.concat_ws("|", F.col("code"), *[F.coalesce(m, F.lit("")) for m in mods], F.col("qty").cast("string")))
    d = d.withColumn("is_timed", minutes.isNotNull() & ~in_group(mods, cfg.group_modifiers) & single)
    d = d.withColumn("minutes", F.when(F.col("is_timed"), F.col("qty") * minutes).otherwise(0.0)).withColumn("month", F.trunc("svc_dt", "month"))
    return d.withColumn("channel", F.when(F.col("billing_id") == F.col("servicing_id"), "self").otherwise("other"))


def in_windows(df: DataFrame, cfg: Config, day: str = "svc_dt", anchor: DataFrame | None = None) -> DataFrame:
    """Each row once for every window that holds it, named in `window`: all windows in one pass.

    anchor: one row with _anchor; without it the last day of df.
    """
    a = df.crossJoin(F.broadcast(anchor)) if anchor is not None else anchored(df, cfg, day)
    names = [F.when(F.lit(True) if months is None else F.col(day) >= F.add_months("_anchor", -months), F.lit(label)) for label, months in cfg.windows]
    return a.withColumn("window", F.explode(F.filter(F.array(*names), lambda x: x.isNotNull()))).drop("_anchor")


def with_level(df: DataFrame, cfg: Config, day: str = "svc_dt", anchor: DataFrame | None = None) -> DataFrame:
    """df with _level: in how many of the nested windows the row's day lies, 1 for the widest alone. Rows in none are left out.

    All windows end at the anchor, so a row lies in a window and in every wider one: what holds of the latest day holds of every window that the day
    is in. Aggregates take the level as a key, or the highest level of a member, and spread() turns the few results into windows.
    """
    a = df.crossJoin(F.broadcast(anchor)) if anchor is not None else anchored(df, cfg, day)
    inside = [F.lit(1) if months is None else (F.col(day) >= F.add_months("_anchor", -months)).cast("int") for _, months in cfg.windows]
    return a.withColumn("_level", reduce(lambda x, y: x + y, inside)).where("_level > 0").drop("_anchor")


def spread(df: DataFrame, cfg: Config) -> DataFrame:
    """Aggregated rows with _level, once for each window that holds them, named in `window`."""
    widest = sorted(cfg.windows, key=lambda w: (w[1] is not None, -(w[1] or 0)))
    return df.withColumn("window", F.explode(F.slice(F.array(*[F.lit(label) for label, _ in widest]), F.lit(1), F.col("_level")))).drop("_level")


def last_months(df: DataFrame, months: int | None, cfg: Config, day: str = "svc_dt") -> DataFrame:
    """Rows of one look-back window; None keeps all."""
    return df if months is None else anchored(df, cfg, day).where(F.col(day) >= F.add_months("_anchor", -months)).drop("_anchor")
