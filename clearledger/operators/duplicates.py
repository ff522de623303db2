"""Services paid to more than one biller, and providers that list themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.expressions import lob_allowed, money
from ..functions.pairs import pairs

SERVICE = ["member_id", "code", "svc_dt"]


def duplicate_scope(claims: DataFrame, cohort_lines: DataFrame) -> DataFrame:
    """All lines, of any provider, that share a service with the cohort."""
    return claims.join(cohort_lines.select(*SERVICE).distinct(), SERVICE, "left_semi")


def role_scope(claims: DataFrame, cohort_lines: DataFrame) -> DataFrame:
    """All lines of the cohort's billers."""
    return claims.join(cohort_lines.select("billing_id").distinct(), "billing_id", "left_semi")


def by_biller(scope: DataFrame, cfg: Config) -> DataFrame:
    """Paid lines of each service and biller."""
    known = scope.where("paid > 0")
    if "lob" in scope.columns:
        known = known.where(lob_allowed(F.col("lob"), cfg.excluded_lobs))
    return known.groupBy(*SERVICE, "billing_id").agg(money("paid").alias("paid"), F.sum("qty").alias("units"), F.count("*").alias("lines"), F.array_sort(F.collect_set("servicing_id")).alias("servicers"))


def duplicate_groups(per_biller: DataFrame) -> DataFrame:
    """Services paid to two billers or more; all but the largest payment may be duplicate."""
    g = per_biller.groupBy(*SERVICE).agg(
        F.count("*").alias("n_billers"), F.array_sort(F.collect_list("billing_id")).alias("billers"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("servicers")))).alias("servicers"),
        F.countDistinct("units").alias("unit_values"), money("paid").alias("paid_total"), (F.sum(F.col("paid").cast("decimal(18,2)")) - F.max(F.col("paid").cast("decimal(18,2)"))).cast("double").alias("possible_duplicate_paid"), F.sum("lines").alias("lines"),
    )
    return g.where("n_billers >= 2").withColumn("same_units", F.col("unit_values") == 1)


def duplicate_pairs(per_biller: DataFrame, groups: DataFrame) -> DataFrame:
    """By pair of billers: services, those with equal units, members, and the lesser and both payments, most dollars first.

    A service that very many billers were paid for is paired block by block (functions/pairs.py).
    """
    own = per_biller.join(groups.select(*SERVICE, "same_units"), SERVICE)
    met = pairs(own, SERVICE, "billing_id", ["paid", "same_units"])
    sums = met.groupBy(F.col("a.billing_id").alias("biller_a"), F.col("b.billing_id").alias("biller_b")).agg(
        F.count("*").alias("services"), F.sum(F.col("a.same_units").cast("long")).alias("services_same_units"), F.countDistinct("member_id").alias("members"), money(F.least("a.paid", "b.paid")).alias("possible_duplicate_paid"),
        money(F.col("a.paid").cast("decimal(18,2)") + F.col("b.paid").cast("decimal(18,2)")).alias("paid_by_both"),
    )
    return sums.orderBy(F.desc("possible_duplicate_paid"), "biller_a", "biller_b")


def duplicate_involvement(groups: DataFrame) -> DataFrame:
    """By provider, as biller or servicer: services and dollars."""
    each = groups.select(F.explode(F.array_distinct(F.concat("billers", "servicers"))).alias("provider"), "possible_duplicate_paid")
    return each.groupBy("provider").agg(F.count("*").alias("services"), money("possible_duplicate_paid").alias("possible_duplicate_paid"))


def between(groups: DataFrame, biller: Column, clinician: Column) -> DataFrame:
    """Groups that hold both a given biller and a given clinician."""
    return groups.where(F.array_contains("billers", biller) & (F.array_contains("billers", clinician) | F.array_contains("servicers", clinician)))


def largest(groups: DataFrame, rows: int = 50_000) -> DataFrame:
    """The largest groups by dollars: a report's limit."""
    return groups.orderBy(F.desc("possible_duplicate_paid"), *SERVICE).limit(rows)


def self_listed(scope: DataFrame) -> DataFrame:
    """Billers that bill for others and also list themselves as the servicer: lines, dollars and percentages."""
    own = F.col("billing_id") == F.col("servicing_id")
    g = scope.groupBy("billing_id").agg(
        F.count("*").alias("lines"), F.sum(F.when(own, 1).otherwise(0)).cast("long").alias("self_lines"), money("paid").alias("paid"), F.coalesce(money(F.when(own, F.col("paid"))), F.lit(0.0)).alias("self_paid")
    )
    g = g.where("self_lines > 0 and self_lines < lines")
    return g.withColumn("pct_self_lines", F.try_divide(F.col("self_lines") * F.lit(100.0), F.col("lines"))).orderBy(F.desc("lines"), "billing_id")


def target_duplicates(claims: DataFrame, target_lines: DataFrame, cfg: Config) -> DataFrame:
    """Duplicate groups among all lines that share a service with one provider."""
    return duplicate_groups(by_biller(duplicate_scope(claims, target_lines), cfg))
