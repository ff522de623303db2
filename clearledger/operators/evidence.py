"""Explanations of the queue: names, statistics per rule, case leads, evidence cards and their checks.

All results are leads for human review and say so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..config import Config
from .scoring import ENTITY, in_queue_order

#: Our own wording; {n}, {members} and {peak} are filled in.
FINDINGS = {
    "R1": ("Billed hours beyond a day", "On {n} member-day(s) the billed time of one member passes 24 hours; the longest is {peak} hours."),
    "R2": ("Units beyond peers", "On {n} member-day(s) the units of one member lie above nearly all of the same category; the peak is {peak} units."),
    "R3": ("Trips without a visit", "{n} group(s) of transport lines have no other service of the member around that day."),
    "R4": ("Widely shared members", "{members} member(s) are billed by an unusual number of providers, up to {peak}. Complex care can explain this."),
    "R5": ("Costly facility encounters", "{n} outpatient encounter(s) stand out by amount or by stacked lines."),
    "R6": ("Repeated claims, unverified", "{n} service(s) appear on several claims. Adjustments and copies are not excluded; no dollars are counted."),
    "R7": ("Many lines in a day", "On {n} member-day(s) the number of lines lies above nearly all peers; the peak is {peak}."),
    "R8A": ("Many renderers per member", "{members} member(s) have unusually many rendering providers, up to {peak}."),
    "R8B": ("Rendering for many billers", "Renders under {peak} billing providers."),
    "R9": ("Also paid to others", "{n} service(s) were paid to this and to another biller. Only this provider's payments are counted; separate legs can explain this."),
    "R10": ("Unexpected role", "Claims of {members} member(s) show a role that the reference list does not expect."),
}
#: No lead may say these.
BANNED = ("committed fraud", "is fraudulent", "fraudulent provider", "is guilty", "medically unnecessary", "not medically necessary", "lack of medical necessity")
BASIS = "Basis: paid claims only. This is a lead for review and no finding of wrongdoing."


def provider_names(names: DataFrame) -> DataFrame:
    """names (entity_id, entity_type, name, ptype), a row a claim line -> most frequent name and type, ties by name and type, and other names."""
    c = names.where("entity_id <> -1").groupBy(*ENTITY, "name", "ptype").agg(F.count("*").alias("n"))
    first = F.row_number().over(W.partitionBy(*ENTITY).orderBy(F.desc("n"), F.col("name").asc_nulls_first(), F.col("ptype").asc_nulls_first()))
    ranked = c.withColumn("rk", first).withColumn("main", F.max(F.when(F.col("rk") == 1, F.col("name"))).over(W.partitionBy(*ENTITY)))
    other = F.array_join(F.array_sort(F.collect_set(F.when((F.col("rk") > 1) & (F.col("name") != F.col("main")), F.col("name")))), "; ")
    return ranked.groupBy(*ENTITY).agg(F.max(F.when(F.col("rk") == 1, F.col("name"))).alias("name"), F.max(F.when(F.col("rk") == 1, F.col("ptype"))).alias("ptype"), F.nullif(other, F.lit("")).alias("other_names"))


def rule_stats(hits: DataFrame) -> DataFrame:
    """Per entity and rule: occasions, members, peak, and the first five distinct keys by dollars.

    Five hits hold the first five keys, since the hits of a rule share no lines; they are ranked with a limit before the shuffle.
    """
    keys = [*ENTITY, "rule_id", "family"]
    first = F.slice("first_keys", 1, 5)
    order = W.partitionBy(*keys).orderBy(F.desc_nulls_last("hit_dollars"), F.concat_ws("|", first))
    top = hits.select(*keys, first.alias("first"), F.row_number().over(order).alias("rk")).where("rk <= 5")
    examples = top.groupBy(*keys).agg(F.slice(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("rk", "first"))), lambda x: x["first"]))), 1, 5).alias("example_keys"))
    counts = hits.groupBy(*keys).agg(
        F.count("*").alias("occasions"), F.countDistinct("member_id").alias("members"), F.max("metric").alias("peak"),
        F.sum(F.when(F.col("detail").isin("price", "price_and_stacked"), 1).otherwise(0)).alias("by_price"), F.sum(F.when(F.col("detail").isin("stacked", "price_and_stacked"), 1).otherwise(0)).alias("by_lines"),
        F.sum(F.when(F.col("detail").contains("one code alone"), 1).otherwise(0)).alias("single_code_days"),
    )
    return counts.join(examples, keys)


def _text(which: int) -> Column:
    out = F.lit("")
    for rule, pair in FINDINGS.items():
        out = F.when(F.col("rule_id") == rule, F.lit(pair[which])).otherwise(out)
    return out


def findings(hits: DataFrame) -> DataFrame:
    """(entity, rule_id, family, title, sentence)."""
    s = rule_stats(hits)
    body = _text(1)
    for mark, value in (("{n}", F.col("occasions").cast("string")), ("{members}", F.col("members").cast("string")), ("{peak}", F.format_string("%.0f", "peak"))):
        body = F.replace(body, F.lit(mark), value)
    more = F.when(F.col("rule_id") == "R5", F.format_string(" By amount: %d; by lines: %d.", "by_price", "by_lines")).when((F.col("rule_id") == "R1") & (F.col("single_code_days") > 0), F.format_string(" On %d of them one code alone passes the limit.", "single_code_days")).otherwise(F.lit(""))
    return s.select(*ENTITY, "rule_id", "family", _text(0).alias("title"), F.concat(body, more, F.lit(" Examples: "), F.array_join("example_keys", ", ")).alias("sentence"))


def wrapped(text: Column, width: int = 70) -> Column:
    """Line feeds at spaces, so that no line passes the width unless one word does."""
    return F.regexp_replace(text, rf"(.{{1,{width}}})(?: +|$)\n?", "$1\n")


def case_leads(queue: DataFrame, hits: DataFrame, names: DataFrame | None = None, only_corroborated: bool = True, label: str = "") -> DataFrame:
    """One lead per entity of the queue: (entity, tier_label, lead)."""
    q = queue.where("corroborated") if only_corroborated else queue
    q = q.join(names, ENTITY, "left") if names is not None else q.withColumn("name", F.lit(None).cast("string"))
    f = findings(hits).join(q.select(*ENTITY, F.split("families", ",").alias("counted")), ENTITY)
    tag = F.when(F.array_contains("counted", F.col("family")), F.lit("")).otherwise(F.lit(" (not independent)"))
    listed = f.groupBy(*ENTITY).agg(F.sort_array(F.collect_list(F.struct("rule_id", F.concat(F.col("title"), tag, F.lit(": "), F.col("sentence")).alias("s")))).alias("l"))
    numbered = F.array_join(F.transform("l", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["s"])), "\n")
    head = F.concat_ws(" ", F.lit(label), F.lit("Lead:"), F.col("entity_type"), F.lit("provider"), F.col("entity_id").cast("string"), F.col("name"), F.concat(F.lit("["), F.col("tier_label"), F.lit("]")))
    grounds = F.format_string("Grounds: %d independent kind(s) of pattern (%s), %d member(s), %d member-day(s).", "independent_families", "families", "members_flagged", "member_days_flagged")
    dollars = F.format_string("Dollars at risk: %.2f of %.2f paid.", "dollars_at_risk", "total_paid")
    lead = F.concat_ws("\n", F.trim(head), wrapped(grounds), dollars, numbered, F.lit("Next: request records of the example lines and compare with the schedule."), F.lit(BASIS))
    return q.join(listed, ENTITY).select(*ENTITY, "tier_label", "independent_families", "risk_score", lead.alias("lead")).drop("risk_score")


def queue_with_reasons(queue: DataFrame, hits: DataFrame, names: DataFrame | None = None, source: str = "claims") -> DataFrame:
    """The table to share: entity, names, tier, grounds, exposure, rules and titles of findings. Empty input gives a typed empty table."""
    q = queue.where("corroborated")
    if names is None:
        for c in ("name", "other_names", "ptype"):
            q = q.withColumn(c, F.lit(None).cast("string"))
    else:
        q = q.join(names, ENTITY, "left")
    titles = findings(hits).groupBy(*ENTITY).agg(F.array_join(F.array_sort(F.collect_set("title")), "; ").alias("findings"), F.array_join(F.array_sort(F.collect_set("rule_id")), ", ").alias("rule_codes"))
    out = in_queue_order(q.join(titles, ENTITY, "left"))
    return out.select(
        F.lit(source).alias("data_source"), *ENTITY, "name", "other_names", "ptype", "tier_label", "independent_families", F.col("families").alias("grounds"), "members_flagged", "member_days_flagged", "dollars_at_risk",
        "pct_dollars_at_risk", "total_paid", "last_svc_dt", "days_before_data_end", "data_end_date", "rule_codes", "findings",
    )


def check_leads(leads: DataFrame, queue: DataFrame, table: DataFrame) -> DataFrame:
    """(check, violations): same entities everywhere, shares within 1, and no banned phrase."""
    q = queue.where("corroborated").select(*ENTITY)
    apart = lambda a, b: a.select(*ENTITY).exceptAll(b.select(*ENTITY)).unionAll(b.select(*ENTITY).exceptAll(a.select(*ENTITY)))
    count = lambda df, name: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
    banned = F.lower("lead").rlike("|".join(BANNED))
    return count(apart(leads, q), "leads match the queue").unionByName(count(apart(table, q), "the table matches the queue")).unionByName(count(table.where("pct_dollars_at_risk > 1.000000001"), "shares are within 1")).unionByName(count(leads.where(banned), "no banned phrase"))


def evidence_cards(queue: DataFrame, hits: DataFrame, cfg: Config) -> DataFrame:
    """The first cards of the queue, each with its ten largest hits and five example keys of each."""
    top = in_queue_order(queue.where("corroborated")).limit(cfg.cards)
    order = W.partitionBy(*ENTITY).orderBy(F.desc("hit_dollars"), "rule_id", F.col("member_id").asc_nulls_first(), "evidence_keys")
    best = hits.join(F.broadcast(top.select(*ENTITY)), ENTITY, "left_semi").withColumn("rk", F.row_number().over(order)).where("rk <= 10")
    item = F.struct("rk", "rule_id", "family", "title", "tier", "member_id", "cos", "hit_dollars", F.slice(F.split("evidence_keys", r"\|"), 1, 5).alias("example_keys"))
    packed = best.groupBy(*ENTITY).agg(F.sort_array(F.collect_list(item)).alias("findings"))
    keep = ["tier_label", "independent_families", "families", "rules", "members_flagged", "total_paid", "dollars_at_risk", "pct_dollars_at_risk"]
    return top.select(*ENTITY, *keep).join(packed, ENTITY, "left").withColumn("card", F.to_json(F.struct(*ENTITY, *keep, "findings"))).drop("findings")
