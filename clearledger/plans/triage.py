"""The triage run from claims to queue, leads and graph, as one lazy plan with two written tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..config import Config
from ..functions.scratch import materialise
from ..operators import evidence, graph, rules, scoring
from ..operators.prep import prep, restrict_to_detection


@dataclass
class Triage:
    paid: DataFrame
    hits: DataFrame
    queue: DataFrame
    lines: DataFrame
    pairs: DataFrame
    leads: DataFrame
    reasons: DataFrame
    cards: DataFrame


def triage(claims: DataFrame, cfg: Config, roles: DataFrame | None = None, names: DataFrame | None = None, strict: bool = True) -> Triage:
    """Prepared claims and hits are written once, since every later part reads them; invariants are checked if strict."""
    paid = materialise(prep(claims, cfg), "paid")
    what = rules.run_rules(paid, cfg, roles=roles)
    hits = materialise(restrict_to_detection(what.hits, paid), "hits")
    what = rules.Found(hits, what.lines)
    q = materialise(scoring.queue(what, paid, cfg), "queue")
    if strict:
        scoring.check(q, what, paid, cfg)
    return Triage(
        paid, hits, scoring.in_queue_order(q), scoring.flagged_lines(what, paid), graph.biller_pairs(paid, cfg), evidence.case_leads(q, hits, names), evidence.queue_with_reasons(q, hits, names), evidence.evidence_cards(q, hits, cfg)
    )
