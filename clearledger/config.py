"""Settings of all jobs: thresholds, windows, families and dates. Nothing reads the clock."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

#: Rules that flag the same claims share a family.
FAMILIES = {
    "R1": "intensity",
    "R2": "intensity",
    "R3": "transport",
    "R4": "member_brokering",
    "R5": "facility_pricing",
    "R6": "duplicate_payment",
    "R7": "intensity",
    "R8A": "provider_identity",
    "R8B": "provider_identity",
    "R9": "duplicate_payment",
    "R10": "role",
}


@dataclass(frozen=True)
class Config:
    as_of: date = date(2001, 12, 31)
    paid_status: str = "A"
    anchor: str = "data_max"  # or "as_of"
    window_months: int = 24
    context_months: int | None = None
    exact_percentiles: bool = True
    accuracy: int = 10_000
    # rules
    max_minutes_per_day: int = 1440
    units_pctile: float = 0.995
    units_floor: float = 2
    transport: tuple[str, ...] = ("NON-EMERGENCY TRANSPORTATION", "EMERGENCY TRANSPORTATION")
    not_anchoring: tuple[str, ...] = ("PHARMACY",)
    anchor_days: int = 1
    phantom_max_base_rate: float = 0.25
    fanout_pctile: float = 0.995
    fanout_min_hot_members: int = 2
    facility: str = "OUT-PATIENT FACILITY FEES"
    z_facility: float = 8.0
    facility_lines_pctile: float = 0.995
    facility_min_lines: float = 3
    duplicate_key_has_amount: bool = True
    volume_pctile: float = 0.995
    renderers_pctile: float = 0.995
    renderers_floor: float = 5
    billers_pctile: float = 0.995
    billers_floor: float = 3
    excluded_lobs: tuple[str, ...] = ("MSP",)
    match_units: bool = True
    # scoring
    tier_weights: tuple[tuple[int, float], ...] = ((1, 3.0), (2, 2.0), (3, 1.0))
    untrusted: tuple[str, ...] = ("R6",)
    overlap_max: float = 0.5
    min_families: int = 2
    min_members: int = 2
    strong_families: int = 3
    corroboration_factor: float = 1.3
    evidence_keys: int = 20
    rules_at_once: int = 4
    cards: int = 15
    # graph
    pmi_min: float = 2.0
    shared_min: int = 3
    panel_min: int = 20
    # screen
    unit_minutes: tuple[tuple[str, int], ...] = ()
    group_modifiers: tuple[str, ...] = ("HQ",)
    cap_hours: int = 12
    windows: tuple[tuple[str, int | None], ...] = (("Full", None), ("1Y", 12), ("6M", 6))
    min_active_days: tuple[tuple[str, int], ...] = (("Full", 20), ("1Y", 12), ("6M", 8))
    recovery_months: int | None = None
    signature_pctile: float = 0.90
    flag_pctile: float = 0.95
    min_flags: int = 3
    min_signature_match: float = 0.6
    min_impossible_days: int = 2
    min_other_share: float = 0.5
    min_units_ratio: float = 5.0
    thresholds: tuple[int, ...] = (4, 8, 12, 16, 20, 24)
    anomalous_ratio: float = 2.0
    reference_servicing: str | int | None = None
    reference_billing: str | int | None = None
    families: dict[str, str] = field(default_factory=lambda: dict(FAMILIES))


#: Tuned for the uniform test tables, on which the production values find almost nothing.
FIXTURE = Config(
    phantom_max_base_rate=1.0, z_facility=1.2, facility_min_lines=1, match_units=False, duplicate_key_has_amount=False,
    billers_floor=1, billers_pctile=0.9, facility="PROMO", transport=("MEDIUM",), not_anchoring=("SMALL",),
    pmi_min=0.0, panel_min=5, unit_minutes=tuple((f"BRAND#{i}", 15) for i in range(1, 10)),
    min_active_days=(("Full", 20), ("1Y", 8), ("6M", 4)), reference_servicing=7, reference_billing=3, recovery_months=24,
)
