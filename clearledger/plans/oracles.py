"""The registered claims queries as SQL for a single-machine database, over the same tables."""

from __future__ import annotations

from ..operators.evidence import BANNED, BASIS, FINDINGS  # fixed texts


def _claims(dense: bool) -> str:
    member, biller, unit = ("o_custkey % 60", "l_suppkey % 25", "month") if dense else ("o_custkey", "l_suppkey", "week")
    texts = "'CARE, PER 15 MINUTES', 'Care, each 15 minutes', 'AIDE, UP TO 15 MINUTES', 'HABILITATION, PER HOUR', 'VISIT', 'OBSERVATION 24 HOUR STAY', 'NURSING, EACH 2 HOURS', 'MINI-BUS TRIP, PER 15 MIN', 'THERAPY, UP TO 1 HOUR', 'SESSION, EACH HOUR'"
    per = r"(?:PER|UP TO|EACH)\s+"
    read = lambda unit: f"TRY_CAST(REGEXP_EXTRACT(UPPER(code_desc), '{per}(\\d+)\\s*{unit}', 1) AS DOUBLE)"
    return f"""claims AS (SELECT *, CASE WHEN REGEXP_MATCHES(UPPER(code_desc), '{per}\\d+\\s*MINUTE') THEN {read("MINUTE")} WHEN REGEXP_MATCHES(UPPER(code_desc), '{per}\\d+\\s*HOUR') THEN {read("HOUR")} * 60 WHEN REGEXP_MATCHES(UPPER(code_desc), '{per}HOUR') THEN 60.0 END AS unit,
  REGEXP_MATCHES(UPPER(code_desc), 'UP TO\\s+\\d+') AS bounded FROM (SELECT CONCAT_WS('-', l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(l_shipdate AS DATE)) AS line_id, l_orderkey AS claim_id, {member} AS member_id, {biller} AS billing_id,
  CAST(CASE WHEN l_linenumber = 7 THEN -1 WHEN l_partkey % 4 = 0 THEN l_suppkey % 25 WHEN l_partkey % 4 = 1 THEN (l_suppkey * l_suppkey) % 25 ELSE l_suppkey % 25 + 25 * (1 + l_partkey % (1 + l_suppkey % 9)) END AS BIGINT) AS servicing_id,
  p_brand AS code, p_type AS cos, CASE WHEN p_partkey % 500 = 7 THEN 'SUPPLY, PER 99999999999 MINUTES' ELSE [{texts}][p_partkey % 10 + 1] END AS code_desc, l_quantity AS qty, l_extendedprice AS paid,
  CAST(DATE_TRUNC('{unit}', l_shipdate) AS DATE) AS svc_dt, CASE WHEN l_linenumber = 5 THEN CAST(DATE_TRUNC('{unit}', l_shipdate) AS DATE) + CAST(1 + 2 * (l_partkey % 2) AS INTEGER) END AS svc_end, CAST(s_nationkey AS BIGINT) AS tax_id, CASE WHEN o_orderpriority = '5-LOW' THEN 'MSP' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS lob,
  CASE WHEN l_linenumber = 6 THEN 'HQ' END AS mod1, CASE WHEN l_returnflag = 'R' THEN 'V' ELSE 'A' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey))"""


def _paid(dense: bool = True) -> str:
    return f"""WITH RECURSIVE {_claims(dense)}, known AS (SELECT * FROM claims WHERE status = 'A' AND svc_dt <= DATE '2001-12-31'),
paid AS (SELECT * FROM known WHERE svc_dt >= (SELECT MAX(svc_dt) FROM known) - INTERVAL 24 MONTH)"""


def _money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


_KEYS = "LIST_SORT(LIST_DISTINCT(LIST(line_id)))"
FAMILY = {"R1": "intensity", "R2": "intensity", "R3": "transport", "R4": "member_brokering", "R5": "facility_pricing", "R6": "duplicate_payment", "R7": "intensity", "R8A": "provider_identity", "R8B": "provider_identity", "R9": "duplicate_payment", "R10": "role"}
TITLE = {
    "R1": "More timed service for a member than a day can hold", "R2": "Units per member-day far above peers", "R3": "Transport without a service around that day", "R4": "Members with unusually many billers", "R5": "Outpatient facility encounter far above peers",
    "R6": "Same service on several claims", "R7": "Claim lines per member-day far above peers", "R8A": "Many renderers for one member under one biller", "R8B": "Renderer under many billers", "R9": "Same service paid to several billers", "R10": "Provider in a role it should not hold",
}
#: Ties at one decimal place go up, as in the other engine.
_PART = "code || ' ' || FORMAT('{:.1f}', ROUND(minutes / 60, 1)) || 'h'"
_R1_TEXT = "CONCAT_WS('; ', ARRAY_TO_STRING(parts, ' + '), CASE WHEN codes > 1 THEN 'several codes together' END, CASE WHEN bounded THEN 'some units are upper bounds' END, CASE WHEN spans THEN 'multi-day lines count by day' END, CASE WHEN exact > 1440 THEN 'one code alone passes the limit' END)"
_R5_TEXT = "CASE WHEN z > 1.2 AND n > GREATEST(many, 1) THEN 'price_and_stacked' WHEN z > 1.2 THEN 'price' ELSE 'stacked' END"


def _hit(rule: str, source: str, severity: str, metric: str, tier: str = "2", member: str = "member_id", cos: str = "'(cross-COS)'", entity: str = "billing_id", kind: str = "'billing'", detail: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"""SELECT CAST({entity} AS BIGINT) AS entity_id, {kind} AS entity_type, '{rule}' AS rule_id, '{FAMILY[rule]}' AS family, CAST({tier} AS INTEGER) AS tier, ROUND(CAST({severity} AS DOUBLE), 3) AS severity,
  CAST({metric} AS DOUBLE) AS metric, ROUND(dollars, 2) AS hit_dollars, CAST({member} AS BIGINT) AS member_id, {cos} AS cos, '{TITLE[rule]}' AS title, {detail} AS detail, line_keys FROM {source} WHERE {entity} <> -1"""


def _group(name: str, keys: str, more: str, where: str = "TRUE", source: str = "paid") -> str:
    return f"{name} AS (SELECT {keys}, {_money('paid')} AS dollars, {_KEYS} AS line_keys{', ' + more if more else ''} FROM {source} WHERE {where} GROUP BY {keys})"


#: CTEs of each rule, and its hits.
RULES: dict[str, tuple[str, str]] = {
    "R1": (
        f"""c1 AS (SELECT billing_id, member_id, svc_dt, code, SUM(qty * unit / GREATEST(COALESCE(svc_end, svc_dt) - svc_dt + 1, 1)) AS minutes, MAX(bounded) AS bounded, MAX(COALESCE(svc_end > svc_dt, FALSE)) AS spans, {_money("paid")} AS dollars, LIST(DISTINCT cos) AS cs, LIST(line_id) AS ks FROM paid WHERE unit IS NOT NULL GROUP BY ALL),
g1 AS (SELECT billing_id, member_id, svc_dt, LIST_SORT(LIST({_PART})) AS parts, COUNT(*) AS codes, MAX(bounded) AS bounded, MAX(spans) AS spans, SUM(minutes) AS minutes, MAX(minutes) FILTER (NOT bounded) AS exact, {_money("dollars")} AS dollars, ARRAY_TO_STRING(LIST_SORT(LIST_DISTINCT(FLATTEN(LIST(cs)))), ', ') AS cos, LIST_SORT(LIST_DISTINCT(FLATTEN(LIST(ks)))) AS line_keys FROM c1 GROUP BY ALL HAVING SUM(minutes) > 1440)""",
        _hit("R1", "g1", "minutes / 1440", "minutes / 60", "CASE WHEN exact > 1440 THEN 1 ELSE 2 END", cos="cos", detail=_R1_TEXT),
    ),
    "R2": (
        _group("g2", "cos, billing_id, member_id, svc_dt", "SUM(qty) AS units") + ", p2 AS (SELECT cos, QUANTILE_CONT(units, 0.995) AS cut, QUANTILE_CONT(units, 0.5) AS med FROM g2 GROUP BY cos), h2 AS (SELECT * FROM g2 JOIN p2 USING (cos) WHERE units > cut AND units >= 2)",
        _hit("R2", "h2", "units / CASE WHEN med > 0 THEN med ELSE 1 END", "units", cos="cos"),
    ),
    "R3": (
        """v3 AS (SELECT DISTINCT member_id, svc_dt + CAST(k AS INTEGER) AS svc_dt FROM paid, RANGE(-1, 2) r(k) WHERE cos NOT IN ('MEDIUM', 'SMALL')), u3 AS (SELECT * FROM paid WHERE cos = 'MEDIUM' AND NOT EXISTS (SELECT 1 FROM v3 WHERE v3.member_id = paid.member_id AND v3.svc_dt = paid.svc_dt)),
"""
        + _group("g3", "billing_id, member_id, svc_dt, cos", "COUNT(*) AS n", source="u3"),
        _hit("R3", "g3", "n", "n", cos="cos"),
    ),
    "R4": (
        "f4 AS (SELECT member_id, COUNT(DISTINCT billing_id) AS fanout FROM paid GROUP BY member_id), o4 AS (SELECT paid.*, fanout FROM paid JOIN f4 USING (member_id) WHERE fanout > (SELECT QUANTILE_CONT(fanout, 0.995) FROM f4)), "
        + _group("g4", "billing_id, member_id, fanout", "", source="o4") + ", h4 AS (SELECT * FROM g4 WHERE billing_id IN (SELECT billing_id FROM g4 GROUP BY billing_id HAVING COUNT(*) >= 2))",
        _hit("R4", "h4", "fanout", "fanout", "3"),
    ),
    "R5": (
        _group("g5", "billing_id, claim_id, member_id", "COUNT(*) AS n", "cos = 'PROMO'")
        + ", m5 AS (SELECT QUANTILE_CONT(dollars, 0.5) AS med, QUANTILE_CONT(n, 0.995) AS many FROM g5), d5 AS (SELECT QUANTILE_CONT(ABS(dollars - med), 0.5) AS mad FROM g5, m5), z5 AS (SELECT *, 0.6745 * (dollars - med) / CASE WHEN mad = 0 THEN 1e-9 ELSE mad END AS z FROM g5, m5, d5), h5 AS (SELECT * FROM z5 WHERE z > 1.2 OR n > GREATEST(many, 1))",
        _hit("R5", "h5", "GREATEST(z, n)", "dollars", cos="'PROMO'", detail=_R5_TEXT),
    ),
    "R6": (_group("g6", "member_id, billing_id, code, svc_dt, cos", "COUNT(*) AS n, COUNT(DISTINCT claim_id) AS claims_", "paid > 0") + ", h6 AS (SELECT * FROM g6 WHERE claims_ > 1)", _hit("R6", "h6", "n", "n", "1", cos="cos")),
    "R7": (_group("g7", "svc_dt, member_id, billing_id, cos", "COUNT(*) AS n") + ", h7 AS (SELECT * FROM g7 WHERE n > (SELECT QUANTILE_CONT(n, 0.995) FROM g7))", _hit("R7", "h7", "n", "n", "3", cos="cos")),
    "R8A": (_group("g8", "billing_id, member_id", "COUNT(DISTINCT servicing_id) AS n", "servicing_id <> -1") + ", h8 AS (SELECT * FROM g8 WHERE n > (SELECT GREATEST(QUANTILE_CONT(n, 0.995), 5) FROM g8))", _hit("R8A", "h8", "n", "n")),
    "R8B": (
        _group("g8b", "servicing_id", "COUNT(DISTINCT billing_id) AS n, COUNT(DISTINCT tax_id) AS t", "servicing_id <> -1") + ", h8b AS (SELECT * FROM g8b WHERE n > (SELECT GREATEST(QUANTILE_CONT(n, 0.9), 1) FROM g8b))",
        _hit("R8B", "h8b", "GREATEST(n, t)", "n", member="NULL", entity="servicing_id", kind="'servicing'"),
    ),
    "R9": (
        _group("g9", "member_id, code, svc_dt, billing_id", "MIN(cos) AS cos", "paid > 0 AND (lob IS NULL OR lob <> 'MSP')") + ", b9 AS (SELECT member_id, code, svc_dt, COUNT(*) AS billers FROM g9 GROUP BY ALL HAVING COUNT(*) >= 2), h9 AS (SELECT * FROM g9 JOIN b9 USING (member_id, code, svc_dt))",
        _hit("R9", "h9", "billers", "billers", cos="cos"),
    ),
    "R10": (
        "ref AS (SELECT s_suppkey AS provider, CASE WHEN s_suppkey % 3 = 0 THEN 'billing' ELSE 'servicing' END AS expected FROM supplier), s10 AS (SELECT billing_id AS provider, 'billing' AS seen, * FROM paid UNION ALL SELECT servicing_id, 'servicing', * FROM paid), w10 AS (SELECT s10.* FROM s10 JOIN ref USING (provider) WHERE provider <> -1 AND seen <> expected), "
        + _group("g10", "provider, seen, member_id, cos", "COUNT(*) AS n", source="w10"),
        _hit("R10", "g10", "n", "n", "1", cos="cos", entity="provider", kind="seen"),
    ),
}
_HIT_COLUMNS = "entity_id, entity_type, rule_id, family, tier, severity, ROUND(metric, 6) AS metric, hit_dollars, member_id, cos, title, detail, CAST(LEN(line_keys) AS INTEGER) AS n_lines, ARRAY_TO_STRING(line_keys[:20], '|') AS evidence_keys"


def _rule(rule: str, dense: bool = True) -> str:
    ctes, hit = RULES[rule]
    return f"{_paid(dense)}, {ctes}, h AS ({hit}) SELECT {_HIT_COLUMNS} FROM h"


_ALL = [r for r in RULES if r != "R10"]
HITS = f"{_paid()}, {', '.join(RULES[r][0] for r in _ALL)}, hits AS ({' UNION ALL '.join(RULES[r][1] for r in _ALL)})"
LINES = HITS + """, fl AS (SELECT DISTINCT entity_id, entity_type, rule_id, family, tier, UNNEST(line_keys) AS line_id FROM hits),
lines AS (SELECT fl.*, paid.paid, member_id, svc_dt, billing_id, servicing_id FROM fl JOIN paid USING (line_id))"""
_DOLLARS = f"""dollars AS (SELECT entity_id, entity_type, {_money("CASE WHEN ok THEN paid END")} AS dollars_at_risk, COUNT(DISTINCT line_id) FILTER (ok) AS lines_flagged, COUNT(DISTINCT member_id) FILTER (ok) AS members_flagged,
  COUNT(DISTINCT (member_id, svc_dt)) FILTER (ok) AS member_days_flagged, {_money("paid")} AS dollars_incl_untrusted FROM (SELECT entity_id, entity_type, line_id, paid, member_id, svc_dt, MAX(rule_id <> 'R6') AS ok FROM lines GROUP BY ALL) GROUP BY ALL)"""
_SCORE = """rw AS (SELECT entity_id, entity_type, family, rule_id, SUM((4 - tier) * (1 + LN(1 + GREATEST(severity, 0)))) AS w FROM hits WHERE rule_id <> 'R6' GROUP BY ALL), fw AS (SELECT entity_id, entity_type, family, MAX(w) AS w FROM rw GROUP BY ALL),
score AS (SELECT entity_id, entity_type, SUM(w) AS risk_score FROM fw GROUP BY ALL)"""
_CONTEXT = f"""roles AS (SELECT billing_id AS entity_id, 'billing' AS entity_type, paid, member_id, svc_dt FROM paid UNION ALL SELECT servicing_id, 'servicing', paid, member_id, svc_dt FROM paid),
context AS (SELECT entity_id, entity_type, {_money("paid")} AS total_paid, COUNT(*) AS n_claims, COUNT(DISTINCT member_id) AS n_members, MAX(svc_dt) AS last_svc_dt FROM roles WHERE entity_id <> -1 GROUP BY ALL)"""
#: The ordered fold, a family at a time; all keys are seen afterwards, counted or not.
_FOLD = """fams AS (SELECT entity_id, entity_type, family, LIST_DISTINCT(LIST(line_id)) AS keys, MAX(tier = 1) AS tier1 FROM lines WHERE rule_id <> 'R6' GROUP BY ALL),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_id, entity_type ORDER BY LEN(keys) DESC, family) AS k FROM fams),
fold AS (SELECT entity_id, entity_type, k, [family] AS counted, keys AS seen, tier1 FROM ranked WHERE k = 1
  UNION ALL SELECT r.entity_id, r.entity_type, r.k, CASE WHEN x.new THEN LIST_APPEND(f.counted, r.family) ELSE f.counted END, LIST_DISTINCT(LIST_CONCAT(f.seen, r.keys)), f.tier1 OR (x.new AND r.tier1)
  FROM fold f JOIN ranked r ON r.entity_id = f.entity_id AND r.entity_type = f.entity_type AND r.k = f.k + 1, LATERAL (SELECT LEN(LIST_INTERSECT(r.keys, f.seen)) < LEN(r.keys) * 0.5 AS new) x),
indep AS (SELECT entity_id, entity_type, CAST(LEN(ARG_MAX(counted, k)) AS INTEGER) AS independent_families, ARRAY_TO_STRING(ARG_MAX(counted, k), ',') AS families, ARG_MAX(tier1, k) AS has_tier1_family FROM fold GROUP BY ALL)"""
QUEUE = LINES + f""", {_DOLLARS}, {_SCORE}, {_CONTEXT}, {_FOLD},
summary AS (SELECT entity_id, entity_type, COUNT(*) AS n_hits, COUNT(DISTINCT rule_id) AS distinct_rules, STRING_AGG(DISTINCT rule_id, ',' ORDER BY rule_id) AS rules FROM hits GROUP BY ALL),
q0 AS (SELECT s.*, COALESCE(risk_score, 0) AS score0, COALESCE(dollars_at_risk, 0) AS dollars_at_risk, COALESCE(lines_flagged, 0) AS lines_flagged, COALESCE(members_flagged, 0) AS members_flagged, COALESCE(member_days_flagged, 0) AS member_days_flagged,
  COALESCE(dollars_incl_untrusted, 0) AS dollars_incl_untrusted, COALESCE(independent_families, 0) AS independent_families, COALESCE(families, '') AS families, COALESCE(has_tier1_family, FALSE) AS has_tier1_family, total_paid, n_claims, n_members, last_svc_dt,
  (SELECT MAX(svc_dt) FROM paid) AS data_end_date FROM summary s LEFT JOIN score USING (entity_id, entity_type) LEFT JOIN dollars USING (entity_id, entity_type) LEFT JOIN indep USING (entity_id, entity_type) LEFT JOIN context USING (entity_id, entity_type)),
q1 AS (SELECT *, independent_families >= 2 AND members_flagged >= 2 AS corroborated FROM q0),
q AS (SELECT * EXCLUDE (score0), ROUND(score0 * CASE WHEN corroborated THEN 1.3 ELSE 1.0 END, 6) AS risk_score, ROUND(dollars_at_risk / NULLIF(total_paid, 0), 6) AS pct_dollars_at_risk, CAST(data_end_date - last_svc_dt AS INTEGER) AS days_before_data_end,
  CASE WHEN NOT corroborated THEN 'Contributing' WHEN independent_families >= 3 OR has_tier1_family THEN 'Strong' ELSE 'Moderate' END AS tier_label, independent_families = 0 AS untrusted_only FROM q1)"""
_PAIRS = """own AS (SELECT DISTINCT billing_id, member_id FROM paid), panels AS (SELECT billing_id, COUNT(*) AS size FROM own GROUP BY billing_id HAVING COUNT(*) >= 5), o AS (SELECT own.*, size FROM own JOIN panels USING (billing_id)),
shared AS (SELECT a.billing_id AS pa, b.billing_id AS pb, a.size AS sza, b.size AS szb, COUNT(*) AS shared FROM o a JOIN o b ON a.member_id = b.member_id AND a.billing_id < b.billing_id GROUP BY ALL HAVING COUNT(*) >= 3),
pairs AS (SELECT *, LN(CAST(shared * (SELECT COUNT(DISTINCT member_id) FROM paid) AS DOUBLE) / (sza * szb)) AS pmi, CAST(shared AS DOUBLE) / (sza + szb - shared) AS jaccard FROM shared)"""
_NAMES = """names AS (SELECT billing_id AS entity_id, 'billing' AS entity_type, s_name AS name, CASE WHEN s_acctbal < 0 THEN 'GROUP' ELSE 'SOLO' END AS ptype FROM claims JOIN supplier ON s_suppkey = CAST(SPLIT_PART(line_id, '-', 3) AS BIGINT))"""

_COHORT = "servicing_id <> -1 AND servicing_id % 3 <> 2"
#: The cohort's lines as the screen uses them.
SVC = f"""WITH {_claims(True)}, svc AS (SELECT *, UPPER(TRIM(code)) AS ucode, billing_id = servicing_id AS own, COALESCE(mod1, '') <> 'HQ' AND UPPER(code) IN ({", ".join(f"'BRAND#{i}'" for i in range(1, 10))}) AND COALESCE(svc_end, svc_dt) = svc_dt AS timed,
  CONCAT_WS('|', UPPER(TRIM(code)), COALESCE(mod1, ''), '', '', '', CAST(qty AS VARCHAR)) AS signature FROM claims WHERE status = 'A' AND servicing_id <> -1 AND servicing_id % 3 <> 2),
n AS (SELECT * EXCLUDE (code, ucode), ucode AS code, CASE WHEN timed THEN qty * 15 ELSE 0.0 END AS minutes, DATE_TRUNC('month', svc_dt) AS mon FROM svc)"""
_OVER = "CASE WHEN minutes > {0} THEN (minutes - {0}) / minutes ELSE 0.0 END"
DAYS = SVC + f""", d0 AS (SELECT servicing_id, svc_dt, SUM(minutes) AS minutes, COUNT(DISTINCT member_id) AS members, SUM(CASE WHEN own THEN 0.0 ELSE minutes END) AS other_minutes FROM n GROUP BY ALL),
days AS (SELECT *, minutes / 60 AS hours, {_OVER.format(1440)} AS r24, {_OVER.format(720)} AS rcap FROM d0),
x AS (SELECT n.servicing_id, n.billing_id, svc_dt, paid, paid * r24 AS over24, paid * rcap AS overcap, CASE WHEN rcap > 0 THEN paid ELSE 0.0 END AS on_cap_days FROM n JOIN days USING (servicing_id, svc_dt) WHERE timed)"""


def _exposure(keys: str, source: str = "x") -> str:
    part = lambda c: f"CAST(SUM(CAST({c} AS DECIMAL(24,6))) AS DOUBLE)"
    return f"SELECT {keys}, {_money('paid')} AS timed_paid, {_money('on_cap_days')} AS paid_on_cap_days, {part('overcap')} AS tier2, {part('over24')} AS tier1 FROM {source} GROUP BY {keys}"


def _share(level: int, value: str = "hours") -> str:
    return f"ROUND(SUM(CASE WHEN {value} > {level} THEN 1 WHEN {value} IS NOT NULL THEN 0 END) * 100.0 / COUNT(*), 6)"


def _shares(prefix: str, value: str = "hours") -> str:
    return ", ".join(f"CAST({_share(h, value)} AS DOUBLE) AS {prefix}_{h}h" for h in (4, 8, 12, 16, 20, 24))


WINDOWS = DAYS + """, windows AS (SELECT * FROM (VALUES ('Full', NULL), ('1Y', 12), ('6M', 6)) w(win, months)), anchor AS (SELECT MAX(svc_dt) AS a FROM n),
nw AS (SELECT win, n.* FROM n, windows, anchor WHERE months IS NULL OR svc_dt >= a - TO_MONTHS(CAST(months AS INTEGER))), dw AS (SELECT win, days.* FROM days, windows, anchor WHERE months IS NULL OR svc_dt >= a - TO_MONTHS(CAST(months AS INTEGER))),
xw AS (SELECT win, x.* FROM x, windows, anchor WHERE months IS NULL OR svc_dt >= a - TO_MONTHS(CAST(months AS INTEGER)))"""


def _patterns(p: str, keys: str, unit: str, source: str) -> str:
    """CTEs of the pattern measures, named with the prefix p."""
    j = f"USING ({keys})"
    return f"""{p}dup AS (SELECT {unit}, svc_dt, signature, COUNT(DISTINCT member_id) AS size FROM {source} GROUP BY ALL),
{p}days AS (SELECT {keys}, COUNT(*) AS days, SUM(CAST(most >= 2 AS BIGINT)) AS dup_days FROM (SELECT {unit}, svc_dt, MAX(size) AS most FROM {p}dup GROUP BY ALL) GROUP BY {keys}),
{p}mem AS (SELECT {keys}, COUNT(*) AS members, SUM(CAST(most >= 2 AS BIGINT)) AS dup_members FROM (SELECT {keys}, member_id, MAX(size) AS most FROM {source} JOIN {p}dup USING ({unit}, svc_dt, signature) GROUP BY ALL) GROUP BY {keys}),
{p}cut AS (SELECT {keys}, days, CAST(dup_days AS BIGINT) AS dup_days, members, CAST(dup_members AS BIGINT) AS dup_members FROM {p}days JOIN {p}mem {j}),
{p}pkg AS (SELECT {unit}, member_id, svc_dt, STRING_AGG(signature, CHR(10) ORDER BY signature) AS pk FROM {source} GROUP BY ALL), {p}again AS (SELECT {unit}, member_id, pk, COUNT(*) AS k FROM {p}pkg GROUP BY ALL HAVING COUNT(*) > 1),
{p}rep AS (SELECT {keys}, COUNT(DISTINCT member_id) AS repeat_members, AVG(k) AS avg_repeats, MAX(k) AS max_repeats FROM {p}again GROUP BY {keys}),
{p}ses AS (SELECT {keys}, AVG(m) / 60 AS avg_session_hours FROM (SELECT {keys}, member_id, svc_dt, SUM(minutes) AS m FROM {source} GROUP BY ALL HAVING SUM(minutes) > 0) GROUP BY {keys}),
{p}code AS (SELECT {keys}, code, {_money("paid")} AS pp FROM {source} GROUP BY ALL), {p}top AS (SELECT {keys}, code AS top_code, ROUND(pp / tot * 100, 6) AS top_code_share FROM (SELECT *, SUM(pp) OVER (PARTITION BY {keys}) AS tot, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY pp DESC, code) AS rk FROM {p}code) WHERE rk = 1),
{p}feat AS (SELECT {keys}, ROUND(CAST(dup_days AS DOUBLE) * 100 / days, 6) AS pct_days_dup_pattern, ROUND(CAST(dup_members AS DOUBLE) * 100 / members, 6) AS pct_members_in_dup, ROUND(CAST(COALESCE(repeat_members, 0) AS DOUBLE) * 100 / members, 6) AS pct_members_repeat_pkg, ROUND(avg_session_hours, 6) AS avg_session_hours, top_code, top_code_share
  FROM {p}cut LEFT JOIN {p}rep {j} LEFT JOIN {p}ses {j} LEFT JOIN {p}top {j})"""


def _features(p: str, key: str, other: str, days: str) -> str:
    """The feature table of a level, without what only billers have."""
    return f"""{p}tot AS (SELECT win, {key}, {_money("paid")} AS total_paid, COUNT(DISTINCT member_id) AS total_members, COUNT(DISTINCT {other}) AS n_counterparts, COUNT(DISTINCT mon) AS active_months FROM nw GROUP BY ALL), {p}exp AS ({_exposure(f"win, {key}", "xw")}),
{p}all AS (SELECT * FROM {days} JOIN {p}tot USING (win, {key}) JOIN {p}feat USING (win, {key}) LEFT JOIN {p}exp USING (win, {key})),
{p}done AS (SELECT *, ROUND(total_paid / total_members, 6) AS paid_per_member, ROUND(COALESCE(tier2, 0) / active_months, 2) AS tier2_per_month FROM {p}all)"""


_SERVING = f"""{_patterns("s", "win, servicing_id", "win, servicing_id", "nw")}, sd AS (SELECT win, servicing_id, COUNT(*) AS active_days, ROUND(AVG(hours), 6) AS avg_hours_day, MAX(hours) AS max_hours_day, {_share(8)} AS pct_days_over_8h, {_share(12)} AS pct_days_over_cap, {_share(24)} AS pct_days_over_24h, ROUND(AVG(members), 6) AS avg_members_day FROM dw GROUP BY ALL),
{_features("s", "servicing_id", "billing_id", "sd")}"""
_BILLING = f"""{_patterns("b", "win, billing_id", "win, billing_id, servicing_id", "nw")}, bday AS (SELECT * FROM (SELECT DISTINCT win, billing_id, servicing_id, svc_dt FROM nw) JOIN dw USING (win, servicing_id, svc_dt)),
act AS (SELECT win, servicing_id, AVG(hours) AS h FROM dw GROUP BY ALL HAVING COUNT(*) >= CASE win WHEN 'Full' THEN 20 WHEN '1Y' THEN 8 ELSE 4 END), cuts AS (SELECT win, QUANTILE_CONT(h, 0.95) AS cut FROM act GROUP BY win), outs AS (SELECT win, servicing_id, 1 AS o FROM act JOIN cuts USING (win) WHERE h >= cut),
pp AS (SELECT win, billing_id, servicing_id, {_money("paid")} AS p FROM nw GROUP BY ALL), bo AS (SELECT win, billing_id, ROUND(COUNT(o) * 100.0 / COUNT(*), 6) AS pct_clinicians_outlier, ROUND(COALESCE({_money("CASE WHEN o = 1 THEN p ELSE 0 END")} * 100 / NULLIF({_money("p")}, 0), 0), 6) AS pct_paid_via_outliers FROM pp LEFT JOIN outs USING (win, servicing_id) GROUP BY ALL),
bd AS (SELECT * FROM (SELECT win, billing_id, COUNT(DISTINCT svc_dt) AS active_days, COUNT(*) AS clinician_days, ROUND(AVG(hours), 6) AS avg_hours_day, {_share(12)} AS pct_days_over_cap, {_share(24)} AS pct_days_over_24h, ROUND(AVG(members), 6) AS avg_members_day FROM bday GROUP BY ALL) JOIN bo USING (win, billing_id)),
{_features("b", "billing_id", "servicing_id", "bd")}"""
_PATTERN = f"""pd AS (SELECT win, servicing_id, SUM(CAST(minutes > 1440 AS BIGINT)) AS days_over_24h, SUM(CAST(minutes > 1440 AND other_minutes > 0 AS BIGINT)) AS days_over_24h_with_other FROM dw GROUP BY ALL),
pc AS (SELECT win, servicing_id, COALESCE({_money("CASE WHEN own THEN paid END")}, 0) AS self_paid, COALESCE({_money("CASE WHEN NOT own THEN paid END")}, 0) AS other_paid, COUNT(*) FILTER (own) AS self_lines, COUNT(*) FILTER (NOT own) AS other_lines, COUNT(DISTINCT billing_id) FILTER (NOT own) AS n_other_billers,
  COALESCE(SUM(qty) FILTER (own AND timed), 0) AS self_units, COUNT(DISTINCT svc_dt) FILTER (own AND timed) AS self_days, COALESCE(SUM(qty) FILTER (NOT own AND timed), 0) AS other_units, COUNT(DISTINCT svc_dt) FILTER (NOT own AND timed) AS other_days FROM nw GROUP BY ALL),
po AS (SELECT win, servicing_id, billing_id AS top_other_biller FROM (SELECT win, servicing_id, billing_id, ROW_NUMBER() OVER (PARTITION BY win, servicing_id ORDER BY p DESC, billing_id) AS rk FROM (SELECT win, servicing_id, billing_id, {_money("paid")} AS p FROM nw WHERE NOT own GROUP BY ALL)) WHERE rk = 1),
pt AS (SELECT *, other_paid / NULLIF(self_paid + other_paid, 0) AS other_share, self_units / NULLIF(self_days, 0) AS self_units_per_day, other_units / NULLIF(other_days, 0) AS other_units_per_day FROM pc JOIN pd USING (win, servicing_id) LEFT JOIN po USING (win, servicing_id)),
pr AS (SELECT *, other_units_per_day / NULLIF(self_units_per_day, 0) AS units_ratio FROM pt), pl AS (SELECT *, COALESCE(other_share >= 0.5, FALSE) AND (self_lines = 0 OR COALESCE(units_ratio >= 5, FALSE) OR COALESCE(self_units_per_day = 0 AND other_units_per_day > 0, FALSE)) AS driven FROM pr),
pattern AS (SELECT *, CASE WHEN days_over_24h_with_other >= 2 AND self_lines > 0 AND other_lines > 0 AND driven THEN 'Full' WHEN days_over_24h_with_other >= 2 AND driven THEN 'Close' WHEN days_over_24h >= 2 THEN 'Impossible only' ELSE '' END AS pattern FROM pl)"""
SERVING_FEATURES = ["avg_hours_day", "max_hours_day", "pct_days_over_8h", "pct_days_over_cap", "pct_days_over_24h", "avg_members_day", "avg_session_hours", "paid_per_member", "pct_days_dup_pattern", "pct_members_in_dup", "pct_members_repeat_pkg", "top_code_share"]
BILLER_FEATURES = ["avg_hours_day", "pct_days_over_cap", "pct_days_over_24h", "pct_timed_paid_on_cap_days", "pct_clinicians_outlier", "pct_paid_via_outliers", "avg_members_day", "avg_session_hours", "paid_per_member", "pct_days_dup_pattern", "pct_members_in_dup", "pct_members_repeat_pkg", "top_code_share"]


def _looks(p: str, key: str, reference: int, names: list[str], source: str) -> str:
    """CTEs of ranks and scores among a level's active entities, named with the prefix p."""
    return f"""{p}peers AS (SELECT * FROM {source} WHERE (active_days >= CASE win WHEN 'Full' THEN 20 WHEN '1Y' THEN 8 ELSE 4 END OR {key} = {reference}) AND win IN (SELECT win FROM {source} WHERE {key} = {reference})),
{p}long AS ({" UNION ALL ".join(f"SELECT win, {key}, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {p}peers" for f in names)}),
{p}pct AS (SELECT *, CASE WHEN value IS NOT NULL THEN (RANK() OVER (PARTITION BY win, feature ORDER BY value NULLS LAST) + (COUNT(*) OVER (PARTITION BY win, feature, value) - 1) / 2.0) / COUNT(value) OVER (PARTITION BY win, feature) END AS pct FROM {p}long),
{p}ref AS (SELECT win, feature, pct AS ref FROM {p}pct WHERE {key} = {reference}), {p}pairs AS (SELECT * FROM {p}pct JOIN {p}ref USING (win, feature)),
{p}looks AS (SELECT win, {key}, COUNT(*) FILTER (pct >= 0.95) AS n_red_flags, COALESCE(STRING_AGG(feature, ', ' ORDER BY feature) FILTER (pct >= 0.95), '') AS red_flags, AVG(CASE WHEN ref >= 0.9 THEN CAST(COALESCE(pct >= 0.9, FALSE) AS INTEGER) END) AS signature_match, 1 - AVG(ABS(pct - ref)) AS similarity FROM {p}pairs GROUP BY ALL)"""


def _combined(p: str, key: str, reference: int, looks: str, labels: str) -> str:
    """CTEs of the combined table, from scores and labels: one state for each entity and window first."""
    return f"""{p}sc AS (SELECT win, {key}, TRUE AS scored, {key} = {reference} OR (n_red_flags >= 3 AND COALESCE(signature_match >= 0.6, FALSE)) AS is_hit FROM {looks}),
{p}both AS (SELECT win, {key}, scored, is_hit, pattern FROM {p}sc FULL JOIN (SELECT win, {key}, pattern FROM {labels} WHERE pattern <> '') USING (win, {key})),
{p}state AS (SELECT k.{key}, w.win, COALESCE(b.pattern, '') AS pattern, CASE WHEN w.win NOT IN (SELECT win FROM {p}sc) THEN 'not run' WHEN b.is_hit THEN 'FLAG' WHEN b.scored THEN 'clear' ELSE 'inactive' END AS status
  FROM (SELECT DISTINCT {key} FROM {p}both) k CROSS JOIN windows w LEFT JOIN {p}both b ON b.win = w.win AND b.{key} = k.{key}),
{p}wide AS (SELECT {key}, BOOL_OR(status = 'FLAG') AS by_score, BOOL_OR(pattern <> '') AS by_label, CAST(COUNT(*) FILTER (status = 'FLAG' OR pattern <> '') AS INTEGER) AS windows_flagged, BOOL_OR(status = 'not run') AS skipped, BOOL_OR(win = '6M' AND status = 'inactive') AS idle,
  MAX(CASE pattern WHEN 'Full' THEN 4 WHEN 'Primary biller' THEN 3 WHEN 'Close' THEN 2 WHEN 'Impossible only' THEN 1 ELSE 0 END) AS best, BOOL_OR(win = 'Full' AND (status = 'FLAG' OR pattern <> '')) AS f, BOOL_OR(win = '1Y' AND (status = 'FLAG' OR pattern <> '')) AS y, BOOL_OR(win = '6M' AND (status = 'FLAG' OR pattern <> '')) AS s FROM {p}state GROUP BY ALL),
{p}trend AS (SELECT {key}, {key} = {reference} AS is_reference, CASE WHEN by_score AND by_label THEN 'Both' WHEN by_label THEN 'Pattern only' ELSE 'Percentile only' END AS match_basis, CASE best WHEN 4 THEN 'Full' WHEN 3 THEN 'Primary biller' WHEN 2 THEN 'Close' WHEN 1 THEN 'Impossible only' ELSE '' END AS pattern_best,
  CASE WHEN skipped THEN 'Unclassified (window skipped)' WHEN f AND y AND s THEN 'Persistent' WHEN s AND NOT f THEN 'Emerging' WHEN s THEN 'Active - intermittent' WHEN idle THEN 'Historical - no recent billing' WHEN y THEN 'Recently normalized' ELSE 'Historical - pattern stopped' END AS trend, windows_flagged FROM {p}wide WHERE windows_flagged > 0)"""


_RANKS = f"{_SERVING}, " + _looks("", "servicing_id", 7, SERVING_FEATURES, "sdone")
_STRENGTHS = f"""{_BILLING}, bfull AS (SELECT *, ROUND(COALESCE(paid_on_cap_days * 100 / NULLIF(timed_paid, 0), 0), 6) AS pct_timed_paid_on_cap_days FROM bdone), {_looks("m", "billing_id", 3, BILLER_FEATURES, "bfull")}"""
#: Combined tables of clinicians (ctrend) and billers (otrend), and the recovery window's dollars of both.
TRENDS = WINDOWS + f""", {_RANKS}, {_STRENGTHS}, {_PATTERN}, prim AS (SELECT DISTINCT win, top_other_biller AS billing_id, 'Primary biller' AS pattern FROM pattern WHERE pattern IN ('Full', 'Close') AND top_other_biller IS NOT NULL),
{_combined("c", "servicing_id", 7, "looks", "pattern")}, {_combined("o", "billing_id", 3, "mlooks", "prim")},
rn AS (SELECT * FROM n WHERE svc_dt >= (SELECT MAX(svc_dt) FROM n) - INTERVAL 24 MONTH), rx AS (SELECT * FROM x WHERE svc_dt >= (SELECT MAX(svc_dt) FROM x) - INTERVAL 24 MONTH)"""


def _recovery(key: str) -> str:
    return f"(SELECT * FROM (SELECT {key}, {_money('paid')} AS total_paid FROM rn GROUP BY ALL) LEFT JOIN ({_exposure(key, 'rx')}) USING ({key}))"


def _by_trend(source: str, key: str, level: str) -> str:
    part = lambda c: f"COALESCE(CAST(SUM(CAST({c} AS DECIMAL(24,6))) AS DOUBLE), 0)"
    return f"SELECT CASE WHEN is_reference THEN 'REFERENCE' ELSE trend END AS trend, COUNT(*) AS providers, COALESCE({_money('total_paid')}, 0) AS total_paid, {part('tier2')} AS tier2, {part('tier1')} AS tier1, '{level}' AS level FROM {source} LEFT JOIN {_recovery(key)} USING ({key}) GROUP BY 1"


#: What the reference clinician is known to show, by window; without claims the result is N/A.
_CALIBRATION = """own AS (SELECT w.win, p.* EXCLUDE (win) FROM windows w LEFT JOIN (SELECT * FROM pattern WHERE servicing_id = 7) p USING (win)), t AS (
  SELECT win, servicing_id, 'days over 24h with another biller' AS "check", CAST(days_over_24h_with_other AS VARCHAR) AS value, days_over_24h_with_other >= 2 AS ok FROM own
  UNION ALL SELECT win, servicing_id, 'bills itself and is billed by others', CONCAT_WS('/', self_lines, other_lines), self_lines > 0 AND other_lines > 0 FROM own UNION ALL SELECT win, servicing_id, 'share of other billers', CAST(ROUND(other_share, 3) AS VARCHAR), other_share >= 0.5 FROM own
  UNION ALL SELECT win, servicing_id, 'units ratio of others', CAST(ROUND(units_ratio, 2) AS VARCHAR), units_ratio >= 5 FROM own UNION ALL SELECT win, servicing_id, 'pattern label', pattern, pattern = 'Full' FROM own)"""


def _assembled(p: str, key: str, looks: str, source: str, extra: str, parts: str) -> str:
    """The combined table with all its columns: states and scores by window beside each other, and what else is known of the key."""
    w = {"Full": "Full", "1Y": "1Y", "6M": "6M"}
    state = ", ".join(f"MAX(CASE WHEN win = '{x}' THEN {c} END) AS \"{c}_{x}\"" for c in ("status", "pattern") for x in w)
    score = ", ".join(f"ROUND(MAX(CASE WHEN win = '{x}' THEN {c} END), 6) AS \"{n}_{x}\"" for c, n in (("similarity", "similarity"), ("signature_match", "signature_match")) for x in w)
    flags = ", ".join(f"MAX(CASE WHEN win = '{x}' THEN {c} END) AS \"{n}_{x}\"" for c, n in (("n_red_flags", "n_flags"), ("red_flags", "red_flags"), ("tier2_per_month", "tier2_per_month")) for x in w)
    claims = "SELECT * FROM claims WHERE status = 'A'"
    return f""", {p}st AS (SELECT {key}, {state} FROM {p}state GROUP BY 1), {p}z AS (SELECT l.*, tier2_per_month, top_code, CASE win WHEN 'Full' THEN 0 WHEN '1Y' THEN 1 ELSE 2 END AS place FROM {looks} l JOIN {source} USING (win, {key})),
{p}zz AS (SELECT {key}, {score}, {flags}, MAX(CASE WHEN place = (SELECT MIN(place) FROM {p}z) THEN top_code END) AS top_code FROM {p}z GROUP BY 1),
{p}paid AS (SELECT * FROM ({claims}) WHERE svc_dt >= (SELECT MAX(svc_dt) FROM n) - INTERVAL 24 MONTH), {p}keys AS (SELECT DISTINCT member_id, code, svc_dt FROM ({claims}) WHERE {_COHORT}),
{p}per AS (SELECT member_id, code, svc_dt, billing_id, {_money("paid")} AS paid, LIST(DISTINCT servicing_id) AS servicers FROM {p}paid SEMI JOIN {p}keys USING (member_id, code, svc_dt) WHERE paid > 0 AND (lob IS NULL OR lob <> 'MSP') GROUP BY ALL),
{p}grp AS (SELECT LIST_DISTINCT(LIST_CONCAT(LIST(billing_id), FLATTEN(LIST(servicers)))) AS who, CAST(SUM(CAST(paid AS DECIMAL(18,2))) - MAX(CAST(paid AS DECIMAL(18,2))) AS DOUBLE) AS dup FROM {p}per GROUP BY member_id, code, svc_dt HAVING COUNT(*) >= 2),
{p}inv AS (SELECT {key}, COUNT(*) AS dup_services, {_money("dup")} AS dup_paid FROM (SELECT UNNEST(who) AS {key}, dup FROM {p}grp) GROUP BY 1){parts}
SELECT t.*, {p}st.* EXCLUDE ({key}), {p}zz.* EXCLUDE ({key}), r.* EXCLUDE ({key}), dup_services, dup_paid, {extra}, CASE match_basis WHEN 'Both' THEN 1 WHEN 'Pattern only' THEN 2 ELSE 3 END AS basis_rank,
  CASE WHEN trend = 'Persistent' THEN 1 WHEN trend IN ('Emerging', 'Active - intermittent') THEN 2 WHEN trend = 'Recently normalized' THEN 3 WHEN trend LIKE 'Historical%' THEN 4 ELSE 5 END AS trend_rank
FROM {p}trend t JOIN {p}st USING ({key}) LEFT JOIN {p}zz USING ({key}) LEFT JOIN {_recovery(key)} r USING ({key}) LEFT JOIN {p}inv USING ({key})"""


def _wide_servicing() -> str:
    measures = "days_over_24h, days_over_24h_with_other, n_other_billers, top_other_biller, other_share, self_units_per_day, other_units_per_day, units_ratio"
    rounded = ", ".join(f"ROUND({m}, 6) AS {m}" if m in ("other_share", "self_units_per_day", "other_units_per_day", "units_ratio") else f"CAST({m} AS BIGINT) AS {m}" for m in measures.split(", "))
    parts = f", pw AS (SELECT servicing_id, win AS pattern_window, {measures} FROM pattern QUALIFY ROW_NUMBER() OVER (PARTITION BY servicing_id ORDER BY CASE win WHEN 'Full' THEN 0 WHEN '1Y' THEN 1 ELSE 2 END) = 1)"
    extra = f"COALESCE(servicing_id IN (SELECT servicing_id FROM n WHERE billing_id = 3), FALSE) AS bills_through_reference, pattern_window, {rounded}"
    return TRENDS + _assembled("c", "servicing_id", "looks", "sdone", extra, parts) + " LEFT JOIN pw USING (servicing_id)"


def _wide_billing() -> str:
    parts = f""", role AS (SELECT billing_id, COUNT(*) AS lines, COUNT(*) FILTER (billing_id = servicing_id) AS self_lines, COALESCE({_money("CASE WHEN billing_id = servicing_id THEN paid END")}, 0) AS self_paid FROM opaid WHERE billing_id IN (SELECT billing_id FROM claims WHERE status = 'A' AND {_COHORT}) GROUP BY 1),
mc AS (SELECT top_other_biller AS billing_id, STRING_AGG(CAST(servicing_id AS VARCHAR), ', ' ORDER BY servicing_id) AS matched_clinicians FROM (SELECT DISTINCT top_other_biller, servicing_id FROM pattern WHERE pattern IN ('Full', 'Close') AND top_other_biller IS NOT NULL) GROUP BY 1)"""
    extra = "billing_id IN (SELECT billing_id FROM n WHERE servicing_id = 7) AS reference_bills_here, matched_clinicians, self_lines, ROUND(CAST(self_lines AS DOUBLE) * 100 / lines, 6) AS pct_self_lines, self_paid"
    return TRENDS + _assembled("o", "billing_id", "mlooks", "bfull", extra, parts) + " LEFT JOIN mc USING (billing_id) LEFT JOIN (SELECT * FROM role WHERE self_lines > 0 AND self_lines < lines) USING (billing_id)"


#: Rules derived from parts, and the verdict of the first check that each fails; notes in the order in which they are joined.
_GATE = """WITH r AS (SELECT 'rule-' || p_partkey AS rule_id, ['edit_file', 'state', 'manual'][p_partkey % 3 + 1] AS origin, CASE WHEN p_partkey % 31 <> 0 THEN p_name END AS statement, CASE WHEN p_partkey % 37 <> 0 THEN 'manual' END AS source,
  CASE WHEN p_partkey % 4 <> 0 THEN [' x' || p_size, ' '] ELSE CAST([] AS VARCHAR[]) END AS given, ['all', 'Members under 21', '', 'ALL MEMBERS', NULL][p_partkey % 5 + 1] AS population, p_partkey % 11 <> 0 AS checkable, p_partkey % 13 = 0 AS ambiguous, p_partkey % 6 = 0 AS lacks,
  CASE WHEN p_partkey % 29 <> 0 THEN ['code_pair_prohibited', 'unit_limit', 'code_requires_modifier', 'age_limit', 'frequency_limit', 'not_checkable', 'unheard_of'][p_partkey % 7 + 1] END AS kind, UPPER(TRIM(' a' || p_size)) AS a, COALESCE(CASE WHEN p_partkey % 7 <> 0 THEN 'A' || (p_size + p_partkey % 2) END, '') AS b,
  COALESCE(CASE WHEN p_partkey % 3 = 0 THEN UPPER(TRIM(p_brand)) END, '') AS c, [NULL, '0', '1', ' 1', '7', ''][p_partkey % 6 + 1] AS modifier, p_partkey % 5 = 0 AS aged, p_size % 30 AS low, CASE WHEN p_partkey % 2 = 0 THEN p_size % 40 END AS high FROM part),
r1 AS (SELECT *, COALESCE(TRIM(statement), '') = '' OR COALESCE(TRIM(source), '') = '' OR COALESCE(TRIM(kind), '') = '' AS rejected, [UPPER(TRIM(g)) FOR g IN given IF TRIM(g) <> ''] AS own, [g FOR g IN [a, CASE WHEN b <> a THEN b END, CASE WHEN c <> a AND c <> b THEN c END] IF COALESCE(g, '') <> ''] AS named,
  CASE WHEN COALESCE(TRIM(modifier), '') = '' THEN '0' WHEN TRIM(modifier) IN ('0', '1') THEN TRIM(modifier) END AS indicator, origin <> 'edit_file' AS foreign_, aged AND low <= COALESCE(high, 150) AS valid, LOWER(TRIM(COALESCE(population, 'all'))) NOT IN ('', 'all', 'any', 'all members') AS scoped FROM r),
r2 AS (SELECT *, kind = 'code_pair_prohibited' AND foreign_ AS own_pair, kind IN ('code_pair_prohibited', 'unit_limit', 'age_limit') AS runs, CASE WHEN kind = 'unit_limit' AND c = '' THEN 'a unit limit names no code' WHEN kind = 'age_limit' AND NOT valid THEN 'an age limit has no usable age' WHEN aged AND NOT valid THEN 'its age cannot be used' END AS malformed FROM r1 WHERE NOT rejected),
r3 AS (SELECT *, CASE WHEN NOT checkable THEN 99 WHEN kind = 'unheard_of' THEN 0 WHEN NOT runs AND kind <> 'not_checkable' THEN 1 WHEN kind = 'not_checkable' THEN 2 WHEN lacks THEN 3 WHEN scoped AND NOT (valid AND foreign_) THEN 4 WHEN kind = 'code_pair_prohibited' AND (a = '' OR b = '' OR a = b) THEN 5 WHEN own_pair AND indicator IS NULL THEN 6 WHEN runs AND malformed IS NOT NULL THEN 7 ELSE 99 END AS failed FROM r2),
r4 AS (SELECT *, CASE failed WHEN 0 THEN 'no such predicate type: ' || kind WHEN 1 THEN 'nothing runs predicates of type ' || kind WHEN 3 THEN 'claims lack shoe_size' WHEN 4 THEN 'no condition selects the population ' || population WHEN 5 THEN 'a pair needs two different codes' WHEN 6 THEN 'unusable modifier indicator: ' || modifier WHEN 7 THEN malformed END AS note,
  CASE failed WHEN 0 THEN 'predicate_not_in_grammar' WHEN 1 THEN 'predicate_not_in_grammar' WHEN 2 THEN 'no_claim_field' WHEN 3 THEN 'missing_claim_field' WHEN 4 THEN 'requires_member_attribute' WHEN 5 THEN 'ambiguous_source' WHEN 6 THEN 'ambiguous_source' WHEN 7 THEN 'ambiguous_source' END AS why,
  own <> given AS tidied, LEN(own) = 0 AND LEN(named) > 0 AS filled, checkable AND failed > 6 AND own_pair AND modifier IS DISTINCT FROM indicator AS reset_, checkable AND failed > 4 AND scoped AND valid AND foreign_ AS by_age FROM r3),
accepted AS (SELECT rule_id, ARRAY_TO_STRING(CASE WHEN LEN(own) = 0 THEN named ELSE own END, ',') AS codes, checkable AND failed = 99 AS machine_checkable, COALESCE(why, CASE WHEN kind = 'not_checkable' THEN 'no_claim_field' END) AS not_checkable_reason,
  CASE WHEN note IS NOT NULL THEN 'downgraded' WHEN ambiguous OR NOT (checkable AND failed = 99) THEN 'needs_review' WHEN tidied OR filled OR reset_ THEN 'patched' ELSE 'clean' END AS validation_status,
  CONCAT_WS('; ', CASE WHEN tidied THEN 'codes tidied' END, CASE WHEN filled THEN 'codes taken from the predicate' END, CASE WHEN by_age THEN 'age stands for the population ' || population END, CASE WHEN reset_ THEN 'modifier indicator set to ' || indicator END, note) AS gate_notes FROM r4)"""
#: What must hold of the queue, each a count of what breaks it.
_INVARIANTS = f"""SELECT 'line ids are unique' AS "check", COUNT(*) AS violations FROM (SELECT line_id FROM paid GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'flagged lines belong to their entity', COUNT(*) FILTER (CASE WHEN entity_type = 'billing' THEN billing_id ELSE servicing_id END IS DISTINCT FROM entity_id) FROM lines
UNION ALL SELECT 'dollars at risk are within dollars paid', COUNT(*) FILTER (COALESCE(pct_dollars_at_risk > 1 + 1e-9, TRUE)) FROM q
UNION ALL SELECT 'one queue row per flagged entity', (SELECT COUNT(*) FROM (SELECT DISTINCT entity_id, entity_type FROM hits) h FULL JOIN (SELECT entity_id, entity_type, COUNT(*) AS k FROM q GROUP BY ALL) k USING (entity_id, entity_type) WHERE h.entity_id IS NULL OR k.k IS DISTINCT FROM 1)
UNION ALL SELECT 'corroboration has enough families and members', COUNT(*) FILTER (corroborated AND (independent_families < 2 OR members_flagged < 2)) FROM q
UNION ALL SELECT 'tiers above Contributing are corroborated', COUNT(*) FILTER (tier_label <> 'Contributing' AND NOT corroborated) FROM q
UNION ALL SELECT 'untrusted rules add no dollars at risk', COUNT(*) FILTER (dollars_at_risk > dollars_incl_untrusted + 0.01) FROM q
UNION ALL SELECT 'flagged dollars are within paid dollars', COUNT(*) FILTER (a > b + 0.01) FROM (SELECT (SELECT COALESCE({_money("paid")}, 0) FROM (SELECT DISTINCT line_id, paid FROM lines WHERE rule_id <> 'R6')) AS a, (SELECT COALESCE({_money("paid")}, 0) FROM paid) AS b)"""


def _spread(strong: float, rounds: int = 60) -> str:
    """Label propagation, a round at a time; of neighbours that want to move, the one that gains most does."""
    votes = "SELECT e.id, l.label, ROUND(SUM(pmi), 6) AS w FROM e JOIN lp l ON l.id = e.other GROUP BY ALL"
    wants = f"""SELECT a.k, a.id, a.label, t.label AS new, ROUND(t.w - COALESCE(o.w, 0), 6) AS gain FROM lp a JOIN (SELECT * FROM ({votes}) QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY w DESC, label) = 1) t ON t.id = a.id LEFT JOIN ({votes}) o ON o.id = a.id AND o.label = a.label"""
    return f"""{_paid(False)}, {_PAIRS}, strong AS (SELECT * FROM pairs WHERE pmi >= {strong}), e AS MATERIALIZED (SELECT pa AS id, pb AS other, pmi FROM strong UNION ALL SELECT pb, pa, pmi FROM strong),
lp AS (SELECT 0 AS k, id, id AS label FROM (SELECT DISTINCT id FROM e) UNION ALL SELECT x.k + 1, x.id, CASE WHEN x.gain > 0 AND (r.rival IS NULL OR r.rival < STRUCT_PACK(g := x.gain, i := -x.id)) THEN x.new ELSE x.label END
  FROM ({wants}) x LEFT JOIN (SELECT e.id, MAX(STRUCT_PACK(g := v.gain, i := -v.id)) AS rival FROM e JOIN ({wants}) v ON v.id = e.other WHERE v.gain > 0 GROUP BY e.id) r ON r.id = x.id WHERE x.k < {rounds}),
settled AS (SELECT id, label AS community FROM lp WHERE k = {rounds})"""


_STATS = """keys AS (SELECT entity_id, entity_type, rule_id, family, UNNEST(line_keys[:5]) AS key, UNNEST(RANGE(LEN(line_keys[:5]))) AS i, hit_dollars, ARRAY_TO_STRING(line_keys[:5], '|') AS k FROM hits),
firsts AS (SELECT * EXCLUDE (key), key FROM keys QUALIFY ROW_NUMBER() OVER (PARTITION BY entity_id, entity_type, rule_id, family ORDER BY hit_dollars DESC, k, i) <= 5),
ex AS (SELECT entity_id, entity_type, rule_id, family, STRING_AGG(key, ',' ORDER BY hit_dollars DESC, k, i) AS example_keys FROM firsts GROUP BY ALL),
stats AS (SELECT entity_id, entity_type, rule_id, family, COUNT(*) AS occasions, COUNT(DISTINCT member_id) AS members, ROUND(MAX(metric), 6) AS peak, COUNT(*) FILTER (rule_id = 'R5' AND detail LIKE 'price%') AS by_price, COUNT(*) FILTER (rule_id = 'R5' AND detail LIKE '%stacked') AS by_lines,
  COUNT(*) FILTER (detail LIKE '%one code alone%') AS single_code_days, ANY_VALUE(example_keys) AS example_keys FROM hits JOIN ex USING (entity_id, entity_type, rule_id, family) GROUP BY ALL)"""


def _leads() -> str:
    """The texts of the leads: templates with their marks filled in, findings numbered, and the grounds wrapped a word at a time."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    table = ", ".join(f"('{rule}', {quoted(title)}, {quoted(body)})" for rule, (title, body) in FINDINGS.items())
    banned = " OR ".join(f"CONTAINS(LOWER(lead), '{x}')" for x in BANNED)
    return QUEUE + f""", {_STATS}, texts AS (SELECT * FROM (VALUES {table}) t(rule_id, title, body)), {_NAMES},
nc AS (SELECT entity_id, entity_type, name, ptype, COUNT(*) AS n FROM names GROUP BY ALL), nk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_id, entity_type ORDER BY n DESC, name NULLS FIRST, ptype NULLS FIRST) AS rk FROM nc), nm AS (SELECT *, MAX(CASE WHEN rk = 1 THEN name END) OVER (PARTITION BY entity_id, entity_type) AS main FROM nk),
named AS (SELECT entity_id, entity_type, MAX(CASE WHEN rk = 1 THEN name END) AS name, MAX(CASE WHEN rk = 1 THEN ptype END) AS ptype, STRING_AGG(DISTINCT name, '; ' ORDER BY name) FILTER (rk > 1 AND name <> main) AS other_names FROM nm GROUP BY ALL),
found AS (SELECT s.*, t.title, REPLACE(REPLACE(REPLACE(body, '{{n}}', CAST(occasions AS VARCHAR)), '{{members}}', CAST(members AS VARCHAR)), '{{peak}}', FORMAT('{{:.0f}}', ROUND(peak)))
  || CASE WHEN s.rule_id = 'R5' THEN ' By amount: ' || by_price || '; by lines: ' || by_lines || '.' WHEN s.rule_id = 'R1' AND single_code_days > 0 THEN ' On ' || single_code_days || ' of them one code alone passes the limit.' ELSE '' END || ' Examples: ' || REPLACE(example_keys, ',', ', ') AS sentence FROM stats s JOIN texts t USING (rule_id)),
listed AS (SELECT entity_id, entity_type, STRING_AGG(k || '. ' || title || tag || ': ' || sentence, CHR(10) ORDER BY k) AS body FROM (SELECT f.*, CASE WHEN LIST_CONTAINS(STRING_SPLIT(families, ','), f.family) THEN '' ELSE ' (not independent)' END AS tag, ROW_NUMBER() OVER (PARTITION BY entity_id, entity_type ORDER BY f.rule_id) AS k FROM found f JOIN q USING (entity_id, entity_type) WHERE corroborated) GROUP BY ALL),
words AS (SELECT entity_id, entity_type, STRING_SPLIT('Grounds: ' || independent_families || ' independent kind(s) of pattern (' || families || '), ' || members_flagged || ' member(s), ' || member_days_flagged || ' member-day(s).', ' ') AS ws FROM q WHERE corroborated),
wrap AS (SELECT entity_id, entity_type, ws, 1 AS i, '' AS done, ws[1] AS line FROM words UNION ALL
  SELECT entity_id, entity_type, ws, i + 1, CASE WHEN LENGTH(line) + 1 + LENGTH(ws[i + 1]) <= 70 THEN done ELSE done || line || CHR(10) END, CASE WHEN LENGTH(line) + 1 + LENGTH(ws[i + 1]) <= 70 THEN line || ' ' || ws[i + 1] ELSE ws[i + 1] END FROM wrap WHERE i < LEN(ws)),
grounds AS (SELECT entity_id, entity_type, done || line || CHR(10) AS grounds FROM wrap WHERE i = LEN(ws)),
leads AS (SELECT q.entity_id, q.entity_type, tier_label, independent_families, CONCAT_WS(CHR(10), 'Lead: ' || CONCAT_WS(' ', q.entity_type, 'provider', q.entity_id, name, '[' || tier_label || ']'), grounds, FORMAT('Dollars at risk: {{:.2f}} of {{:.2f}} paid.', dollars_at_risk, total_paid), body,
  'Next: request records of the example lines and compare with the schedule.', {quoted(BASIS)}) AS lead FROM q JOIN listed USING (entity_id, entity_type) JOIN grounds USING (entity_id, entity_type) LEFT JOIN named USING (entity_id, entity_type) WHERE corroborated),
titles AS (SELECT entity_id, entity_type, STRING_AGG(DISTINCT title, '; ' ORDER BY title) AS findings, STRING_AGG(DISTINCT rule_id, ', ' ORDER BY rule_id) AS rule_codes FROM found GROUP BY ALL),
reasons AS (SELECT 'claims' AS data_source, entity_id, entity_type, name, other_names, ptype, tier_label, independent_families, families AS grounds, members_flagged, member_days_flagged, dollars_at_risk, pct_dollars_at_risk, total_paid, last_svc_dt, days_before_data_end, data_end_date, rule_codes, findings
  FROM q LEFT JOIN named USING (entity_id, entity_type) LEFT JOIN titles USING (entity_id, entity_type) WHERE corroborated),
banned AS (SELECT COUNT(*) FILTER ({banned}) AS n FROM leads)"""


LEADS = _leads()
_CHECKED = """, k AS (SELECT entity_id, entity_type FROM q WHERE corroborated) SELECT 'leads match the queue' AS "check", (SELECT COUNT(*) FROM k FULL JOIN leads l USING (entity_id, entity_type) WHERE l.lead IS NULL OR (entity_id, entity_type) NOT IN (SELECT (entity_id, entity_type) FROM k)) AS violations
UNION ALL SELECT 'the table matches the queue', (SELECT COUNT(*) FROM k FULL JOIN reasons r USING (entity_id, entity_type) WHERE r.data_source IS NULL OR (entity_id, entity_type) NOT IN (SELECT (entity_id, entity_type) FROM k)) UNION ALL SELECT 'shares are within 1', COUNT(*) FILTER (pct_dollars_at_risk > 1.000000001) FROM reasons UNION ALL SELECT 'no banned phrase', n FROM banned"""
#: The first 15 of the queue, a row for each of their ten largest hits.
_CARDS = """, top AS (SELECT * FROM q WHERE corroborated ORDER BY CASE tier_label WHEN 'Strong' THEN 0 WHEN 'Moderate' THEN 1 ELSE 2 END, independent_families DESC, risk_score DESC, entity_id, entity_type LIMIT 15),
held AS (SELECT h.*, ARRAY_TO_STRING(line_keys[:20], '|') AS ek FROM hits h SEMI JOIN top USING (entity_id, entity_type)),
ten AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY entity_id, entity_type ORDER BY hit_dollars DESC, rule_id, member_id NULLS FIRST, ek) AS INTEGER) AS place FROM held QUALIFY place <= 10)
SELECT t.entity_id, t.entity_type, tier_label, independent_families, families, rules, members_flagged, total_paid, dollars_at_risk, pct_dollars_at_risk, place, rule_id, family, title, tier, member_id, cos, hit_dollars, ARRAY_TO_STRING(line_keys[:5], ',') AS example_keys FROM top t JOIN ten USING (entity_id, entity_type)"""


def _dups(where: str) -> str:
    """Duplicate groups among lines that share a service with those where the condition holds."""
    return f"""WITH {_claims(True)}, base AS (SELECT * FROM claims WHERE status = 'A'), keys AS (SELECT DISTINCT member_id, code, svc_dt FROM base WHERE {where}), elig AS (SELECT base.* FROM base SEMI JOIN keys USING (member_id, code, svc_dt) WHERE paid > 0 AND (lob IS NULL OR lob <> 'MSP')),
per AS (SELECT member_id, code, svc_dt, billing_id, {_money("paid")} AS paid, SUM(qty) AS units, COUNT(*) AS lines, LIST(DISTINCT servicing_id) AS servicers FROM elig GROUP BY ALL),
grp AS (SELECT member_id, code, svc_dt, COUNT(*) AS n_billers, LIST_SORT(LIST(billing_id)) AS billers, LIST_SORT(LIST_DISTINCT(FLATTEN(LIST(servicers)))) AS servicers, COUNT(DISTINCT units) AS unit_values, {_money("paid")} AS paid_total,
  CAST(SUM(CAST(paid AS DECIMAL(18,2))) - MAX(CAST(paid AS DECIMAL(18,2))) AS DOUBLE) AS possible_duplicate_paid, CAST(SUM(lines) AS BIGINT) AS lines, COUNT(DISTINCT units) = 1 AS same_units FROM per GROUP BY ALL HAVING COUNT(*) >= 2),
shown AS (SELECT * REPLACE (ARRAY_TO_STRING(billers, ',') AS billers, ARRAY_TO_STRING(servicers, ',') AS servicers) FROM grp)"""


_DAILY = "{0}, svc_dt, SUM(qty) AS units, COUNT(DISTINCT member_id) AS members, SUM(minutes) / 60 AS hours"
_VOLUME = """SELECT servicing_id, COUNT(*) AS days, ROUND(AVG(units), 6) AS avg_units_day, MAX(units) AS max_units_day, ROUND(AVG(members), 6) AS avg_members_day, MAX(members) AS max_members_day, ROUND(AVG(hours), 6) AS avg_hours_day, MAX(hours) AS max_hours_day,
  QUANTILE_DISC(units, 0.5) AS med_units_day, QUANTILE_DISC(members, 0.5) AS med_members_day, QUANTILE_DISC(hours, 0.5) AS med_hours_day FROM dd GROUP BY servicing_id"""
_TOTALS = f"SELECT {{0}}, SUM(qty) AS units, {_money('paid')} AS paid, COUNT(DISTINCT member_id) AS members, COUNT(DISTINCT {{1}}) AS counterparties, COUNT(DISTINCT code) AS codes, COUNT(*) AS lines FROM n GROUP BY {{0}}"
_PEERS = ", ".join(f"QUANTILE_DISC({c}, 0.5) AS {c}" for c in ("units", "paid", "members", "counterparties", "codes", "lines"))
#: All measures of the first sheet in each window: the target beside the median of its peers.
_MEASURES = [*[f"{f}_{c}_day" for f in ("avg", "max", "med") for c in ("units", "members", "hours")], "days", *[f"pct_days_over_{h}h" for h in (4, 8, 12, 16, 20, 24)], "units", "paid", "members", "counterparties", "codes", "lines"]
_WINDOW_REPORTS = f""", dd AS (SELECT win, servicing_id, svc_dt, SUM(qty) AS units, COUNT(DISTINCT member_id) AS members, SUM(minutes) / 60 AS hours FROM nw GROUP BY ALL),
vol AS (SELECT win, servicing_id, COUNT(*) AS days, {", ".join(f"AVG({c}) AS avg_{c}_day, MAX({c}) AS max_{c}_day, QUANTILE_DISC({c}, 0.5) AS med_{c}_day" for c in ("units", "members", "hours"))}, {", ".join(f"SUM(CASE WHEN hours > {h} THEN 1 WHEN hours IS NOT NULL THEN 0 END) * 100.0 / COUNT(*) AS pct_days_over_{h}h" for h in (4, 8, 12, 16, 20, 24))} FROM dd GROUP BY ALL),
tot AS (SELECT win, servicing_id, SUM(qty) AS units, {_money("paid")} AS paid, COUNT(DISTINCT member_id) AS members, COUNT(DISTINCT billing_id) AS counterparties, COUNT(DISTINCT code) AS codes, COUNT(*) AS lines FROM nw GROUP BY ALL),
w AS (UNPIVOT (SELECT win, servicing_id, {", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in _MEASURES)} FROM vol JOIN tot USING (win, servicing_id)) ON {", ".join(_MEASURES)} INTO NAME metric VALUE value),
z AS (SELECT win, metric, MAX(CASE WHEN servicing_id = 7 THEN value END) AS target, QUANTILE_DISC(CASE WHEN servicing_id <> 7 THEN value END, 0.5) AS peer FROM w GROUP BY ALL)
SELECT win AS "window", metric, ROUND(target, 6) AS target, ROUND(peer, 6) AS peer_median, CASE WHEN peer > 0 THEN ROUND(target / peer, 1) END AS ratio FROM z"""
_FILES = """WITH o AS (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN 'ptp' ELSE 'mue' END AS kd, CASE o_custkey % 3 WHEN 0 THEN 'practitioner' WHEN 1 THEN 'outpatient' ELSE 'dme' END AS sv FROM orders),
f AS (SELECT DISTINCT '/drop/' || (o_orderkey % 2) || '/' || CASE WHEN o_orderkey % 97 = 0 THEN 'edits_' || o_orderkey || '.txt' WHEN o_orderkey % 89 = 0 THEN 'notes_' || o_orderkey || '.pdf' ELSE kd || '_' || sv || '_' || YEAR(o_orderdate) || 'q' || QUARTER(o_orderdate) || '_r' || (o_orderkey % 3) || '.txt' END AS path,
  CASE WHEN o_orderkey % 97 = 0 THEN 'error' WHEN o_orderkey % 89 = 0 THEN 'other' ELSE 'edit' END AS kind, kd, sv, YEAR(o_orderdate) || 'Q' || QUARTER(o_orderdate) AS qr, o_orderkey % 3 AS rv FROM o),
c AS (SELECT DISTINCT path, CASE WHEN kind = 'edit' THEN kd END AS edit, CASE WHEN kind = 'edit' THEN sv END AS service, CASE WHEN kind = 'edit' THEN qr END AS quarter, CASE WHEN kind = 'edit' THEN CAST(rv AS INTEGER) END AS revision, kind FROM f)"""
#: Two loads of the same files by their names and their orders' rows; what a load says is loaded decides the next one.
_EDIT_LOAD = """, e AS (SELECT '/drop/' || (o_orderkey % 2) || '/' || kd || '_' || sv || '_' || YEAR(o_orderdate) || 'q' || QUARTER(o_orderdate) || '_r' || (o_orderkey % 3) || '.txt' AS path, COUNT(*) AS rows,
  MIN(CASE WHEN kd = 'ptp' AND o_orderkey % 997 = 0 THEN 'bad date' WHEN kd = 'mue' AND o_orderkey % 991 = 0 THEN 'limit is no number' END) AS bad FROM o WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0 GROUP BY 1),
b AS (SELECT c.*, batch, COUNT(*) OVER (PARTITION BY batch, quarter, edit, service, revision) > 1 AND kind = 'edit' AS twice, batch = 'first' AND kind = 'edit' AND quarter > '1999Q4' AS aside FROM c, (VALUES ('first'), ('second')) x(batch) WHERE kind <> 'other' AND (batch = 'second' OR COALESCE(revision, 0) < 2)),
r AS (SELECT *, CASE WHEN kind = 'edit' AND NOT twice AND NOT aside THEN ROW_NUMBER() OVER (PARTITION BY batch, kind, twice, aside, quarter, edit, service ORDER BY revision DESC, path) END AS rk FROM b),
f1 AS (SELECT r.* EXCLUDE (batch), CASE WHEN kind = 'error' OR twice THEN 'failed' WHEN aside THEN 'archived_only' WHEN rk > 1 THEN 'superseded' WHEN bad IS NOT NULL THEN 'failed' ELSE 'loaded' END AS status, rows, bad FROM r LEFT JOIN e USING (path) WHERE batch = 'first'),
l1 AS (SELECT quarter, edit, service, revision AS old, path AS old_path FROM f1 WHERE status = 'loaded'),
f2 AS (SELECT r.* EXCLUDE (batch), old_path, CASE WHEN kind = 'error' OR twice THEN 'failed' WHEN rk > 1 THEN 'superseded' WHEN revision <= old THEN 'skipped_exists' WHEN bad IS NOT NULL THEN 'failed' WHEN old IS NULL THEN 'loaded' ELSE 'replaced' END AS status, rows, bad FROM r LEFT JOIN e USING (path) LEFT JOIN l1 USING (quarter, edit, service) WHERE batch = 'second'),
u AS (SELECT 'first' AS batch, 1 AS version, * EXCLUDE (kind), kind, CAST(NULL AS VARCHAR) AS old_path FROM f1 UNION ALL BY NAME SELECT 'second' AS batch, 2 AS version, * FROM f2),
v AS (SELECT *, status IN ('loaded', 'replaced') OR (status = 'failed' AND rk = 1) AS parsed, CASE WHEN status IN ('loaded', 'replaced') THEN version = MAX(version) FILTER (status IN ('loaded', 'replaced')) OVER (PARTITION BY quarter, edit, service) END AS live FROM u)
SELECT batch, quarter, edit, service, revision, status, CASE WHEN parsed THEN rows END AS rows, CASE WHEN parsed THEN 2 END AS tolerated_rows, CASE WHEN kind = 'error' THEN 'name not understood' WHEN twice THEN 'two files for one key' WHEN parsed THEN bad END AS error, path,
  CASE WHEN status = 'replaced' THEN old_path END AS replaced_path, CASE WHEN live THEN rows WHEN live IS NOT NULL THEN 0 END AS live_rows FROM v"""
_CODE = f"""{SVC}, base AS (SELECT code, K, SUM(qty) AS units, COUNT(DISTINCT member_id) AS members, COUNT(DISTINCT svc_dt) AS days, COUNT(*) AS lines, {_money("paid")} AS paid, SUM(minutes) AS minutes FROM n GROUP BY ALL),
cd AS (SELECT code, K, svc_dt, COUNT(DISTINCT member_id) AS m, CASE WHEN SUM(minutes) > 0 THEN SUM(minutes) / 60 END AS hours FROM n GROUP BY ALL), ca AS (SELECT code, K, ROUND(AVG(m), 6) AS members_day, QUANTILE_DISC(m, 0.5) AS med_members_day, MAX(m) AS max_members_day, {_shares("pct_days_over")} FROM cd GROUP BY ALL),
cs AS (SELECT code, K, ROUND(AVG(h), 6) AS avg_session, ROUND(QUANTILE_DISC(h, 0.5), 6) AS med_session, ROUND(MAX(h), 6) AS max_session FROM (SELECT code, K, member_id, svc_dt, SUM(minutes) / 60 AS h FROM n GROUP BY ALL HAVING SUM(minutes) > 0) GROUP BY ALL),
profile AS (SELECT base.* EXCLUDE (minutes), ca.* EXCLUDE (code, K), cs.* EXCLUDE (code, K), CASE WHEN minutes > 0 THEN minutes / 60 END AS hours, units / days AS units_day, CASE WHEN minutes > 0 THEN minutes / 60 / days END AS hours_day, units / members AS units_member, paid / units AS paid_unit
  FROM base JOIN ca ON base.code = ca.code AND base.K = ca.K LEFT JOIN cs ON base.code = cs.code AND base.K = cs.K)"""

PROFILE = ["units", "members", "days", "lines", "paid", "members_day", "med_members_day", "max_members_day", *[f"pct_days_over_{h}h" for h in (4, 8, 12, 16, 20, 24)], "avg_session", "med_session", "max_session", "hours", "units_day", "hours_day", "units_member", "paid_unit"]
_UNROUNDED = "ROUND(hours, 6) AS hours, ROUND(units_day, 6) AS units_day, ROUND(hours_day, 6) AS hours_day, ROUND(units_member, 6) AS units_member, ROUND(paid_unit, 6) AS paid_unit"

ORACLES: dict[str, str] = {
    "r1_hours": _rule("R1"), "r2_units": _rule("R2"), "r3_transport": _rule("R3", False), "r4_fanout": _rule("R4", False), "r5_facility": _rule("R5"), "r6_duplicate": _rule("R6"), "r7_volume": _rule("R7"), "r8a_renderers": _rule("R8A"),
    "r8b_billers": _rule("R8B"), "r9_cross_biller": _rule("R9"), "r10_role": _rule("R10"),
    "flagged_lines": LINES + " SELECT * FROM lines",
    "dollars_at_risk": LINES + f", {_DOLLARS} SELECT * FROM dollars",
    "risk_score": HITS + f", {_SCORE} SELECT entity_id, entity_type, ROUND(risk_score, 6) AS risk_score FROM score",
    "provider_context": f"{_paid()}, {_CONTEXT} SELECT * FROM context",
    "independent_families": LINES + f", {_FOLD} SELECT * FROM indep",
    "queue": QUEUE + " SELECT * FROM q",
    "tier_mix": QUEUE + " SELECT entity_type, tier_label, COUNT(*) AS entities FROM q GROUP BY ALL",
    "hits_per_rule": HITS + " SELECT rule_id, family, tier, entity_type, COUNT(*) AS hits, rule_id = 'R6' AS untrusted FROM hits GROUP BY ALL",
    "biller_pmi": f"{_paid(False)}, {_PAIRS} SELECT pa, pb, shared, sza, szb, ROUND(pmi, 6) AS pmi, ROUND(jaccard, 6) AS jaccard FROM pairs WHERE pmi >= 0",
    "member_fanout": f"{_paid(False)} SELECT member_id, COUNT(DISTINCT billing_id) AS fanout FROM paid GROUP BY member_id",
    "connected_components": f"{_paid(False)}, {_PAIRS}, e AS (SELECT pa AS a, pb AS b FROM pairs WHERE pmi >= 0.6 UNION SELECT pb, pa FROM pairs WHERE pmi >= 0.6), r AS (SELECT a AS x, a AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a) SELECT x AS id, MIN(y) AS component FROM r GROUP BY x",
    "label_propagation": _spread(0.6) + " SELECT * FROM settled",
    "modularity": _spread(0.6) + """, w AS (SELECT SUM(pmi) AS m FROM strong), n AS (SELECT s.pmi, a.community AS ca, b.community AS cb FROM strong s JOIN settled a ON a.id = pa JOIN settled b ON b.id = pb),
g AS (SELECT community, SUM(CASE WHEN ca = cb THEN pmi / 2 ELSE 0 END) AS inside, SUM(pmi) AS degree FROM (SELECT ca AS community, ca, cb, pmi FROM n UNION ALL SELECT cb, ca, cb, pmi FROM n) GROUP BY 1), z AS (SELECT community, COUNT(*) AS members FROM settled GROUP BY 1)
SELECT community, members, ROUND(inside, 6) AS inside, ROUND(degree, 6) AS degree, ROUND(inside / m - POW(degree / (2 * m), 2), 6) AS modularity FROM g JOIN z USING (community), w""",
    "top_edges": f"{_paid(False)}, {_PAIRS} SELECT pa, pb, shared, sza, szb, ROUND(pmi, 6) AS pmi, ROUND(jaccard, 6) AS jaccard, CAST(ROW_NUMBER() OVER (ORDER BY pmi DESC, pa, pb) AS INTEGER) AS place FROM pairs WHERE pmi >= 0 QUALIFY place <= 200",
    "invariants": QUEUE + " " + _INVARIANTS,
    "provider_names": f"WITH {_claims(True)}, {_NAMES}, c AS (SELECT entity_id, entity_type, name, ptype, COUNT(*) AS n FROM names GROUP BY ALL), k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_id, entity_type ORDER BY n DESC, name NULLS FIRST, ptype NULLS FIRST) AS rk FROM c), m AS (SELECT *, MAX(CASE WHEN rk = 1 THEN name END) OVER (PARTITION BY entity_id, entity_type) AS main FROM k) SELECT entity_id, entity_type, MAX(CASE WHEN rk = 1 THEN name END) AS name, MAX(CASE WHEN rk = 1 THEN ptype END) AS ptype, STRING_AGG(DISTINCT name, '; ' ORDER BY name) FILTER (rk > 1 AND name <> main) AS other_names FROM m GROUP BY ALL",
    "rule_stats": HITS + f", {_STATS} SELECT * FROM stats",
    "case_leads": LEADS + " SELECT entity_id, entity_type, tier_label, independent_families, lead FROM leads",
    "reasons": LEADS + " SELECT * FROM reasons",
    "check_leads": LEADS + _CHECKED,
    "evidence_cards": QUEUE + _CARDS,
    "drill_down": LINES + " SELECT l.rule_id, l.family, l.tier, l.line_id, p.svc_dt, p.member_id, code, cos, qty, p.paid, claim_id FROM lines l JOIN paid p USING (line_id) WHERE entity_id = 3 AND entity_type = 'billing'",
    "clinician_day": DAYS + " SELECT * REPLACE (ROUND(r24, 6) AS r24, ROUND(rcap, 6) AS rcap) FROM days",
    "line_exposure": DAYS + " SELECT * REPLACE (ROUND(over24, 6) AS over24, ROUND(overcap, 6) AS overcap) FROM x",
    "exposure_by_clinician": DAYS + " " + _exposure("servicing_id"), "exposure_by_biller": DAYS + " " + _exposure("billing_id"),
    "recovery_dollars": DAYS + f", rn AS (SELECT * FROM n WHERE svc_dt >= (SELECT MAX(svc_dt) FROM n) - INTERVAL 24 MONTH), rx AS (SELECT * FROM x WHERE svc_dt >= (SELECT MAX(svc_dt) FROM x) - INTERVAL 24 MONTH), t AS (SELECT servicing_id, {_money('paid')} AS total_paid FROM rn GROUP BY ALL), e AS ({_exposure('servicing_id', 'rx')}) SELECT * FROM t LEFT JOIN e USING (servicing_id)",
    "cookie_cutter": SVC + f", {_patterns('b', 'billing_id', 'billing_id, servicing_id', 'n')} SELECT * FROM bcut",
    "pattern_sizes": SVC + f", {_patterns('s', 'servicing_id', 'servicing_id', 'n')} SELECT servicing_id, COUNT(*) AS patterns, ROUND(AVG(size), 6) AS avg_members, MAX(size) AS max_members FROM sdup WHERE size >= 2 GROUP BY ALL",
    "repeat_packages": SVC + f", {_patterns('s', 'servicing_id', 'servicing_id', 'n')} SELECT servicing_id, repeat_members, ROUND(avg_repeats, 6) AS avg_repeats, max_repeats FROM srep",
    "session_hours": SVC + f", {_patterns('s', 'servicing_id', 'servicing_id', 'n')} SELECT servicing_id, ROUND(avg_session_hours, 6) AS avg_session_hours FROM sses",
    "top_code_share": SVC + f", {_patterns('s', 'servicing_id', 'servicing_id', 'n')} SELECT * FROM stop",
    "servicing_features": WINDOWS + f', {_SERVING} SELECT win AS "window", * EXCLUDE (win) FROM sdone',
    "billing_features": WINDOWS + f', {_BILLING} SELECT win AS "window", * EXCLUDE (win), ROUND(COALESCE(paid_on_cap_days * 100 / NULLIF(timed_paid, 0), 0), 6) AS pct_timed_paid_on_cap_days FROM bdone',
    "lookalike_score": WINDOWS + f', {_RANKS} SELECT win AS "window", servicing_id, n_red_flags, red_flags, ROUND(signature_match, 6) AS signature_match, ROUND(similarity, 6) AS similarity, servicing_id = 7 AS is_reference, servicing_id = 7 OR (n_red_flags >= 3 AND COALESCE(signature_match >= 0.6, FALSE)) AS is_hit FROM looks',
    "signature_features": WINDOWS + f", {_RANKS} SELECT win AS \"window\", 'servicing' AS level, '7' AS reference, COUNT(*) AS n, STRING_AGG(feature, ', ' ORDER BY feature) AS features FROM ref WHERE ref >= 0.9 GROUP BY ALL",
    "pattern_table": WINDOWS + f', {_PATTERN} SELECT win AS "window", * EXCLUDE (win, driven) REPLACE (CAST(days_over_24h AS BIGINT) AS days_over_24h, CAST(days_over_24h_with_other AS BIGINT) AS days_over_24h_with_other, ROUND(other_share, 6) AS other_share, ROUND(self_units_per_day, 6) AS self_units_per_day, ROUND(other_units_per_day, 6) AS other_units_per_day, ROUND(units_ratio, 6) AS units_ratio) FROM pattern',
    "primary_billers": WINDOWS + f", {_PATTERN} SELECT win AS \"window\", top_other_biller AS billing_id, ARRAY_TO_STRING(LIST_SORT(LIST(DISTINCT servicing_id)), ',') AS matched_clinicians FROM pattern WHERE pattern IN ('Full', 'Close') AND top_other_biller IS NOT NULL GROUP BY ALL",
    "calibration": WINDOWS + f", {_PATTERN}, {_CALIBRATION} SELECT win AS \"window\", \"check\", value, CASE WHEN servicing_id IS NULL THEN 'N/A' WHEN COALESCE(ok, FALSE) THEN 'PASS' ELSE 'FAIL' END AS result FROM t",
    "trend_labels": TRENDS + " SELECT 'servicing' AS level, servicing_id AS id, * EXCLUDE (servicing_id) FROM ctrend UNION ALL SELECT 'billing', billing_id, * EXCLUDE (billing_id) FROM otrend",
    "network_links": TRENDS + f" SELECT servicing_id, billing_id, pair_paid, c.trend AS servicing_trend, o.trend AS billing_trend FROM (SELECT servicing_id, billing_id, {_money('paid')} AS pair_paid FROM rn GROUP BY ALL) JOIN ctrend c USING (servicing_id) JOIN otrend o USING (billing_id)",
    "exposure_summary": TRENDS + f" {_by_trend('ctrend', 'servicing_id', 'Servicing')} UNION ALL {_by_trend('otrend', 'billing_id', 'Billing')}",
    "combined_servicing": _wide_servicing(), "combined_billing": _wide_billing(),
    "screen_order": TRENDS + f" SELECT servicing_id, is_reference, match_basis, trend, CASE match_basis WHEN 'Both' THEN 1 WHEN 'Pattern only' THEN 2 ELSE 3 END AS basis_rank, CASE WHEN trend = 'Persistent' THEN 1 WHEN trend IN ('Emerging', 'Active - intermittent') THEN 2 WHEN trend = 'Recently normalized' THEN 3 WHEN trend LIKE 'Historical%' THEN 4 ELSE 5 END AS trend_rank, total_paid, tier1, tier2 FROM ctrend LEFT JOIN {_recovery('servicing_id')} USING (servicing_id)",
    "dup_groups": _dups(_COHORT) + " SELECT * FROM shown",
    "dup_pairs": _dups(_COHORT) + f", o AS (SELECT per.*, same_units FROM per JOIN grp USING (member_id, code, svc_dt)) SELECT a.billing_id AS biller_a, b.billing_id AS biller_b, COUNT(*) AS services, COUNT(*) FILTER (a.same_units) AS services_same_units, COUNT(DISTINCT a.member_id) AS members, {_money('LEAST(a.paid, b.paid)')} AS possible_duplicate_paid, {_money('CAST(a.paid AS DECIMAL(18,2)) + CAST(b.paid AS DECIMAL(18,2))')} AS paid_by_both FROM o a JOIN o b ON a.member_id = b.member_id AND a.code = b.code AND a.svc_dt = b.svc_dt AND a.billing_id < b.billing_id GROUP BY ALL",
    "dup_involvement": _dups(_COHORT) + f", e AS (SELECT UNNEST(LIST_DISTINCT(LIST_CONCAT(billers, servicers))) AS provider, possible_duplicate_paid FROM grp) SELECT provider, COUNT(*) AS services, {_money('possible_duplicate_paid')} AS possible_duplicate_paid FROM e GROUP BY ALL",
    "dup_reference": _dups(_COHORT) + " SELECT shown.* FROM shown JOIN grp USING (member_id, code, svc_dt) WHERE LIST_CONTAINS(grp.billers, 3) AND (LIST_CONTAINS(grp.billers, 7) OR LIST_CONTAINS(grp.servicers, 7))",
    "dup_largest": _dups(_COHORT) + " SELECT * FROM shown ORDER BY possible_duplicate_paid DESC, member_id, code, svc_dt LIMIT 100",
    "target_dups": _dups("billing_id = 3") + " SELECT * FROM shown",
    "self_listed": f"WITH {_claims(True)}, b AS (SELECT * FROM claims WHERE status = 'A'), s AS (SELECT b.* FROM b WHERE billing_id IN (SELECT billing_id FROM b WHERE {_COHORT})), g AS (SELECT billing_id, COUNT(*) AS lines, COUNT(*) FILTER (billing_id = servicing_id) AS self_lines, {_money('paid')} AS paid, COALESCE({_money('CASE WHEN billing_id = servicing_id THEN paid END')}, 0) AS self_paid FROM s GROUP BY ALL) SELECT *, ROUND(CAST(self_lines AS DOUBLE) * 100 / lines, 6) AS pct_self_lines FROM g WHERE self_lines > 0 AND self_lines < lines",
    "window_reports": WINDOWS + _WINDOW_REPORTS,
    "layout_b": """SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE 'S' || l_partkey END AS servicing_id, 'B' || l_suppkey AS billing_id, l_orderkey AS member_id, UPPER(TRIM(p_brand)) AS code, l_quantity AS qty, l_extendedprice AS paid,
  CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_shipdate AS DATE) END AS svc_dt, CASE WHEN l_linenumber = 5 THEN CAST(l_shipdate AS DATE) + 2 END AS svc_end, CAST(NULL AS VARCHAR) AS lob, CASE WHEN l_linenumber = 6 THEN 'HQ' END AS mod1, CAST(NULL AS VARCHAR) AS mod2, CAST(NULL AS VARCHAR) AS mod3, CAST(NULL AS VARCHAR) AS mod4
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "daily_volume": SVC + f", dd AS (SELECT {_DAILY.format('servicing_id')} FROM n GROUP BY ALL) {_VOLUME}",
    "thresholds": SVC + f", dd AS (SELECT {_DAILY.format('servicing_id')} FROM n GROUP BY ALL) SELECT servicing_id, {_shares('pct_days_over')} FROM dd GROUP BY ALL",
    "totals": SVC + " " + _TOTALS.format("billing_id", "servicing_id"),
    "clinician_day_mix": DAYS + f", o AS (SELECT * FROM (SELECT DISTINCT billing_id, servicing_id, svc_dt FROM n) JOIN days USING (servicing_id, svc_dt)) SELECT billing_id, COUNT(*) AS clinician_days, ROUND(AVG(hours), 6) AS avg_hours, {_shares('pct_over')} FROM o GROUP BY ALL",
    "peer_medians": SVC + f", t AS ({_TOTALS.format('servicing_id', 'billing_id')}) SELECT {_PEERS} FROM t WHERE servicing_id <> 7",
    "members_per_day": SVC + f", dd AS (SELECT {_DAILY.format('billing_id')} FROM n GROUP BY ALL) SELECT billing_id, ROUND(AVG(members), 6) AS avg_members, QUANTILE_DISC(members, 0.5) AS med_members, MAX(members) AS max_members FROM dd GROUP BY ALL",
    "counterparty_breakdown": SVC + f" SELECT servicing_id, billing_id, COUNT(*) AS lines, {_money('paid')} AS paid, SUM(qty) AS units, COUNT(DISTINCT member_id) AS members, COUNT(DISTINCT svc_dt) AS days, ROUND(SUM(minutes) / 60, 6) AS hours FROM n GROUP BY ALL",
    "counterparty_daily": SVC + f", dd AS (SELECT {_DAILY.format('servicing_id, billing_id')} FROM n GROUP BY ALL) SELECT servicing_id, billing_id, ROUND(AVG(units), 6) AS avg_units, ROUND(AVG(hours), 6) AS avg_hours, MAX(hours) AS max_hours, ROUND(AVG(members), 6) AS avg_members, COUNT(*) AS days FROM dd GROUP BY ALL",
    "outlier_clinicians": SVC + f", dd AS (SELECT {_DAILY.format('servicing_id')} FROM n GROUP BY ALL), u AS (SELECT servicing_id, AVG(units) AS units_day FROM dd GROUP BY ALL), m AS (SELECT QUANTILE_DISC(units_day, 0.5) AS cohort_median FROM u) SELECT servicing_id, ROUND(units_day, 6) AS units_day, ROUND(cohort_median, 6) AS cohort_median FROM u, m WHERE units_day > 1.2 * cohort_median",
    "percent_ranks": SVC + f", dd AS (SELECT {_DAILY.format('servicing_id')} FROM n GROUP BY ALL), v AS (SELECT servicing_id, AVG(units) AS u, AVG(members) AS m, AVG(hours) AS h FROM dd GROUP BY ALL) SELECT servicing_id, ROUND(PERCENT_RANK() OVER (ORDER BY u NULLS FIRST) * 100, 6) AS rank_avg_units_day, ROUND(PERCENT_RANK() OVER (ORDER BY m NULLS FIRST) * 100, 6) AS rank_avg_members_day, ROUND(PERCENT_RANK() OVER (ORDER BY h NULLS FIRST) * 100, 6) AS rank_avg_hours_day FROM v",
    "code_profile": _CODE.replace("K", "servicing_id") + " SELECT * REPLACE (ROUND(hours, 6) AS hours, ROUND(units_day, 6) AS units_day, ROUND(hours_day, 6) AS hours_day, ROUND(units_member, 6) AS units_member, ROUND(paid_unit, 6) AS paid_unit) FROM profile",
    "code_patterns": SVC + f", {_patterns('b', 'code, billing_id', 'code, billing_id', 'n')} SELECT code, billing_id, ROUND(CAST(dup_days AS DOUBLE) * 100 / days, 6) AS pct_days_dup, ROUND(CAST(COALESCE(repeat_members, 0) AS DOUBLE) * 100 / members, 6) AS pct_members_repeat FROM bcut LEFT JOIN brep USING (code, billing_id)",
    "anomalous_codes": _CODE.replace("K", "servicing_id") + ", peers AS (SELECT code, QUANTILE_DISC(units, 0.5) AS u, QUANTILE_DISC(units_day, 0.5) AS ud, QUANTILE_DISC(units_member, 0.5) AS um, QUANTILE_DISC(paid, 0.5) AS p FROM profile WHERE servicing_id <> 7 GROUP BY code), t AS (SELECT code, servicing_id, units, ROUND(units_day, 6) AS units_day, paid, CASE WHEN u > 0 THEN ROUND(units / u, 1) END AS ratio_units, CASE WHEN ud > 0 THEN ROUND(units_day / ud, 1) END AS ratio_units_day, CASE WHEN um > 0 THEN ROUND(units_member / um, 1) END AS ratio_units_member, CASE WHEN p > 0 THEN ROUND(profile.paid / p, 1) END AS ratio_paid FROM profile LEFT JOIN peers USING (code) WHERE servicing_id = 7) SELECT * FROM t WHERE COALESCE(ratio_units, 0) > 1.2 OR COALESCE(ratio_units_day, 0) > 1.2 OR COALESCE(ratio_paid, 0) > 1.2",
    "code_report": _CODE.replace("K", "billing_id") + f", peers AS (SELECT code, {', '.join(f'QUANTILE_DISC({c}, 0.5) AS peer_{c}' for c in PROFILE)} FROM profile WHERE billing_id <> 3 GROUP BY code), ranks AS (SELECT code, billing_id, PERCENT_RANK() OVER (PARTITION BY code ORDER BY units_day NULLS FIRST) * 100 AS rank_units_day FROM profile), {_patterns('b', 'code, billing_id', 'code, billing_id', 'n')}"
    + f" SELECT profile.* REPLACE ({_UNROUNDED}), {', '.join(f'ROUND(peer_{c}, 6) AS peer_{c}' if c in ('hours', 'units_day', 'hours_day', 'units_member', 'paid_unit') else f'peer_{c}' for c in PROFILE)}, ROUND(rank_units_day, 6) AS rank_units_day, ROUND(CAST(dup_days AS DOUBLE) * 100 / bcut.days, 6) AS pct_days_dup, ROUND(CAST(COALESCE(repeat_members, 0) AS DOUBLE) * 100 / bcut.members, 6) AS pct_members_repeat, "
    + ", ".join(f"CASE WHEN peer_{c} > 0 THEN ROUND(profile.{c} / peer_{c}, 1) END AS ratio_{c}" for c in ("units", "units_day", "units_member", "paid")) + " FROM profile LEFT JOIN peers USING (code) JOIN ranks USING (code, billing_id) LEFT JOIN bcut USING (code, billing_id) LEFT JOIN brep USING (code, billing_id) WHERE billing_id = 3",
    "gate_status": _GATE + " SELECT validation_status AS status, COUNT(*) AS rules FROM accepted GROUP BY ALL UNION ALL SELECT 'rejected', COUNT(*) FROM r1 WHERE rejected", "gate_accepted": _GATE + " SELECT * FROM accepted",
    "code_counterparty": SVC + f" SELECT billing_id, code, servicing_id, SUM(qty) AS units, {_money('paid')} AS paid, COUNT(DISTINCT member_id) AS members, COUNT(DISTINCT svc_dt) AS days, COUNT(*) AS lines, ROUND(SUM(qty) / COUNT(DISTINCT svc_dt), 6) AS units_day FROM n GROUP BY ALL",
    "consolidated": SVC + f", t AS ({_TOTALS.format('servicing_id', 'billing_id')}), m AS (SELECT {_PEERS} FROM t WHERE servicing_id <> 7), a AS (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in ('units', 'paid', 'members', 'counterparties', 'codes', 'lines'))} FROM m) ON COLUMNS(*) INTO NAME metric VALUE peer_median), b AS (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in ('units', 'paid', 'members', 'counterparties', 'codes', 'lines'))} FROM t WHERE servicing_id = 7) ON COLUMNS(*) INTO NAME metric VALUE target) SELECT metric, target, peer_median, CASE WHEN peer_median > 0 THEN ROUND(target / peer_median, 1) END AS ratio FROM a LEFT JOIN b USING (metric)",
    "target_self_listing": SVC + f' SELECT own AS lists_itself, COUNT(*) AS lines, COUNT(DISTINCT member_id) AS members, SUM(qty) AS units, {_money("paid")} AS paid, MIN(svc_dt) AS "first", MAX(svc_dt) AS "last" FROM n WHERE billing_id = 3 GROUP BY ALL',
    "cohort_overview": SVC + ' SELECT COUNT(DISTINCT servicing_id) AS entities, COUNT(*) AS lines, COUNT(*) FILTER (servicing_id = 7) AS target_lines, MIN(svc_dt) AS "first", MAX(svc_dt) AS "last" FROM n',
    "file_classes": _FILES + " SELECT * FROM c",
    "duplicate_files": _FILES + " SELECT c.* FROM c JOIN (SELECT quarter, edit, service, revision FROM c WHERE kind = 'edit' GROUP BY ALL HAVING COUNT(*) > 1) USING (quarter, edit, service, revision)",
    "quarter_completeness": _FILES.replace("FROM f)", "FROM f WHERE NOT (kind = 'edit' AND kd = 'mue' AND sv = 'dme' AND qr LIKE '%Q4'))") + " SELECT q.quarter, e.edit, s.service FROM (SELECT DISTINCT quarter FROM c WHERE kind = 'edit') q, (VALUES ('ptp'), ('mue')) e(edit), (VALUES ('practitioner'), ('outpatient'), ('dme')) s(service) WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.kind = 'edit' AND c.quarter = q.quarter AND c.edit = e.edit AND c.service = s.service)",
    "revision_plan": _FILES + ", h AS (SELECT quarter, edit, service, MAX(revision) AS have FROM c WHERE kind = 'edit' AND quarter < '1998Q1' AND revision < 2 GROUP BY ALL), p AS (SELECT c.*, have, ROW_NUMBER() OVER (PARTITION BY quarter, edit, service ORDER BY revision DESC, path) AS rk FROM c LEFT JOIN h USING (quarter, edit, service) WHERE kind = 'edit') SELECT path, edit, service, quarter, revision, kind, CASE WHEN rk > 1 THEN 'superseded' WHEN have IS NULL THEN 'load' WHEN revision > have THEN 'replace' ELSE 'skipped_exists' END AS status FROM p",
    "missing_quarters": _FILES + ", l AS (SELECT DISTINCT quarter FROM c WHERE kind = 'edit' AND edit = 'ptp' AND service = 'dme' AND revision = 2), r AS (SELECT UNNEST(RANGE((SELECT MIN(CAST(quarter[1:4] AS INTEGER) * 4 + CAST(quarter[6:6] AS INTEGER) - 1) FROM l), 2001 * 4 + 4)) AS i) SELECT (i // 4) || 'Q' || (i % 4 + 1) AS quarter FROM r WHERE (i // 4) || 'Q' || (i % 4 + 1) NOT IN (SELECT quarter FROM l)",
    "edit_load": _FILES + _EDIT_LOAD,
    "load_baseline": _FILES + ", g AS (SELECT edit, service, quarter, COUNT(*) AS rows FROM c WHERE kind = 'edit' GROUP BY ALL), k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY edit, service ORDER BY quarter DESC) AS rk FROM g) SELECT edit, service, quarter, rows FROM k WHERE rk = 1",
}
