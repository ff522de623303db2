"""Schemas of the tables that jobs read and write, and their check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    kinds = {"long": T.LongType(), "string": T.StringType(), "double": T.DoubleType(), "date": T.DateType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "strings": T.ArrayType(T.StringType())}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in text.split())])


#: One row per claim line.
CLAIMS = _schema(
    "line_id:string claim_id:long member_id:long billing_id:long servicing_id:long code:string code_desc:string cos:string qty:double paid:double "
    "svc_dt:date svc_end:date lob:string tax_id:long mod1:string mod2:string mod3:string mod4:string status:string"
)
#: One row per entity, rule and grain.
HITS = _schema(
    "entity_id:long entity_type:string rule_id:string family:string tier:int title:string severity:double metric:double detail:string "
    "hit_dollars:double member_id:long cos:string hit_id:string n_lines:long first_keys:strings evidence_keys:string"
)
#: One row per hit and claim line.
HIT_LINES = _schema("hit_id:string line_id:string")
QUEUE = _schema(
    "entity_id:long entity_type:string n_hits:long distinct_rules:long rules:string risk_score:double dollars_at_risk:double lines_flagged:long members_flagged:long "
    "member_days_flagged:long dollars_incl_untrusted:double independent_families:int families:string has_tier1_family:boolean total_paid:double n_claims:long n_members:long "
    "last_svc_dt:date pct_dollars_at_risk:double data_end_date:date days_before_data_end:int corroborated:boolean tier_label:string untrusted_only:boolean"
)
#: One row per file and batch; the batches' rows together are the load log, and decide what is loaded.
LOAD_LOG = _schema("version:long batch:string quarter:string edit:string service:string revision:int status:string rows:long tolerated_rows:long error:string note:string sha256:string path:string replaced_path:string")


@dataclass(frozen=True)
class Finding:
    """What a schema check found about one column."""

    column: str
    problem: str
    required: bool
    effect: str = ""


#: What a missing optional column switches off.
OPTIONAL = {
    "code_desc": "R1 is skipped",
    "svc_end": "R1 counts every line on its first day",
    "lob": "no payer is excluded in R9 and the duplicate checks",
    "mod1": "no group sessions are recognised",
    "mod2": "no group sessions are recognised",
    "mod3": "no group sessions are recognised",
    "mod4": "no group sessions are recognised",
}


def check_schema(df: DataFrame, contract: T.StructType = CLAIMS, optional: dict[str, str] | None = None, strict: bool = True) -> list[Finding]:
    """Compare df with a contract. Missing required columns or wrong types raise if strict; missing optional ones are reported."""
    optional = OPTIONAL if optional is None else optional
    have = {f.name: f.dataType for f in df.schema}
    found = []
    for f in contract:
        if f.name not in have:
            found.append(Finding(f.name, "missing", f.name not in optional, optional.get(f.name, "")))
        elif have[f.name] != f.dataType:
            found.append(Finding(f.name, f"is {have[f.name].simpleString()}, not {f.dataType.simpleString()}", True))
    if strict and (bad := [x for x in found if x.required]):
        raise ValueError("; ".join(f"{x.column} {x.problem}" for x in bad))
    return found
