"""Claim tables: readers, normalisation of both layouts to one schema, and views of the test tables in that shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import CLAIMS


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CLAIMS) -> DataFrame:
    """Headed CSV with a given schema; the types are never guessed."""
    return spark.read.schema(schema).csv(path, header=True)


def read_reference(spark: SparkSession, name: str) -> DataFrame:
    """A Parquet path if it ends so, else a table."""
    return spark.read.parquet(name) if name.endswith(".parquet") else spark.table(name)


def cohort(members: DataFrame, category: str, id_col: str = "servicing_id", category_col: str = "category") -> DataFrame:
    """The distinct ids of a category."""
    return members.where(F.col(category_col) == category).select(id_col).distinct()


def in_cohort(claims: DataFrame, ids: DataFrame, id_col: str = "servicing_id") -> DataFrame:
    return claims.join(ids.select(id_col).distinct(), id_col, "left_semi")


def _or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def from_triage(df: DataFrame) -> DataFrame:
    """Layout A (one row per paid line, long keys, dates or time stamps) in canonical columns."""
    one = lambda name, kind: _or_null(df, name, kind)
    return df.select(
        one("UNIQUE_KEY", "string").alias("line_id"), one("Claim_Hdr_ID", "long").alias("claim_id"), one("MEMBER_KEY", "long").alias("member_id"),
        one("BILLING_PROVIDER_KEY", "long").alias("billing_id"), one("SERVICING_PROVIDER_KEY", "long").alias("servicing_id"), one("PROC_CD", "string").alias("code"),
        one("PROC_CD_DESC", "string").alias("code_desc"), one("COS_DESC", "string").alias("cos"), one("QUANTITY_PAID", "double").alias("qty"), one("PMT_AMT", "double").alias("paid"),
        F.to_date("Svc_Begin_Dt").alias("svc_dt"), (F.to_date("Svc_End_Dt") if "Svc_End_Dt" in df.columns else F.lit(None).cast("date")).alias("svc_end"),
        one("line_of_business", "string").alias("lob"), one("PAY_TO_TAX_ID", "long").alias("tax_id"), *[one(f"MODIFIER_{i}", "string").alias(f"mod{i}") for i in range(1, 5)],
        one("ADJU_STA", "string").alias("status"),
    )


def from_screen(df: DataFrame) -> DataFrame:
    """Layout B (string ids, yyyyMMdd dates) in canonical columns; ids stay strings. Dates that are none become null."""
    one = lambda name, kind: _or_null(df, name, kind)
    day = lambda name: F.try_to_date(F.col(name).cast("string"), "yyyyMMdd") if name in df.columns else F.lit(None).cast("date")
    return df.select(
        F.col("Servicing_Provider_ID").alias("servicing_id"), F.col("Billing_Provider_ID").alias("billing_id"), one("MEMBER_KEY", "long").alias("member_id"),
        F.upper(F.trim("PROC_CD")).alias("code"), one("QUANTITY_PAID", "double").alias("qty"), one("PMT_AMT", "double").alias("paid"),
        day("SRV_BEG_CALENDAR_KEY").alias("svc_dt"), day("SRV_END_CALENDAR_KEY").alias("svc_end"), one("line_of_business", "string").alias("lob"),
        *[one(f"MODIFIER_{i}", "string").alias(f"mod{i}") for i in range(1, 5)],
    )


#: What the view describes procedures as: timed, bounded and untimed texts.
DESCRIPTIONS = (
    "CARE, PER 15 MINUTES", "Care, each 15 minutes", "AIDE, UP TO 15 MINUTES", "HABILITATION, PER HOUR", "VISIT", "OBSERVATION 24 HOUR STAY", "NURSING, EACH 2 HOURS", "MINI-BUS TRIP, PER 15 MIN", "THERAPY, UP TO 1 HOUR", "SESSION, EACH HOUR",
)


def claims_view(spark: SparkSession, sf_dir: str, dense: bool = True) -> DataFrame:
    """The test tables as claims. dense: 60 members, 25 billers, monthly dates; else real ids and weekly dates."""
    line, order, part, supp = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "part", "supplier"))
    biller = F.col("l_suppkey") % 25
    # part and supplier are dimension tables; Spark broadcasts them if their size allows
    j = line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey")).join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
    servicing = (
        F.when(F.col("l_linenumber") == 7, F.lit(-1))
        .when(F.col("l_partkey") % 4 == 0, biller)
        .when(F.col("l_partkey") % 4 == 1, (F.col("l_suppkey") * F.col("l_suppkey")) % 25)
        .otherwise(biller + 25 * (1 + F.col("l_partkey") % (1 + F.col("l_suppkey") % 9)))
    )
    day = F.to_date(F.date_trunc("month" if dense else "week", "l_shipdate"))
    ends = F.when(F.col("l_linenumber") == 5, F.date_add(day, (1 + 2 * (F.col("l_partkey") % 2)).cast("int")))
    texts = F.array(*[F.lit(t) for t in DESCRIPTIONS])
    described = F.when(F.col("p_partkey") % 500 == 7, "SUPPLY, PER 99999999999 MINUTES").otherwise(F.element_at(texts, (F.col("p_partkey") % len(DESCRIPTIONS) + 1).cast("int")))
    payer = F.when(F.col("o_orderpriority") == "5-LOW", "MSP").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None)).otherwise(F.col("o_orderpriority"))
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.col("l_shipdate").cast("date")).alias("line_id"), F.col("l_orderkey").alias("claim_id"),
        (F.col("o_custkey") % 60 if dense else F.col("o_custkey")).alias("member_id"), (biller if dense else F.col("l_suppkey")).alias("billing_id"), servicing.cast("long").alias("servicing_id"),
        F.col("p_brand").alias("code"), described.alias("code_desc"), F.col("p_type").alias("cos"), F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("paid"),
        day.alias("svc_dt"), ends.alias("svc_end"), payer.alias("lob"), F.col("s_nationkey").cast("long").alias("tax_id"),
        F.when(F.col("l_linenumber") == 6, "HQ").alias("mod1"), *[F.lit(None).cast("string").alias(f"mod{i}") for i in (2, 3, 4)],
        F.when(F.col("l_returnflag") == "R", "V").otherwise("A").alias("status"),
    )
