"""Mixing sources to target weights by systematic sampling.

Sources, in code-point order with null last, carry repeating weights and share a multiple of all words; a
source's target stops at cap times its size and the excess goes to the others by weight until none is above. Within
a source every document expects target / size copies. Documents stand in order of size and id; their
expected copies are summed up along that order, one random offset a source is added, and a document is
emitted once for each integer boundary that its own stretch crosses. The order by size makes the taken words of a
source differ from its target by about one document.

The running sum is a rank: one range sort over (source, size, id) that is written, counts per written
partition, and an offset for each, so a source that holds most rows is spread over all tasks.

Null texts and texts without a word have size 0 and copies like any other document. A null source is a source of its own. Repeated
rows are separate documents. An empty table gives an empty mix; a source whose size is 0 has target 0 and is not taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialise, words_of

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2


def offset_of(source: Column, seed: str) -> Column:
    """The source's random offset in [0, 1), from a digest of its name."""
    return F.conv(F.substring(F.md5(F.concat(source, F.lit(seed)).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(_source, source_size) of each source -> with target. One row a source, so a single window is small."""
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(W.orderBy(F.col("_source").isNull(), "_source")) - 1, F.lit(len(weights))) + 1).cast("int"))
    ordered = W.orderBy(F.col("_cap") / F.col("_w"), F.col("_source").isNull(), "_source").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(0))
    t = sources.withColumn("_w", w).withColumn("_cap", F.col("source_size") * cap)
    t = t.withColumn("_all", F.sum("source_size").over(whole) * F.lit(float(share))).withColumn("_all_w", F.sum("_w").over(whole))
    t = t.withColumn("_caps", F.coalesce(F.sum("_cap").over(ordered), F.lit(0))).withColumn("_ws", F.coalesce(F.sum("_w").over(ordered), F.lit(0)))
    full = (F.col("_all") - F.col("_caps")) * F.col("_w") > F.col("_cap") * (F.col("_all_w") - F.col("_ws"))
    t = t.withColumn("_full", full)
    level = F.try_divide(
        F.col("_all") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(whole),
        F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(whole),
    )
    return t.withColumn("target", F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(F.coalesce(level * F.col("_w"), F.lit(0.0)))).select("_source", "source_size", "target")


def planned(docs: DataFrame, id_col: str, text: str, source: str, keep: list[str], seed: str = "mix", **how) -> DataFrame:
    """The columns `keep` of docs with _size, source_size, target and _copies for every row."""
    spark = docs.sparkSession
    hashable = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind]
    sized = docs.select(*keep, F.col(source).cast("string").alias("_source"), words_of(F.col(text)).alias("_size"), F.col(id_col).alias("_id"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_text"), F.xxhash64(*hashable).alias("_row"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = [F.col("_source").isNull(), F.col("_source"), F.col("_size"), F.col("_id"), F.col("_text"), F.col("_row")]  # a place of its own for all but equal rows
    placed = materialise(
        sized.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "placed"
    )  # written: both passes below read the same places
    parts = placed.groupBy("_source", F.shiftright("_at", 33).alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"), F.sum("_size").alias("_words"))
    parts = materialise(parts, "parts")  # a row for each source and partition that holds it
    sources = targets(parts.groupBy("_source").agg(F.sum("_words").alias("source_size")), **how)
    before = W.partitionBy("_source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    plan = (
        parts.withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(sources.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")))
        .select(F.col("_source").alias("_s"), F.col("_part").alias("_p"), "_first", "_skip", "source_size", "target")
    )
    plan = materialise(plan, "plan")
    rank = F.col("_at") - F.col("_first") + F.col("_skip") + 1
    each = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    u = offset_of(F.coalesce(F.col("_source"), F.lit("\x00null")), seed)
    copies = (F.floor(each * rank + u) - F.floor(each * (rank - 1) + u)).cast("long")
    joined = placed.join(plan, (F.shiftright("_at", 33) == F.col("_p")) & F.col("_source").eqNullSafe(F.col("_s")))
    return joined.select(*keep, "_size", "source_size", "target", copies.alias("_copies"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """One row per row of docs: id, size, source_size, target, taken (copies times size)."""
    p = planned(docs.select(F.col(id_col), F.col(text), F.col(source)), id_col, text, source, [id_col], **how)
    return p.select(id_col, F.col("_size").alias("size"), "source_size", "target", (F.col("_copies") * F.col("_size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """docs with every row emitted as often as the mix takes it."""
    p = planned(docs, id_col, text, source, docs.columns, **how)
    return p.where("_copies > 0").withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, CAST(COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (ROW_NUMBER() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, source_size * 2 AS cap FROM s),
p AS (SELECT *, CAST(SUM(source_size) OVER () AS BIGINT) * CAST(1.5 AS DOUBLE) AS total, SUM(w) OVER () AS all_w,
  COALESCE(SUM(cap) OVER o, 0) AS caps, COALESCE(SUM(w) OVER o, 0) AS ws
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, (total - caps) * w > cap * (all_w - ws) AS is_full FROM p),
l AS (SELECT (MAX(total) - CAST(COALESCE(SUM(cap) FILTER (is_full), 0) AS BIGINT)) / CAST(SUM(w) FILTER (NOT is_full) AS BIGINT) AS level FROM f),
t AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE COALESCE(level * w, 0) END AS target FROM f, l),
r AS (SELECT doc_id, size, source_size, target, ROW_NUMBER() OVER (PARTITION BY d.source ORDER BY size, doc_id, MD5(COALESCE(text, ''))) AS rank,
  COALESCE(target / NULLIF(source_size, 0), 0) AS each,
  CAST(CAST('0x' || SUBSTR(MD5(COALESCE(d.source, CHR(0) || 'null') || 'mix'), 1, 8) AS BIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE) AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST((FLOOR(each * rank + u) - FLOOR(each * (rank - 1) + u)) * size AS BIGINT) AS taken FROM r
"""
