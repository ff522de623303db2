"""Helpers that the operators share: bounded samples, folds, running sums; scratch tables and components are the library's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.scratch import connected_components, materialise, scratch

__all__ = ["WORD", "connected_components", "fold", "labelled_sample", "materialise", "running_sum", "scratch", "small_batches", "words_of"]
#: Words are runs of anything but the six ASCII white-space characters; bytes.split() cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows per Arrow batch: texts are long, and a Python worker holds a batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts."""
    return F.crc32(id_column.cast("string").cast("binary")) % parts


def words_of(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, keep: Column, per_class: int
) -> DataFrame:
    """(_id, _label, columns of docs) of at most per_class labelled rows of each class.

    The rows taken are those with the smallest hash of the id, so reruns agree. An id with several
    labels counts as the largest one; null ids and labels are left out. Of rows that share an id the one with the
    smallest hash counts, so there is a row for each sampled label at most: 2 * per_class narrow rows, which is also the size that is broadcast.
    """
    one = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & keep)
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label_col)).cast("int").alias("_label"))
    )
    order = (F.xxhash64("_id"), F.col("_id"))
    taken = [one.where(F.col("_label") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    found = docs.select(F.col(id_col).alias("_id"), F.struct(*docs.columns).alias("_row")).join(F.broadcast(taken[0].unionByName(taken[1])), "_id")
    return found.groupBy("_id", "_label").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_id", "_label", "_row.*")


def running_sum(df: DataFrame, order: list[str], value: str, into: str) -> DataFrame:
    """df with `into`: the sum of `value` over all rows before, in the given total order.

    One range sort that is written, a sum for each written partition, and an offset for each; only the
    table of partitions is summed in one place.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    sorted_ = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(sorted_, "running").withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    skip = parts.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_skip"))  # a row a partition
    inside = F.sum(value).over(W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1))
    joined = placed.join(F.broadcast(skip), "_part").withColumn(into, F.coalesce(inside, F.lit(0)) + F.col("_skip"))
    return joined.select(*df.columns, into)
