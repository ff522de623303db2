"""Loads of edit files as transactions: rows first, then one small manifest that makes them count.

A batch writes its rows to target/<edit>/batch=<batch> and then its log, a row for each file, to target/_log/batch=<batch>, as one file. Only rows of
files that the log calls loaded or replaced are in the table, and of each (quarter, edit, service) those of the latest such file. So rows
without a log don't exist: a load that dies between the two is repeated as if it had never begun, and overwrites what it left. A batch that has
its log is done; loading it again changes nothing and returns that log. Loads of one target run one after the other.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..contracts import LOAD_LOG
from ..functions.scratch import materialise
from .editfiles import COLUMNS, EDITS, FILE, duplicate_files, listing, parse, read_lines

KEY = ["quarter", "edit", "service"]
LIVE = ("loaded", "replaced")


def _there(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def log(spark: SparkSession, target: str) -> DataFrame:
    """The log of all finished batches."""
    return spark.read.schema(LOAD_LOG).parquet(f"{target}/_log") if _there(spark, f"{target}/_log") else spark.createDataFrame([], LOAD_LOG)


def current(done: DataFrame) -> DataFrame:
    """Of a log, the file that each (quarter, edit, service) is loaded from."""
    latest = F.row_number().over(W.partitionBy(*KEY).orderBy(F.desc("version")))
    return done.where(F.col("status").isin(*LIVE)).withColumn("_rk", latest).where("_rk = 1").drop("_rk")


def table(spark: SparkSession, target: str, edit: str) -> DataFrame:
    """The loaded rows of one kind of edit."""
    live = current(log(spark, target)).where(F.col("edit") == edit).select("batch", "quarter", "service")
    if live.isEmpty():
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in (*COLUMNS[edit], "path", "revision", "quarter", "service")).replace("revision string", "revision int"))
    rows = spark.read.option("basePath", f"{target}/{edit}").schema(", ".join(f"{c} string" for c in COLUMNS[edit]) + ", path string, revision int, batch string, quarter string, service string").parquet(f"{target}/{edit}")
    return rows.join(live, ["batch", "quarter", "service"], "left_semi").drop("batch")


def plan(files: DataFrame, done: DataFrame, overwrite: bool = False, quarters: Collection[str] | None = None) -> DataFrame:
    """Classified files with status, error, note and replaced_path, from what a log says is loaded.

    failed: a name that is not understood, or two files of one key; archived_only: a quarter that is not wanted; superseded: there is a higher
    revision among the files; load: nothing is loaded; replace: a higher revision than the loaded one, or any other content with overwrite;
    skipped_exists: the rest, with a note where the content is another than the loaded one's. Files that are no edits are left out.
    """
    none = F.lit(None).cast("string")
    edits = files.where("kind = 'edit'")
    twice = duplicate_files(files).select("path")
    wanted = F.lit(True) if quarters is None else F.col("quarter").isin(*quarters)
    bad = edits.join(twice, "path", "left_semi").withColumn("error", F.lit("two files for one key")).unionByName(files.where("kind = 'error'").withColumn("error", F.lit("name not understood")))
    good = edits.join(twice, "path", "left_anti")
    rank = F.row_number().over(W.partitionBy(*KEY).orderBy(F.desc("revision"), "path"))
    have = current(done).select(*KEY, F.col("revision").alias("_revision"), F.col("sha256").alias("_sha256"), F.col("path").alias("_path"))
    j = good.where(wanted).withColumn("_rk", rank).join(have, KEY, "left")
    newer, other = F.col("revision") > F.col("_revision"), ~F.col("sha256").eqNullSafe(F.col("_sha256"))
    status = F.when(F.col("_rk") > 1, "superseded").when(F.col("_revision").isNull(), "load").when(newer | (other & F.lit(overwrite)), "replace").otherwise("skipped_exists")
    told = j.withColumn("status", status).withColumn("note", F.when((F.col("status") == "skipped_exists") & other, F.concat(F.lit("content differs from "), "_path"))).withColumn("replaced_path", F.when(F.col("status") == "replace", F.col("_path")))
    cols = [*FILE, "path", "sha256", "status", "error", "note", "replaced_path"]
    kept = told.withColumn("error", none).select(*cols)
    aside = good.where(~wanted).withColumn("status", F.lit("archived_only")).withColumn("error", none)
    return kept.unionByName(aside.unionByName(bad.withColumn("status", F.lit("failed"))).withColumn("note", none).withColumn("replaced_path", none).select(*cols))


def load_lines(files: DataFrame, lines: DataFrame, target: str, batch: str, overwrite: bool = False, quarters: Collection[str] | None = None) -> DataFrame:
    """Load files (classified, with path and sha256) whose lines are (path, place, value), and return the batch's log."""
    spark = files.sparkSession
    own = f"{target}/_log/batch={batch}"
    if not _there(spark, own):
        done = log(spark, target)
        version = (done.agg(F.max("version")).first()[0] or 0) + 1
        planned = materialise(plan(files, done, overwrite, quarters), "plan")
        statuses = []
        for edit in EDITS:
            rows, status = parse(lines, planned, edit)
            rows.write.mode("overwrite").partitionBy("quarter", "service").parquet(f"{target}/{edit}/batch={batch}")
            statuses.append(status)
        parsed = reduce(DataFrame.unionByName, statuses).withColumnRenamed("error", "_error")  # six rows a quarter at most
        found = planned.join(F.broadcast(parsed), "path", "left")
        error = F.coalesce("error", "_error")
        status = F.when(error.isNotNull(), "failed").when(F.col("status") == "load", "loaded").when(F.col("status") == "replace", "replaced").otherwise(F.col("status"))
        told = found.withColumns({"status": status, "error": error, "version": F.lit(version), "batch": F.lit(batch), "replaced_path": F.when(error.isNull(), F.col("replaced_path"))})
        told = materialise(told.select(*[F.col(f.name).cast(f.dataType) for f in LOAD_LOG if f.name != "batch"]), "told")
        told.coalesce(1).write.parquet(own)  # a row for each file; the batch counts from here on
    return log(spark, target).where(F.col("batch") == batch)


def load(spark: SparkSession, folder: str, target: str, batch: str, overwrite: bool = False, quarters: Collection[str] | None = None) -> DataFrame:
    """Load the edit files of a folder as one batch, and return its log, a row for each file."""
    files = materialise(listing(spark, folder), "files")
    return load_lines(files, read_lines(spark, files.where("kind = 'edit'")), target, batch, overwrite, quarters)
