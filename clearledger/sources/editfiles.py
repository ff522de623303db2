"""Quarterly edit files: classify by name, plan revisions, parse, load idempotently, and report.

Our text layout (the original parser is not public): a header line naming the columns, tab-separated rows, and recognised footer
lines. Pair edits: column_one, column_two, effective_date, deletion_date, modifier_indicator. Unit edits: code, unit_limit.
File names carry quarter, edit, service and revision, as in `ptp_practitioner_2024q1_r1.txt`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.scratch import materialise

EDITS, SERVICES = ("ptp", "mue"), ("practitioner", "outpatient", "dme")
NAME = r"(?i)(ptp|mue)_(practitioner|outpatient|dme)_(\d{4})q([1-4])(?:_r(\d+))?\.txt$"
COLUMNS = {"ptp": ["column_one", "column_two", "effective_date", "deletion_date", "modifier_indicator"], "mue": ["code", "unit_limit"]}
FOOTER = r"(?i)^(source:|copyright|\*|end of file)"
FILE = ["quarter", "edit", "service", "revision"]


def classify(files: DataFrame, path: str = "path") -> DataFrame:
    """files with edit, service, quarter (as 2024Q1), revision and kind: edit, other, or error for names that look like edits but don't parse."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    got = lambda i: F.nullif(F.regexp_extract(name, NAME, i), F.lit(""))
    looks = F.lower(name).rlike("ptp|mue|edit")
    return files.select(
        "*", F.lower(got(1)).alias("edit"), F.lower(got(2)).alias("service"), F.concat(got(3), F.lit("Q"), got(4)).alias("quarter"), F.when(got(1).isNotNull(), F.coalesce(got(5).cast("int"), F.lit(0))).alias("revision"),
        F.when(got(1).isNotNull(), "edit").when(looks, "error").otherwise("other").alias("kind"),
    )


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, sha256) of every file of a folder, classified."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length", F.sha2("content", 256).alias("sha256"))
    return classify(files)


def duplicate_files(files: DataFrame) -> DataFrame:
    """Edit files of which there is another with the same key: all of them fail."""
    many = files.where("kind = 'edit'").groupBy(*FILE).agg(F.count("*").alias("n")).where("n > 1")
    return files.join(many.drop("n"), FILE, "left_semi")


def quarter_completeness(files: DataFrame) -> DataFrame:
    """(quarter, edit, service) that a quarter with any file still lacks."""
    q = files.where("kind = 'edit'").select("quarter").distinct()
    pairs = F.explode(F.array(*[F.struct(F.lit(e).alias("edit"), F.lit(s).alias("service")) for e in EDITS for s in SERVICES]))
    wanted = q.select("quarter", pairs.alias("x")).select("quarter", "x.*")
    return wanted.join(files.where("kind = 'edit'"), ["quarter", "edit", "service"], "left_anti")


def revision_plan(files: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """files with status: load for the highest revision, superseded for others; against loaded (quarter, edit, service, revision): replace or skipped_exists."""
    key = ["quarter", "edit", "service"]
    rk = F.row_number().over(W.partitionBy(*key).orderBy(F.desc("revision"), "path"))
    p = files.where("kind = 'edit'").withColumn("_rk", rk)
    status = F.when(F.col("_rk") > 1, "superseded")
    if loaded is None:
        return p.withColumn("status", status.otherwise("load")).drop("_rk")
    have = loaded.groupBy(*key).agg(F.max("revision").alias("_have"))
    p = p.join(have, key, "left")
    return p.withColumn("status", status.when(F.col("_have").isNull(), "load").when(F.col("revision") > F.col("_have"), "replace").otherwise("skipped_exists")).drop("_rk", "_have")


def _date_ok(c: Column) -> Column:
    return F.try_to_date(c, "yyyyMMdd").isNotNull()


def read_lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, place, value): the lines of files, read as text by Spark. A line's place is its block in the file and its place in the block."""
    paths = [r.path for r in files.select("path").distinct().collect()]  # one row a file: six a quarter
    if not paths:
        return spark.createDataFrame([], "path string, place struct<block:long,line:long>, value string")
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), place.alias("place"), "value")


def parse(lines: DataFrame, files: DataFrame, edit: str) -> tuple[DataFrame, DataFrame]:
    """(rows, status) of planned files (status load or replace) of one kind of edit, from their lines (path, place, value).

    Lines before the header are tolerated and never loaded, whatever they look like; a footer is recognised; any other row that does not parse fails its
    whole file. The lines are classified once and written. Planned files are one for each quarter, edit and service at most, so they and what is counted
    by file are broadcast: no line is shuffled.
    """
    cols = COLUMNS[edit]
    todo = files.where((F.col("edit") == edit) & F.col("status").isin("load", "replace"))
    text = lines.join(F.broadcast(todo.select("path")), "path", "left_semi")
    cells = F.split("value", "\t")
    header = F.lower("value") == "\t".join(cols)
    kind = F.when(header, "header").when(F.trim("value") == "", "blank").when(F.col("value").rlike(FOOTER), "footer").when(F.size(cells) == len(cols), "row").otherwise("other")
    t = materialise(text.select("path", "place", kind.alias("kind"), cells.alias("cells")), "parsed")
    heads = t.where("kind = 'header'").groupBy("path").agg(F.min("place").alias("head"))  # a row for each file
    t = t.join(F.broadcast(heads), "path", "left").withColumn("kind", F.when(F.col("place") < F.col("head"), "preamble").otherwise(F.col("kind")))
    r = t.where("kind = 'row'").select("path", *[F.trim(F.col("cells")[i]).alias(c) for i, c in enumerate(cols)])
    if edit == "ptp":
        bad = F.when((F.col("column_one") == "") | (F.col("column_two") == ""), "missing code").when(~_date_ok(F.col("effective_date")), "bad date").when((F.col("deletion_date") != "*") & (F.col("deletion_date") != "") & ~_date_ok(F.col("deletion_date")), "bad date").when(~F.col("modifier_indicator").isin("0", "1", "9"), "bad indicator")
    else:
        bad = F.when(F.col("code") == "", "missing code").when(F.expr("try_cast(unit_limit as int)").isNull(), "limit is no number")
    r = r.withColumn("bad", bad)
    per = t.groupBy("path").agg(F.sum((F.col("kind") == "header").cast("long")).alias("headers"), F.sum((F.col("kind") == "other").cast("long")).alias("others"), F.sum(F.col("kind").isin("preamble", "footer", "blank").cast("long")).alias("tolerated_rows"))
    rows = r.groupBy("path").agg(F.count("*").alias("rows"), F.min("bad").alias("bad"))
    status = per.join(rows, "path", "left").select("path", F.coalesce("rows", F.lit(0)).alias("rows"), "tolerated_rows", F.when(F.col("headers") != 1, "no header or several").when(F.col("others") > 0, "unknown lines").when(F.coalesce("rows", F.lit(0)) == 0, "no rows").otherwise(F.col("bad")).alias("error"))
    good = r.join(F.broadcast(status.where("error is null").select("path")), "path", "left_semi").join(F.broadcast(todo.select("path", "quarter", "service", "revision")), "path")
    return good.drop("bad"), status


def status_report(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count("*").alias("files"))


def go(log: DataFrame) -> None:
    """Raise if a file failed."""
    if failed := log.where("status = 'failed'").select("path", "error").limit(20).collect():
        raise RuntimeError("; ".join(f"{r.path}: {r.error}" for r in failed))


def quarter_index(quarter: Column) -> Column:
    return F.substring(quarter, 1, 4).cast("int") * 4 + F.substring(quarter, 6, 1).cast("int") - 1


def missing_quarters(loaded: DataFrame, until: Column) -> DataFrame:
    """(quarter) between the first loaded one and the quarter of `until` that are absent."""
    span = loaded.agg(F.min(quarter_index(F.col("quarter"))).alias("a"), (F.year(until) * 4 + F.quarter(until) - 1).alias("b"))
    every = span.select(F.explode(F.sequence("a", F.greatest("a", "b"))).alias("i"))
    named = every.select(F.concat(F.floor(F.col("i") / 4).cast("string"), F.lit("Q"), (F.col("i") % 4 + 1).cast("string")).alias("quarter"))
    return named.join(loaded, "quarter", "left_anti")


def baseline(table: DataFrame) -> DataFrame:
    """Row count of the latest quarter of each (edit, service)."""
    c = table.groupBy("edit", "service", "quarter").agg(F.count("*").alias("rows"))
    return c.withColumn("rk", F.row_number().over(W.partitionBy("edit", "service").orderBy(F.desc("quarter")))).where("rk = 1").drop("rk")


def cross_check(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose two copies have different numbers of rows."""
    a, b = first.groupBy(*keys).agg(F.count("*").alias("rows_a")), second.groupBy(*keys).agg(F.count("*").alias("rows_b"))
    return a.join(b, keys, "full_outer").where(~F.col("rows_a").eqNullSafe(F.col("rows_b")))
