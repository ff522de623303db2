"""Tables that cut a long plan, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir; where that is unset, a local one, once per session, on a local master alone."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("clearledger.local.scratch", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("clearledger.local.scratch", root)
    return f"{root.rstrip('/')}/clearledger/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's address in this application's folder."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete all intermediate tables that this application wrote; whether there were any. Other applications' tables stay.

    Results are lazy and read these tables, so call it once the results are written; DataFrames made before fail afterwards.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df once and go on from the written table."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every id in edges (a, b); component is the smallest id reachable. Ids must not be null.

    Alternates the large-star and small-star steps: each is one grouped minimum, combined before the shuffle, and one join
    back, so a hub's links are never gathered in one place. Rounds are written and end when one changes nothing.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialise(moved.unionByName(down.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "star")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())
