"""Where results go: tables, CSV, text, and reports of several sheets."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def to_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)


def to_csv(df: DataFrame, path: str) -> None:
    """Headed CSV; arrays become joined text, since CSV has none."""
    flat = [F.array_join(c, ", ").alias(c) if t.startswith("array<string") else F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").csv(path, header=True)


def to_text(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.mode("overwrite").text(path)


def sheet_name(name: str) -> str:
    """A name of letters, digits and _ with 31 characters at most."""
    return re.sub(r"\W", "_", name)[:31]


def to_report(spark: SparkSession, sheets: dict[str, DataFrame], folder: str, note_for_empty: str = "none found", skip_empty: bool = False) -> DataFrame:
    """One Parquet folder a sheet, in the given order, and a manifest (place, sheet, rows, note)."""
    rows = []
    for place, (name, df) in enumerate(sheets.items()):
        path = f"{folder}/{sheet_name(name)}"
        df.write.mode("overwrite").parquet(path)
        n = spark.read.schema(df.schema).parquet(path).count()
        if n or not skip_empty:
            rows.append((place, sheet_name(name), n, "" if n else note_for_empty))
    manifest = spark.createDataFrame(rows, "place int, sheet string, rows long, note string")  # a row a sheet
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return manifest
