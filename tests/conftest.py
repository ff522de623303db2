"""A small local session for all tests, and the given tables for SQL comparisons."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SMALL).is_dir():
        pytest.skip(f"no tables in {SMALL}")
    return SMALL


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def as_sql_frame(duck, df):
    """A Spark result by way of Arrow and the SQL engine, so that both sides have the same pandas types."""
    return duck.from_arrow(df.toArrow()).df()


def same_rows(got, want) -> None:
    """Both frames have the same columns and the same rows in any order."""
    assert sorted(got.columns) == sorted(want.columns)
    names = sorted(got.columns)
    rows = lambda f: sorted(map(str, f[names].astype(object).where(f[names].notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
