"""Transactional loads of edit files, in batches and as a stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clearledger.plans import queries
from clearledger.sources import editfiles, loads
from clearledger.streaming.dropzone import load_new_files

PTP = "column_one\tcolumn_two\teffective_date\tdeletion_date\tmodifier_indicator"


def put(drop, name, *rows, head=PTP):
    (drop / name).write_text("\n".join([head, *rows]) + "\n")


def shown(df):
    return {r.path.split("/")[-1]: r.status for r in df.collect()}


def codes(spark, target):
    return sorted(r.column_two for r in loads.table(spark, target, "ptp").collect())


@pytest.fixture
def places(tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    return drop, str(tmp_path / "target")


def test_batches_and_revisions(spark, places):
    drop, target = places
    put(drop, "ptp_dme_2024q1.txt", "A\tB\t20240101\t*\t1")
    put(drop, "ptp_dme_2023q4.txt", "A\tOLD\t20240101\t*\t1")
    put(drop, "mue_dme_2024q1.txt", "A\tmany", head="code\tunit_limit")
    (drop / "my_edit_list.txt").write_text("x")
    assert shown(loads.load(spark, str(drop), target, "one", quarters=["2024Q1"])) == {"ptp_dme_2024q1.txt": "loaded", "ptp_dme_2023q4.txt": "archived_only", "mue_dme_2024q1.txt": "failed", "my_edit_list.txt": "failed"}
    assert codes(spark, target) == ["B"] and loads.log(spark, target).count() == 4
    put(drop, "ptp_dme_2024q1_r1.txt", "A\tC\t20240101\t*\t1", "A\tD\t20240101\t*\t0")
    assert shown(loads.load(spark, str(drop), target, "one")) == shown(loads.log(spark, target)) and codes(spark, target) == ["B"]  # the batch is done
    two = loads.load(spark, str(drop), target, "two")
    assert shown(two) == {"ptp_dme_2024q1.txt": "superseded", "ptp_dme_2024q1_r1.txt": "replaced", "ptp_dme_2023q4.txt": "loaded", "mue_dme_2024q1.txt": "failed", "my_edit_list.txt": "failed"}
    assert codes(spark, target) == ["C", "D", "OLD"] and two.where("status = 'replaced'").first().replaced_path.endswith("ptp_dme_2024q1.txt")
    put(drop, "ptp_dme_2024q1_r1.txt", "A\tE\t20240101\t*\t1")
    three = loads.load(spark, str(drop), target, "three").where("path like '%r1.txt'").first()
    assert three.status == "skipped_exists" and three.note.startswith("content differs") and codes(spark, target) == ["C", "D", "OLD"]
    assert loads.load(spark, str(drop), target, "four", overwrite=True).where("path like '%r1.txt'").first().status == "replaced" and codes(spark, target) == ["E", "OLD"]
    assert loads.log(spark, target).select("version").distinct().count() == 4
    with pytest.raises(RuntimeError, match="limit is no number"):
        editfiles.go(loads.log(spark, target))


def test_a_load_that_dies_before_its_log_is_repeated(spark, places, monkeypatch):
    drop, target = places
    put(drop, "ptp_dme_2024q1.txt", "A\tB\t20240101\t*\t1")
    loads.load(spark, str(drop), target, "one")
    put(drop, "ptp_dme_2024q1_r1.txt", "A\tC\t20240101\t*\t1")
    put(drop, "mue_dme_2024q1.txt", "A\t3", head="code\tunit_limit")
    real, calls = loads.parse, []

    def dies(lines, files, edit):  # after the first edit's rows are written
        calls.append(edit)
        if len(calls) == 2:
            raise OSError("executor and driver are gone")
        return real(lines, files, edit)

    monkeypatch.setattr(loads, "parse", dies)
    with pytest.raises(OSError):
        loads.load(spark, str(drop), target, "two")
    assert codes(spark, target) == ["B"] and loads.table(spark, target, "mue").count() == 0 and loads.log(spark, target).count() == 1
    monkeypatch.setattr(loads, "parse", real)
    assert set(shown(loads.load(spark, str(drop), target, "two")).values()) == {"superseded", "replaced", "loaded"}
    assert codes(spark, target) == ["C"] and loads.table(spark, target, "mue").count() == 1 and loads.log(spark, target).count() == 4


def test_the_stream_loads_what_a_batch_loads(spark, places, tmp_path):
    drop, target = places
    put(drop, "ptp_dme_2024q1.txt", "A\tB\t20240101\t*\t1")
    put(drop, "mue_dme_2024q1.txt", "A\t3", head="code\tunit_limit")
    stream, check = str(tmp_path / "streamed"), str(tmp_path / "check")
    for _ in range(2):
        load_new_files(spark, str(drop), stream, check)
    assert loads.log(spark, stream).count() == 2
    put(drop, "ptp_dme_2024q1_r1.txt", "A\tC\t20240101\t*\t1", "A\tD\t20240101\t*\t0")
    load_new_files(spark, str(drop), stream, check)
    loads.load(spark, str(drop), target, "all")
    for edit in editfiles.EDITS:
        assert sorted(map(tuple, loads.table(spark, stream, edit).collect())) == sorted(map(tuple, loads.table(spark, target, edit).collect()))
    assert shown(loads.log(spark, stream)) == {"ptp_dme_2024q1.txt": "loaded", "mue_dme_2024q1.txt": "loaded", "ptp_dme_2024q1_r1.txt": "replaced"}


def test_nothing_to_load(spark, places):
    drop, target = places
    (drop / "readme.txt").write_text("x")
    assert loads.load(spark, str(drop), target, "one").collect() == [] and loads.table(spark, target, "ptp").count() == 0


def test_cross_check_of_copies(spark):
    one = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "path string, row int")
    two = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", 1)], "path string, row int")
    assert sorted(tuple(r) for r in editfiles.cross_check(one, two, ["path"]).collect()) == [("a", 2, 1), ("b", 1, 2), ("c", None, 1)]
    assert editfiles.cross_check(one, one, ["path"]).collect() == []


def test_the_query_classifies_files_once(spark, sf_dir):
    for written in queries._edit_text(spark, sf_dir):
        assert "orders.parquet" not in "".join(written.inputFiles())  # loads pass over files and lines many times


def test_lines_are_not_shuffled(spark):
    """With planned files that Spark takes for large: their tables hold other files as well."""
    files = editfiles.classify(spark.createDataFrame([("/d/ptp_dme_2024q1.txt",), ("/d/mue_dme_2024q1.txt",)], "path string")).withColumn("status", F.lit("load"))
    texts = [("/d/ptp_dme_2024q1.txt", PTP), ("/d/ptp_dme_2024q1.txt", "A\tB\t20240101\t*\t1"), ("/d/ptp_dme_2024q1.txt", "A\tC\t20240101\t*\t1"), ("/d/other.txt", "x")]
    lines = spark.createDataFrame([(path, (0, at), text) for at, (path, text) in enumerate(texts)], "path string, place struct<block:long,line:long>, value string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, status = editfiles.parse(lines, files, "ptp")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan.split("== Initial Plan ==")[0].split("BroadcastExchange")[0] and "ShuffledHashJoin" not in plan
        assert sorted(r.column_two for r in rows.collect()) == ["B", "C"] and [tuple(r) for r in status.collect()] == [("/d/ptp_dme_2024q1.txt", 2, 0, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
