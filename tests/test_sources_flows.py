import os

import pytest
from pyspark.sql import functions as F

from tallywise.sources.records import explode_or_reject
from tallywise import compare_batches, compare_files, compare_queries
from tallywise.operators import frames
from tallywise.operators.control import control_total
from tallywise.session import build_session, object_store_conf, shared_folder
from tallywise.sources import manifest, records
from tallywise.sources.delimited import read_delimited, read_report, write_report
from tallywise.sources.tables import from_batch, literal_rows
from tests.conftest import rows


def test_delimited_files(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id | full name\n001|'a|b'\n1|1.0\n")
    df = read_delimited(spark, str(tmp_path / "f.csv"), sep="|")
    assert df.columns == ["id", "full_name"]
    assert rows(df) == [("001", "a|b"), ("1", "1.0")]


def test_reports_are_one_file_and_lose_the_empty_string(spark, tmp_path):
    df = spark.createDataFrame([("", "x"), (None, "y")], "a string, b string").repartition(2)
    write_report(df, str(tmp_path / "r"))
    assert len([f for f in os.listdir(tmp_path / "r") if f.endswith(".csv")]) == 1
    assert rows(read_report(spark, str(tmp_path / "r"))) == [(None, "x"), (None, "y")]


def test_batches(spark):
    literal_rows(spark, [("1", "a"), ("2", "b"), ("3", "c")], "pcm_batch_id string, v string").createOrReplaceTempView("t_b")
    assert rows(from_batch(spark, "t_b", "pcm_batch_id", "1 , 3").select("v")) == [("a",), ("c",)]


def test_json_records(spark):
    df = spark.createDataFrame([(1, '{"rows": [{"a": 1, "b": "x"}, {"a": 2}], "n": 2}'), (2, "nope"), (3, '{"rows": []}')],
                               "id int, doc string")
    assert rows(records.explode_json_records(df, "doc", "a int, b string")) == [(1, 1, "x"), (1, 2, None)]
    assert rows(records.malformed_records(df, "doc", "n int").select("id")) == [(2,)]
    made = records.to_json_records(spark.createDataFrame([(1, None)], "a int, b string")).first()["record"]
    assert made == '{"a":1,"b":null}'


def test_manifest(spark, tmp_path):
    for name, text in (("ABC/x.csv", "1"), ("ABC/sub/y.csv", ""), ("C/z.csv", "1")):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    files = manifest.file_manifest(spark, str(tmp_path))
    report = F.regexp_extract("path", f"{tmp_path}/([^/]+)/", 1)
    expected = spark.createDataFrame([("ABC", 2), ("C", 3), ("D", 51)], "report string, expected_count int")
    assert rows(manifest.manifest_check(files.withColumn("report", report), expected)) == [
        ("ABC", 2, 2, 2, 1, True), ("C", 3, 1, 1, 0, False), ("D", 51, 0, 0, 0, False)]
    listed = manifest.file_manifest(spark, f"file://{tmp_path}", empty_files=False)
    assert rows(listed.select("file_name", "length")) == [("x.csv", 1), ("z.csv", 1)]


def test_control_total_of_nothing(spark):
    df = spark.createDataFrame([(1.5, "2025-05-14"), (2.0, "2025-05-13")], "amount double, businessdate string")
    total = control_total(df, df.where("amount < 0"), ["amount"], where=F.col("businessdate") == "2025-05-14").first()
    assert str(total["base_value"]) == "1.50" and total["actual_value"] is None and total["ok"] is False


def test_range_filter_defaults(spark):
    df = spark.createDataFrame([(1, "2025-01-01", "a", False), (2, "2025-01-02", "b", True), (3, "2025-01-03", "a", None)],
                               "id int, d string, t string, archived boolean")
    both = frames.filter_range(df, "d", "2025-01-01", "2025-01-02", {"t": []})
    assert rows(both.select("id")) == [(1,), (2,)]
    assert rows(frames.filter_range(df, "d", "2025-01-01", "2025-01-03", {"t": ["a"]}, "archived").select("id")) == [(1,), (3,)]
    assert frames.filter_range(df, "d", "2025-01-01", "2025-01-03", {}, "archived", include_archived=True).count() == 3


def test_query_run(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 3 AS v", "'n' AS note").createOrReplaceTempView("t_base")
    spark.range(1, 11).selectExpr("id", "if(id = 4, 9, id % 3) AS v", "'m' AS note").createOrReplaceTempView("t_actual")
    run = compare_queries(spark, "SELECT * FROM t_base", "SELECT * FROM t_actual", " id ", str(tmp_path), exclude="note",
                          full_diff=True)
    assert run.verdict == {"status": "FAIL", "mismatched_cells": 1, "mismatched_keys": 1, "extra_base": 1, "extra_actual": 1}
    assert sorted(os.listdir(tmp_path)) == ["ActualExtra", "BaseExtra", "ColumnDiffSum", "Diffs", "MismatchCount",
                                            "MismatchFiltered1000"]
    assert rows(read_report(spark, f"{tmp_path}/Diffs")) == [("4", "v", "1", "9")]
    assert rows(read_report(spark, f"{tmp_path}/BaseExtra")) == [("0",)]


def test_query_run_without_differences_writes_nothing(spark, tmp_path):
    run = compare_queries(spark, "SELECT id FROM range(3)", "SELECT id FROM range(3)", "id", str(tmp_path))
    assert run.verdict["status"] == "PASS" and os.listdir(tmp_path) == []


def test_second_run_leaves_no_stale_report(spark, tmp_path):
    compare_queries(spark, "SELECT id FROM range(3)", "SELECT id FROM range(2)", "id", str(tmp_path))
    run = compare_queries(spark, "SELECT id FROM range(3)", "SELECT id FROM range(3)", "id", str(tmp_path))
    assert run.verdict["status"] == "PASS" and rows(read_report(spark, f"{tmp_path}/BaseExtra")) == []


def test_control_total_sums_before_it_rounds(spark):
    base = spark.createDataFrame([(0.004,)] * 3, "x double")
    total = control_total(base, base.limit(1), ["x"]).first()
    assert total["ok"] is False
    exact = spark.sql("SELECT CAST(9007199254740993 AS BIGINT) AS x")
    assert str(control_total(exact, exact, ["x"], scale=0).first()["base_value"]) == "9007199254740993"


def test_records_with_commas_in_types(spark):
    df = spark.createDataFrame([('{"r": [{"p": 1.25, "s": {"a": 1, "b": "x"}}]}',), ('{"r": [{"p": ',)], "doc string")
    found, bad = explode_or_reject(df, "doc", "p decimal(10,2), s struct<a:int,b:string>")
    assert [(str(r["p"]), r["s"]["b"]) for r in found.collect()] == [("1.25", "x")] and bad.count() == 1


def test_batch_run(spark, tmp_path):
    data = [("1", "10", "2025-05-14", "k1", "a"), ("1", "10", "2025-05-14", "k2", "b"), ("2", "20", "2025-05-14", "k1", "a"),
            ("2", "20", "2025-05-14", "k2", "c")]
    spark.createDataFrame(data, "pcm_batch_id string, core_batch_id string, business_date string, k string, v string") \
        .createOrReplaceTempView("risk_daily_positions")
    run = compare_batches(spark, "risk_daily_positions", "1", "risk_daily_positions", "2", "k", str(tmp_path),
                          exclude=["core_batch_id"])
    facts = dict(rows(run.summary))
    assert facts["Test Status"] == "FAIL" and facts["Product Name"] == "DAILY"
    assert facts["Baseline CORE Batch ID"] == "10" and facts["Regression CORE Batch ID"] == "20"
    assert facts["Business Date"] == "2025-05-14" and facts["Mismatched Records Count"] == "1"
    assert facts["Records present in Baseline"] == "2"


def test_file_run(spark, tmp_path):
    (tmp_path / "b.csv").write_text("id,part no,v\n1,x,a\n2,y,b\n2,y,b\n")
    (tmp_path / "a.csv").write_text("id;part no;v\n1;x;a\n2;y;c\n")
    run = compare_files(spark, str(tmp_path / "b.csv"), str(tmp_path / "a.csv"), "id|part_no", str(tmp_path / "out"),
                        actual_sep=";")
    assert rows(run.cells) == [("2", "y", "v", "b", "c")]
    assert rows(run.comparison.duplicate_keys()) == [("base", "2", "y", 2)]
    with pytest.raises(KeyError):
        compare_files(spark, str(tmp_path / "b.csv"), str(tmp_path / "a.csv"), "nope", str(tmp_path / "out2"), actual_sep=";")


def test_object_store_settings_come_from_the_environment():
    env = {"access_key": "a", "secret_key": "s", "endpoint_url_http": "e", "other": "x"}
    assert object_store_conf(env) == {
        "spark.hadoop.fs.s3a.access.key": "a", "spark.hadoop.fs.s3a.secret.key": "s", "spark.hadoop.fs.s3a.endpoint": "e"}
    assert object_store_conf({}) == {}


def test_session(spark):
    assert build_session("x").conf.get("spark.sql.adaptive.enabled") == "true"
    assert shared_folder(spark) == shared_folder(spark)
