import os

import pytest
from pyspark.sql import functions as F

from churnlab.plans.scoring import parse_requests
from churnlab.sources.csv import scan_csv, scan_csv_dir, write_csv
from churnlab.sources.prepared import read_prepared, write_prepared
from churnlab.sources.runs import filter_runs, latest_artifact, log_runs, run_row


def test_scan_csv_checks(spark, tmp_dir):
    with pytest.raises(ValueError):
        scan_csv(spark, os.path.join(tmp_dir, "data.txt"))
    with pytest.raises(FileNotFoundError):
        scan_csv(spark, os.path.join(tmp_dir, "missing.csv"))
    p = os.path.join(tmp_dir, "one.CSV")
    with open(p, "w") as f:
        f.write("a,b\n1,NaN\n2,\n3,4.5\n")
    rows = scan_csv(spark, p, "a long, b double").orderBy("a").collect()
    assert [r["b"] for r in rows] == [None, None, 4.5]


def test_scan_csv_dir_union_by_name(spark, tmp_dir):
    d = os.path.join(tmp_dir, "parts")
    os.makedirs(d)
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("x,y\n1,2\n")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("y,z\n3,4\n")
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("ignore me\n")
    df = scan_csv_dir(spark, d, with_file_name=True)
    rows = sorted(((r["x"], r["y"], r["z"], r["source_file"]) for r in df.collect()), key=lambda t: t[3])
    assert rows == [(None, "3", "4", "a.csv"), ("1", "2", None, "b.csv")]
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    with open(os.path.join(empty, "x.txt"), "w") as f:
        f.write("no csv\n")
    with pytest.raises(FileNotFoundError):
        scan_csv_dir(spark, empty)


def test_write_csv_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i long, s string")
    p = write_csv(df, os.path.join(tmp_dir, "rt"))
    assert sorted(tuple(r) for r in scan_csv(spark, p + "/*.csv", "i long, s string").collect()) == \
        [(1, "a"), (2, None)]


def test_prepared_round_trip_and_missing_split(spark, tmp_dir):
    df = spark.createDataFrame([(1, 0.5, 1, "train"), (2, 0.1, 0, "test")], "id long, x double, y int, split string")
    p = write_prepared(df, os.path.join(tmp_dir, "prep"))
    assert read_prepared(spark, p, "y").count() == 2
    only = write_prepared(df.where("split = 'train'"), os.path.join(tmp_dir, "prep2"))
    with pytest.raises(FileNotFoundError, match="split=test"):
        read_prepared(spark, only, "y")
    with pytest.raises(FileNotFoundError):
        read_prepared(spark, os.path.join(tmp_dir, "nothing"), "y")


def test_request_parsing_rejects(spark):
    good = '{"input_data": {"columns": ["a", "b"], "index": [7, 8], "data": [["1", "x"], [2, "y"]]}}'
    reqs = spark.createDataFrame([(1, good), (2, '[1, 2]'), (3, '{"input_data": {"columns": ["a"], "data": [["1"]]}}'),
                                  (4, '{not json')], "request_id long, body string")
    rows, rejects = parse_requests(reqs, ["a", "b"], {"a": "double", "b": "string"})
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 7, 1.0, "x"), (1, 8, 2.0, "y")]
    rej = {r["request_id"]: r["reason"] for r in rejects.collect()}
    assert rej[2] == "malformed" and rej[4] == "malformed" and rej[3] == "missing columns: b"
    short = '{"input_data": {"columns": ["a", "b"], "index": [1, 2], "data": [["x", "y"], ["3"]]}}'
    rows2, rej2 = parse_requests(spark.createDataFrame([(5, short)], "request_id long, body string"), ["a", "b"],
                                 {"a": "double", "b": "string"})
    assert rows2.count() == 0
    assert sorted((r["index"], r["reason"]) for r in rej2.collect()) == [(1, "invalid values: a"), (2, "invalid values: b")]


def test_runs_filter_and_latest(spark, tmp_dir):
    rows = [run_row(run_id=f"r{i}", parent_run_id=None, experiment="hpo", run_name=name, run_type="sweep",
                    model=None, metrics={"score": i}) for i, name in enumerate(["hpo-rf", "hpo-logreg", "x-rf", "hpo-rf"])]
    path = os.path.join(tmp_dir, "runs")
    log_runs(spark, rows, path)
    runs = spark.read.parquet(path)
    got = {r["for_model"]: r["run_id"] for r in filter_runs(runs, ["rf", "logreg", "xgboost"], "hpo", "hpo").collect()}
    assert got == {"rf": "r0", "logreg": "r1"}
    got2 = {r["for_model"]: r["run_id"] for r in filter_runs(runs, ["rf"], "hpo", None, explicit={"rf": "x-rf"}).collect()}
    assert got2 == {"rf": "r2"}
    models = spark.createDataFrame([("model_a", "/p/1", "r", "2024-01-01 00:00:00"), ("model_b", "/p/2", "r",
                                    "2024-02-01 00:00:00")], "name string, path string, run_id string, created_at string") \
        .withColumn("created_at", F.to_timestamp("created_at"))
    assert latest_artifact(models).first()["path"] == "/p/2"
    assert latest_artifact(models, override="/x").first()["path"] == "/x"
