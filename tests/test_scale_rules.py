"""Rules that keep plans the same at any size: no pair joins, no single-task windows, storage keyed by the data."""

import re

import pytest
from pyspark.sql import functions as F

from churnlab import catalog
from churnlab.operators import prep
from churnlab.operators import profile as prof
from churnlab.operators.metrics import roc_auc
from churnlab.session import ensure_checkpoint_dir
from churnlab.sources.csv import scan_csv, write_csv

from conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_bounds_are_broadcast_whatever_the_threshold(spark):
    df = spark.range(2000).select((F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("double").alias("a"),
                                  (F.col("id") % 7).cast("double").alias("b"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (prof.histogram(df, ["a", "b"], "y", 10), prof.boxplot_stats(df, ["a", "b"], "y")):
            assert re.search(r"BroadcastHashJoin \[(feature|label)", plan_of(report))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_auc_has_ranges_at_any_size(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.1), (0, 0.9)], "y int, s double")
    got = roc_auc(df, "y", "s")
    assert got.first()[0] == 0.5
    windows = re.findall(r"Window \[[^\n]*", plan_of(got))
    assert any("[_b#" in w for w in windows)


def test_crosstab_keeps_or_refuses_other_classes(spark):
    df = spark.createDataFrame([("x", 0), ("x", 1), ("y", 2), ("y", 2), (None, 2)], "c string, y int")
    got = {r["value"]: r.asDict() for r in prof.crosstab(df, ["c"], "y").collect()}
    assert got["y"]["n_2"] == 2 and got["x"]["n_0"] == 1 and got["x"]["n_2"] == 0
    with pytest.raises(ValueError, match="classes outside"):
        prof.crosstab(df, ["c"], "y", classes=(0, 1))


def test_csv_is_read_by_name(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2.5, "x"), (3, None, "y")], "a long, b double, c string")
    write_csv(df.select("c", "b", "a"), f"{tmp_dir}/t")
    got = scan_csv(spark, f"{tmp_dir}/t/*.csv", "a long, b double, missing int")
    assert got.columns == ["a", "b", "missing", "c"]
    assert sorted(map(tuple, got.collect())) == [(1, 2.5, None, "x"), (3, None, None, "y")]


def test_stored_tables_follow_the_data(spark, tmp_dir):
    for t in ("customer", "orders", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_dir}/{t}.parquet")
    n = catalog._base(spark, tmp_dir).count()
    path = catalog._stored_path(spark, "base", tmp_dir)
    assert catalog._stored_path(spark, "base", tmp_dir) == path and catalog._exists(spark, path)
    spark.read.parquet(f"{SF_SMALL}/customer.parquet").where("c_custkey > 50").write.mode("overwrite").parquet(f"{tmp_dir}/customer.parquet")
    assert catalog._stored_path(spark, "base", tmp_dir) != path
    assert catalog._base(spark, tmp_dir).count() < n


def test_a_cluster_without_shared_folder_is_refused():
    class Context:
        master = "spark://somewhere:7077"

    class Conf:
        @staticmethod
        def get(key, default):
            return default

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_split_quota_ends_in_any_bucket(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 3).cast("int").alias("y"))
    for size in (0.01, 0.5, 0.98):
        got = prep.stratified_split(df, "id", "y", size, digits=1) if size != 0.01 else prep.random_split(df, "id", size)
        assert got.where("split = 'test'").count() == -(-int(size * 500 * 1000) // 1000)


def test_a_column_s_values_never_meet_the_profile_in_one_task(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = catalog._merged_profile(spark, SF_SMALL)
        assert re.search(r"Exchange hashpartitioning\(column_name#\d+, (knownfloatingpointnormalized\(.*)?value#\d+", plan_of(out))
        assert all(r.quartiles_hold and r.distinct_holds for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
