"""Preparation in two scans: equal to the step-by-step operators, with a counted number of rows read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.operators import prep, prepfit
from churnlab.operators.prepfit import fit_in_one_scan
from churnlab.plans.prepare import PrepOptions, prepare
from churnlab.sources.tables import Roles

ROLES = Roles(id_col="id", target="y", drop=("name",), categorical=("g", "k"))


def table(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i * 7, f"n{i}", ["a", "b", None, "Ä"][rng.integers(4)] if i else "only once", int(rng.integers(3)) * 10,
             float(rng.normal(1e6, 3)) if rng.random() > 0.1 else None, 4.0, int(rng.integers(9)), int(rng.random() < 0.1)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, name string, g string, k int, x double, same double, z int, y int")


def counted(df, spark):
    """``df``, and the number of its rows that tasks have read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInPandas(count, df.schema), seen


@pytest.mark.parametrize("small_bytes,digits,near", [(1 << 40, 3, 8), (0, 3, 8), (0, 1, 1), (0, 2, 0)])
def test_equal_to_split_encoder_and_scaler(spark, monkeypatch, small_bytes, digits, near):
    monkeypatch.setattr(prepfit, "SMALL_BYTES", small_bytes)
    monkeypatch.setattr(prepfit, "DIGITS", digits)
    monkeypatch.setattr(prepfit, "NEAR_BUCKETS", near)
    df = table(spark)
    for target in ("y", None):
        got = fit_in_one_scan(df, "id", target, ["g", "k"], ["x", "same", "z"], 0.2, 42)
        split = prep.stratified_split(df, "id", target, 0.2, 42)
        mine = prep.split_by_cuts(df, "id", target, got.cuts, 42)
        assert mine.select("id", "split").exceptAll(split.select("id", "split")).count() == 0
        train = split.where("split = 'train'")
        assert (got.n_train, got.n_test) == (train.count(), split.count() - train.count())
        want = prep.encode_fit(train, ["g", "k"])
        assert sorted(map(tuple, got.encoder.collect())) == sorted(map(tuple, want.collect()))
        scaled = {r.column_name: (r.mean, r.scale) for r in prep.scale_fit(train, ["x", "same", "z"]).collect()}
        for r in got.scaler.collect():
            assert np.allclose((r.mean, r.scale), scaled[r.column_name], rtol=1e-12, atol=1e-12)


def test_a_value_of_test_rows_only_gets_no_code(spark):
    df = table(spark, 200)
    split = prep.stratified_split(df, "id", "y", 0.2, 42)
    lonely = split.where("split = 'test'").first()["id"]
    df = df.withColumn("g", F.when(F.col("id") == lonely, "in test only").otherwise(F.col("g")))
    values = {r.value for r in fit_in_one_scan(df, "id", "y", ["g"], ["z"]).encoder.collect()}
    assert "in test only" not in values and "a" in values


def test_two_scans_of_the_table(spark, tmp_dir):
    table(spark, 5000).write.parquet(f"{tmp_dir}/table")
    rows, seen = counted(spark.read.parquet(f"{tmp_dir}/table"), spark)
    p = prepare(rows, PrepOptions(roles=ROLES))
    p.data.write.parquet(f"{tmp_dir}/prepared")
    meta = p.metadata().first()
    assert seen.value == 2 * 5000
    assert (meta["n_train"], meta["n_test"]) == (4000, 1000)
    assert p.data.columns == ["id", "g", "k", "x", "same", "z", "y", "split"] and p.dropped_columns == ["name"]


def test_refusals_and_tables_without_numbers(spark):
    df = table(spark, 50)
    with pytest.raises(ValueError, match="fewer than 2"):
        fit_in_one_scan(df.withColumn("y", F.when(F.col("id") == 0, 5).otherwise(0)), "id", "y", [], ["z"])
    with pytest.raises(ValueError, match="has nulls"):
        fit_in_one_scan(df.withColumn("y", F.when(F.col("id") > 7, 1)), "id", "y", [], ["z"])
    with pytest.raises(ValueError, match="test_size"):
        fit_in_one_scan(df, "id", "y", [], [], 1.5)
    none = fit_in_one_scan(df, "id", None, [], [])
    assert none.scaler.count() == 0 and none.encoder.count() == 0 and none.n_test == 10
