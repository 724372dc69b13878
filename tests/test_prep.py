import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnlab.functions.hashing import seeded_hash
from churnlab.operators import prep
from churnlab.operators.rank import bucketed_rank
from churnlab.plans.prepare import PrepOptions, prepare
from churnlab.sources.tables import base_table

from conftest import SF_SMALL


def _frame(spark, n=600, pos_every=5):
    return spark.createDataFrame([(i, 1 if i % pos_every == 0 else 0, float(i % 17), "A" if i % 3 else "B")
                                  for i in range(n)], "id long, y int, x double, c string")


def test_bucketed_rank_equals_plain_window(spark):
    df = _frame(spark).withColumn("h", seeded_hash(42, F.col("id")))
    got = bucketed_rank(df, ["y"], "h", "id", "r", digits=2).select("id", "r")
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("y").orderBy("h", "id"))).select("id", "r")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_split_sizes_quotas_and_determinism(spark):
    df = _frame(spark, 601, 4)
    s = prep.stratified_split(df, "id", "y", 0.2, 42)
    counts = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    n_test = math.ceil(0.2 * 601)
    assert counts[(0, "test")] + counts[(1, "test")] == n_test
    pos = sum(v for (y, _), v in counts.items() if y == 1)
    assert abs(counts[(1, "test")] - pos * n_test / 601) < 1
    a = s.select("id", "split")
    for parts in (1, 7):
        b = prep.stratified_split(df.repartition(parts), "id", "y", 0.2, 42).select("id", "split")
        assert a.exceptAll(b).count() == 0
    assert s.count() == 601 and s.select("id").distinct().count() == 601


def test_split_refuses_singleton_class(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id long, y int")
    with pytest.raises(ValueError):
        prep.stratified_split(df, "id", "y", 0.5, 1)
    three = spark.createDataFrame([(i, i % 3) for i in range(9)], "id long, y int")
    with pytest.raises(ValueError, match="2 test rows for 3 classes"):
        prep.stratified_split(three, "id", "y", 0.2, 1)


def test_encoder_golden_order_and_unseen(spark):
    train = spark.createDataFrame([("Spain", "Male"), ("France", "Female"), ("Germany", "Male")], "g string, s string")
    enc = {(r["column_name"], r["value"]): r["code"] for r in prep.encode_fit(train, ["g", "s", "absent"]).collect()}
    assert enc == {("g", "France"): 0, ("g", "Germany"): 1, ("g", "Spain"): 2, ("s", "Female"): 0, ("s", "Male"): 1}
    test = spark.createDataFrame([("Italy", "Male")], "g string, s string")
    encoder = prep.encode_fit(train, ["g", "s"])
    with pytest.raises(Exception, match="not fitted on"):
        prep.encode_transform(test, encoder, ["g", "s"]).collect()
    kept = prep.encode_transform(test, encoder, ["g", "s"], handle_invalid="keep").first()
    assert kept["g"] == 3 and kept["s"] == 1
    assert prep.encode_transform(test, encoder, ["g", "s"], handle_invalid="skip").count() == 0


def test_scaler_population_std_and_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, k double")
    p = prep.scaler_params(prep.scale_fit(df, ["a", "k"]))
    assert p["a"] == (2.0, math.sqrt(2 / 3)) and p["k"] == (5.0, 1.0)
    out = prep.scale_transform(df, p, ["a", "k"]).agg(F.avg("a"), F.stddev_pop("a"), F.max("k")).first()
    assert abs(out[0]) < 1e-12 and abs(out[1] - 1) < 1e-12 and out[2] == 0.0


def test_prepare_on_test_tables(spark):
    p = prepare(base_table(spark, SF_SMALL), PrepOptions())
    rows = p.data.collect()
    assert len(rows) == 150
    meta = p.metadata().first()
    assert meta["n_train"] + meta["n_test"] == 150 and meta["n_test"] == 30
    assert meta["dropped_columns"] == ["customer_id", "name"]
    assert meta["categorical_encoded_columns"] == ["region", "segment"]
    train = p.data.where("split = 'train'")
    m = train.agg(F.avg("acct_balance").alias("m"), F.stddev_pop("acct_balance").alias("s")).first()
    assert abs(m["m"]) < 1e-9 and abs(m["s"] - 1) < 1e-9


def test_split_approx_is_map_only(spark):
    df = _frame(spark)
    plan = prep.split_approx(df, "id", 0.2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_encoder_has_one_path_for_any_size(spark, monkeypatch):
    monkeypatch.setattr(prep, "VALUES_PER_RANGE", 500)
    train = spark.range(3000).select(F.format_string("v%05d", "id").alias("g"), F.col("id").alias("n"))
    enc = prep.encode_fit(train, ["g", "n", "absent"])
    codes = {(r["column_name"], r["value"]): r["code"] for r in enc.collect()}
    assert len(codes) == 6000
    assert all(codes[("g", f"v{i:05d}")] == i and codes[("n", str(i))] == i for i in range(3000))
    new = spark.createDataFrame([("v00007", 1), ("zzz", 2), (None, 3)], "g string, i int")
    kept = {r["i"]: r["g"] for r in prep.encode_transform(new, enc, ["g"], handle_invalid="keep").collect()}
    assert kept == {1: 7, 2: 3000, 3: None}
    skipped = {r["i"]: r["g"] for r in prep.encode_transform(new, enc, ["g"], handle_invalid="skip").collect()}
    assert skipped == {1: 7, 3: None}
    with pytest.raises(Exception, match="not fitted on"):
        prep.encode_transform(new, enc, ["g"]).collect()


def test_encoder_of_many_values(spark):
    train = spark.range(120_000).select(F.md5(F.col("id").cast("string")).alias("g"))
    enc = prep.encode_fit(train, ["g"])
    assert enc.agg(F.count("*"), F.min("code"), F.max("code")).first()[:] == (120_000, 0, 119_999)
    assert prep.encode_transform(train, enc, ["g"]).agg(F.count_distinct("g")).first()[0] == 120_000


def test_split_moves_no_feature_column(spark):
    df = _frame(spark).withColumn("feature", F.col("id") * 2.0)
    out = prep.stratified_split(df, "id", "y", 0.2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    for digits in (1, 2, 3):
        same = prep.stratified_split(df, "id", "y", 0.2, digits=digits)
        assert sorted(map(tuple, same.collect())) == sorted(map(tuple, out.collect()))
