"""Edge frames (FIXTURES.md F8): empty, all-null, constant, one class."""

from churnlab.operators import prep
from churnlab.operators import profile as prof
from churnlab.operators.metrics import evaluate


def test_empty_frame(spark):
    df = spark.createDataFrame([], "id long, x double, y int")
    d = prof.describe(df, ["x"]).first()
    assert d["count"] == 0 and d["mean"] is None and d["q50"] is None
    assert prof.rate_by_group(df, ["x"], "y").count() == 0
    assert prof.duplicate_count(df).first()["n_duplicates"] == 0
    assert evaluate(df.withColumn("p", df.y), "y", "p", "x")["roc_auc"] == 0.5


def test_all_null_and_constant_columns(spark):
    df = spark.createDataFrame([(1, None, 5.0, 0), (2, None, 5.0, 1), (3, None, 5.0, 0)], "id long, n double, k double, y int")
    d = {r["column_name"]: r for r in prof.describe(df, ["n", "k"]).collect()}
    assert d["n"]["count"] == 0 and d["n"]["q25"] is None
    assert d["k"]["std"] == 0.0 and d["k"]["q75"] == 5.0
    card = {r["column_name"]: r["unique_count"] for r in prof.cardinality(df).collect()}
    assert card["n"] == 0 and card["k"] == 1
    assert {r["column_name"] for r in prof.null_counts(df).collect()} == {"n"}
    assert prof.histogram(df, ["n"], "y").count() == 0
    params = prep.scaler_params(prep.scale_fit(df, ["k"]))
    assert params["k"] == (5.0, 1.0)


def test_one_class_split_and_weights(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)], "id long, y int")
    s = prep.stratified_split(df, "id", "y", 0.2, 42)
    assert s.where("split = 'test'").count() == 2


def test_approx_options_run(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(200)], "id long, x double")
    d = prof.describe(df, ["x"], approx=True).first()
    assert d["count"] == 200 and 0.0 <= d["q25"] <= d["q50"] <= d["q75"] <= 6.0
    card = {r["column_name"]: r["unique_count"] for r in prof.cardinality(df, approx=True).collect()}
    assert card["x"] == 7 and 190 <= card["id"] <= 210


def test_bounded_broadcast_falls_back_beyond_the_bound(spark):
    from churnlab.operators.joins import bounded_broadcast, row_count_at_most
    small = spark.range(5)
    big = spark.range(50)
    assert row_count_at_most(small, 5) and not row_count_at_most(big, 5)
    hinted = spark.range(1000).join(bounded_broadcast(small, 5), "id")
    plain = spark.range(1000).join(bounded_broadcast(big, 5), "id")
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower() or \
        "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    assert "strategy=broadcast" not in plain._jdf.queryExecution().analyzed().toString().lower()
    assert hinted.count() == 5 and plain.count() == 50
