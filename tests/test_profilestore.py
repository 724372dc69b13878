"""Merged profiles against one pass over everything."""

import numpy as np
from pyspark.sql import functions as F

from churnlab.operators.profilestore import add_parts, merged_profile, profile_parts, read_parts


def table(spark, seed=0, n=30_000):
    df = spark.range(n).select("id", (F.col("id") % 7).cast("string").alias("day"), (F.col("id") % 2).cast("int").alias("y"),
                               (F.randn(seed) * 3 + 1e6).alias("x"), (F.col("id") % 50).alias("z"))
    return df.withColumn("x", F.when(F.col("id") % 11 != 0, F.col("x"))).withColumn("none", F.lit(None).cast("double"))


def check(rows, x, columns):
    for r in rows:
        v = x[r.column_name].dropna().to_numpy(dtype=float)
        assert r.n_rows == len(x) and r.n == len(v)
        if not len(v):
            assert r.mean is None and r.unique_count == 0 and r.q50 is None
            continue
        assert np.allclose([r.mean, r.std, r.min, r.max], [v.mean(), v.std(ddof=1), v.min(), v.max()], rtol=1e-9)
        exact = len(np.unique(v))
        assert abs(r.unique_count - exact) <= max(1, 0.03 * exact)
        for p, q in ((0.25, r.q25), (0.5, r.q50), (0.75, r.q75)):
            assert (v < q).mean() <= p + 0.01 and (v <= q).mean() >= p - 0.01
    assert {r.column_name for r in rows} == set(columns)


def test_merged_profile_equals_one_pass(spark, tmp_dir):
    df, columns = table(spark), ["x", "z", "none"]
    path = f"{tmp_dir}/profile"
    add_parts(profile_parts(df.where("day <> '3'"), columns, "day"), path)
    add_parts(profile_parts(df.where("day = '3'").withColumn("x", F.lit(5.0)), columns, "day"), path)  # delivered wrongly at first
    add_parts(profile_parts(df.where("day = '3'"), columns, "day"), path)
    parts = read_parts(spark, path)
    assert parts.count() == 7 * len(columns)
    check(merged_profile(parts).collect(), df.toPandas(), columns)
    week = df.where("day in ('1', '2')").toPandas()
    check(merged_profile(parts.where("part in ('1', '2')")).collect(), week, columns)


def test_merged_profile_by_class(spark):
    df = table(spark, 1, 5000)
    got = merged_profile(profile_parts(df, ["x", "z"], "day", ["y"]), ["y"]).collect()
    x = df.toPandas()
    for y in (0, 1):
        check([r for r in got if r.y == y], x[x["y"] == y], ["x", "z"])
