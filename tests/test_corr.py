"""Block correlations against pandas."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from churnlab.operators.corr import correlations


def test_correlations_with_nulls_constants_and_large_means(spark):
    rng = np.random.default_rng(0)
    x = pd.DataFrame({f"c{i}": rng.normal(10.0 ** i, 1 + i, 500) for i in range(6)})
    x["c1"] += x["c0"]
    x["c3"] = np.where(rng.random(500) < 0.3, np.nan, x["c3"] + 3 * x["c0"])
    x["c4"] = np.where(rng.random(500) < 0.9, np.nan, x["c4"])
    x["same"], x["none"], x["one"] = 0.1, np.nan, [1.0] + [np.nan] * 499
    names = list(x.columns)
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x.itertuples(index=False)],
                               ", ".join(f"{n} double" for n in names)).repartition(7)
    for block in (64, 2):
        got = {(r.a, r.b): r.r for r in correlations(df, names, block).collect()}
        want = x.corr()
        assert len(got) == len(names) ** 2
        for a in names:
            for b in names:
                r = want.loc[a, b]
                if np.isnan(r) or "same" in (a, b):
                    assert got[(a, b)] is None, (a, b, got[(a, b)])
                else:
                    assert abs(got[(a, b)] - r) < 1e-9
    assert correlations(df.limit(0), names[:3]).count() == 0


def test_200_columns_in_one_job(spark):
    df = spark.range(2000).select(*[(F.rand(i) + F.col("id") / (100 * (i + 1))).alias(f"c{i}") for i in range(200)]).coalesce(4)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("corr", "one job")
    try:
        found = correlations(df, df.columns).where("a = 'c0' and b = 'c199'").collect()
        jobs = len(tracker.getJobIdsForGroup("corr"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    x = df.toPandas()
    assert abs(found[0].r - x["c0"].corr(x["c199"])) < 1e-9
    assert jobs <= 3  # one per exchange under adaptive execution
