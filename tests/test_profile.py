import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from churnlab.operators import profile as prof
from churnlab.operators.quantiles import exact_quantiles


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 10.0, None], "b": [5, 5, 5, 6, 7]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b bigint")
    out = {r["column_name"]: r for r in prof.describe(df).collect()}
    d = pdf.describe()
    for c in ("a", "b"):
        assert out[c]["count"] == d[c]["count"]
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"),
                             ("q75", "75%"), ("max", "max")):
            assert abs(out[c][ours] - round(d[c][theirs], 6)) < 1e-6, (c, ours)
    assert out["a"]["q25"] == 1.75  # exact linear, not Spark's summary() approximation


def test_exact_quantiles_bucketed_equals_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.integers(0, 5, 500).astype(float)])
    labels = rng.integers(0, 3, len(vals))
    df = spark.createDataFrame(pd.DataFrame({"g": labels, "v": vals}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    for buckets in (1, 7, 64):
        got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, ["v"], probs, ["g"], buckets=buckets).collect()}
        for g in range(3):
            want = np.quantile(vals[labels == g], probs)
            for p, w in zip(probs, want):
                assert abs(got[(g, p)] - w) < 1e-9, (buckets, g, p)


def test_null_duplicate_cardinality(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, 3.0, None), (2, 3.0, None), (3, 4.0, "y")],
                               "a int, b double, c string")
    assert {r["column_name"]: r["n_null"] for r in prof.null_counts(df).collect()} == {"b": 2, "c": 2}
    assert prof.duplicate_count(df).first()["n_duplicates"] == 2  # nulls compare equal
    card = {r["column_name"]: (r["unique_count"], r["unique_ratio"]) for r in prof.cardinality(df).collect()}
    assert card == {"a": (3, 0.6), "b": (2, 0.4), "c": (2, 0.4)}


def test_rate_by_group_drops_null_keys_but_overall_counts_all(spark):
    df = spark.createDataFrame([("A", 1), ("A", 0), ("B", 1), (None, 1)], "g string, y int")
    rows = {r["value"]: r for r in prof.rate_by_group(df, ["g"], "y").collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"]["rate"] == 0.5 and rows["A"]["overall"] == 0.75 and rows["A"]["diff"] == -0.25


def test_histogram_constant_and_last_bin_closed(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (0.0, 1), (3.0, 1)], "x double, y int")
    h = prof.histogram(df, ["x"], "y", bins=30, density=True).collect()
    c0 = [r for r in h if r["label"] == 0]
    assert sum(r["count"] for r in c0) == 2 and len(c0) == 30
    assert [r["bin"] for r in c0 if r["count"]] == [15]  # widened to [0.5, 1.5]
    c1 = {r["bin"]: r["count"] for r in h if r["label"] == 1 and r["count"]}
    assert c1 == {0: 1, 29: 1}  # the max falls in the last bin
    dens = sum(r["density"] * (r["bin_hi"] - r["bin_lo"]) for r in h if r["label"] == 1)
    assert abs(dens - 1.0) < 1e-5


def test_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)], "a double, b double, k double")
    r = {(x["a"], x["b"]): x["r"] for x in prof.corr_matrix(df, ["a", "b", "k"]).collect()}
    assert r[("a", "k")] is None and r[("k", "k")] is None
    assert abs(r[("a", "b")] - round(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1], 6)) < 1e-6
    assert r[("a", "b")] == r[("b", "a")]


def test_boxplot_whiskers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([(float(v), 0) for v in vals], "x double, y int")
    r = prof.boxplot_stats(df, ["x"], "y").first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (r["q1"], r["q3"]) == (q1, q3)
    assert r["whisker_hi"] == 8 and r["whisker_lo"] == 1 and r["n_fliers"] == 1


def test_crosstab_and_value_counts(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1), (None, 1)], "c string, y int")
    ct = {(r["dimension"], r["value"]): (r["n_0"], r["n_1"]) for r in prof.crosstab(df, ["c"], "y").collect()}
    assert ct == {("c", "a"): (1, 1), ("c", "b"): (0, 1)}
    assert [tuple(r) for r in prof.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert prof.class_counts(df, "y").first().asDict() == {"positives": 3, "negatives": 1}
    assert F is not None


def test_histogram_matches_numpy_on_edge_values(spark):
    rng = np.random.default_rng(2)
    groups = {0: rng.integers(0, 9, 500).astype(float), 1: np.round(rng.normal(3, 2, 400), 1)}
    rows = [(float(v), g) for g, vals in groups.items() for v in vals]
    df = spark.createDataFrame(rows, "x double, y int")
    got = prof.histogram(df, ["x"], "y", bins=30, density=True).collect()
    for g, vals in groups.items():
        counts, edges = np.histogram(vals, bins=30)
        dens, _ = np.histogram(vals, bins=30, density=True)
        mine = sorted((r["bin"], r["count"], r["density"], r["bin_lo"]) for r in got if r["label"] == g)
        assert [m[1] for m in mine] == counts.tolist()
        assert all(abs(m[2] - round(d, 6)) < 1e-6 for m, d in zip(mine, dens))
        assert all(abs(m[3] - round(e, 6)) < 1e-9 for m, e in zip(mine, edges[:-1]))


def test_boxplot_whisker_never_inside_box(spark):
    # q3 interpolates above every non-outlier value: the upper whisker stops at q3
    vals = [1.0, 1.0, 1.0, 1.0, 2.0, 50.0, 60.0]
    df = spark.createDataFrame([(v, 0) for v in vals], "x double, y int")
    r = prof.boxplot_stats(df, ["x"], "y").first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    hi = q3 + 1.5 * (q3 - q1)
    inside = [v for v in vals if v <= hi]
    assert r["whisker_hi"] == round(max(max(inside), q3), 6)
    assert r["n_fliers"] == sum(1 for v in vals if v > hi or v < q1 - 1.5 * (q3 - q1))
