import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from churnlab.operators.metrics import classification_metrics, evaluate, evaluate_each, roc_auc, score_counts


def _df(spark, y, p, s):
    return spark.createDataFrame(list(zip(y, p, s)), "y int, p int, s double")


def test_golden_example(spark):
    m = evaluate(_df(spark, [0, 1, 1, 0], [0, 1, 0, 0], [0.1, 0.9, 0.4, 0.2]), "y", "p", "s")
    assert m["accuracy"] == 0.75 and m["precision"] == 1.0 and m["recall"] == 0.5
    assert abs(m["f1"] - 2 / 3) < 1e-12
    assert m["roc_auc"] == 1.0  # both positives outrank both negatives


def test_one_class_and_zero_division(spark):
    m = evaluate(_df(spark, [0, 0], [0, 0], [0.3, 0.2]), "y", "p", "s")
    assert m["roc_auc"] == 0.5 and m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0


def _brute_auc(y, s):
    pos = [v for v, t in zip(s, y) if t == 1]
    neg = [v for v, t in zip(s, y) if t == 0]
    tot = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return tot / (len(pos) * len(neg))


def test_auc_ties_and_buckets(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 800).tolist()
    s = np.round(rng.normal(size=800) + np.array(y) * 0.7, 1).tolist()
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    want = _brute_auc(y, s)
    for b in (1, 4, 64):
        assert abs(roc_auc(df, "y", "s", buckets=b).first()[0] - want) < 1e-12
    neg = df.withColumn("s", -F.col("s"))
    assert abs(roc_auc(neg, "y", "s").first()[0] - (1 - want)) < 1e-12


def test_metrics_nulls_ansi_safe(spark):
    m = classification_metrics(_df(spark, [1, 1], [0, 0], [0.1, 0.2]), "y", "p").first()
    assert m["precision"] == 0.0 and m["accuracy"] == 0.0


def test_keys_measured_at_once_equal_one_by_one(spark):
    rows = [(k, i % 2 if k < 2 else 0, int((i * 7 + k) % 10 > 4), ((i * 7 + k) % 10) / 10) for k in range(3) for i in range(30 + k)]
    df = spark.createDataFrame(rows, "k int, y int, p int, s double")
    found = evaluate_each(score_counts(df, "y", "s", "k", "p"), "k", "p")
    assert found == {k: evaluate(df.where(F.col("k") == k), "y", "p", "s") for k in range(3)}
    assert found[2]["roc_auc"] == 0.5 and found[0] != found[1]
