"""Property checks of the small driver-side pieces that decide exact sizes."""

import math

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from churnlab.operators.prep import class_quotas
from churnlab.plans.search import _clean, param_grid


def test_quotas_exact_and_proportional(spark):
    rng = np.random.default_rng(4)
    for test_size in (0.05, 0.2, 0.5, 0.93):
        sizes = {c: int(k) for c, k in enumerate(rng.integers(2, 900, int(rng.integers(1, 7))))}
        df = spark.createDataFrame([(c,) for c, k in sizes.items() for _ in range(k)], "y int")
        q = {r["cls"]: r["n_test_c"] for r in class_quotas(df, "y", test_size).collect()}
        n = sum(sizes.values())
        assert sum(q.values()) == math.ceil(test_size * n)
        n_train = n - math.ceil(test_size * n)
        for c, k in sizes.items():
            assert abs(k - q[c] - k / n * n_train) < 1 + 1e-9
            assert 0 <= q[c] <= k


@given(st.lists(st.one_of(st.none(), st.sampled_from(["none", "NULL", " ", "", "a", "b"]), st.integers(0, 3)),
                max_size=8))
def test_clean_drops_null_words(values):
    out = _clean(values)
    assert all(v is not None and str(v).strip().lower() not in ("none", "null", "") for v in out)
    space = {"model_types": ["rf"], "rf": {"p": values}}
    g = param_grid(space)
    assert len(g.get("rf", [])) == (len(out) if out else 1)


def test_auc_hot_score(spark):
    from churnlab.operators.metrics import roc_auc
    rng = np.random.default_rng(9)
    n = 3000
    y = rng.integers(0, 2, n)
    s = np.where(np.arange(n) < n // 3, 0.5, rng.normal(size=n) + y)  # a third of rows share one score
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    for b in (None, 16):
        assert abs(roc_auc(df, "y", "s", buckets=b).first()[0] - want) < 1e-12
