import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlab.operators.imbalance import balanced_weights, class_weight_map, scale_pos_weight, smote
from churnlab.operators.knn import exact_knn


def _brute(ids, x, k):
    out = {}
    for i, a in enumerate(ids):
        d2 = np.zeros(len(ids))
        for j in range(x.shape[1]):
            diff = x[i, j] - x[:, j]
            d2 = d2 + diff * diff
        d = np.round(np.sqrt(d2), 9)
        d[i] = np.inf
        order = np.lexsort((ids, d))[:k]
        out[a] = list(ids[order])
    return out


@pytest.mark.parametrize("pivots,tile,dims,n", [(None, 1024, 4, 300), (40, 16, 4, 300), (30, 64, 9, 1500)])
def test_knn_exact_against_brute_force(spark, pivots, tile, dims, n):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(size=(n, 4)), np.zeros((60, 4)), rng.normal(3, 0.1, size=(40, 4))])
    if dims > 4:
        x = np.concatenate([x, rng.normal(size=(len(x), dims - 4))], axis=1)
    x = np.round(x, 3)
    ids = np.arange(len(x)) * 3 + 5
    cols = [f"f{i}" for i in range(x.shape[1])]
    pdf = pd.DataFrame(x, columns=cols)
    pdf["id"] = ids
    got = exact_knn(spark.createDataFrame(pdf), "id", cols, k=5, n_pivots=pivots, tile=tile).collect()
    gmap = {}
    for r in sorted(got, key=lambda r: (r["a"], r["nn_rank"])):
        gmap.setdefault(r["a"], []).append(r["b"])
    want = _brute(ids, x, 5)
    assert gmap == want


def _train(spark, n_pos=12, n_neg=40):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n_pos + n_neg):
        y = 1 if i < n_pos else 0
        rows.append((i, int(rng.integers(0, 3)), float(rng.normal(y, 1)), float(rng.normal()), y))
    return spark.createDataFrame(rows, "id long, seg int, x1 double, x2 double, y int")


def test_smote_balances_and_keeps_originals(spark):
    df = _train(spark)
    out = smote(df, "id", "y", ["seg", "x1", "x2"], int_features=["seg"], k=5, seed=42)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 40, 1: 40}
    orig = out.where(F.col("smote_source").isNull()).drop("smote_source", "smote_draw")
    assert orig.exceptAll(df).count() == 0 and df.exceptAll(orig).count() == 0
    syn = out.where(F.col("smote_source").isNotNull())
    box = df.where("y = 1").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("x1", "x2", "seg") for f in (F.min, F.max)]).first()
    for r in syn.collect():
        for c in ("x1", "x2", "seg"):
            assert box[f"min_{c}"] - 1e-9 <= r[c] <= box[f"max_{c}"] + 1e-9
    # deterministic
    again = smote(df.repartition(3), "id", "y", ["seg", "x1", "x2"], int_features=["seg"], k=5, seed=42)
    assert again.exceptAll(out).count() == 0


def test_smote_refuses_tiny_minority(spark):
    df = _train(spark, n_pos=5)
    with pytest.raises(ValueError):
        smote(df, "id", "y", ["x1", "x2"], k=5)


def test_weights(spark):
    df = _train(spark)
    w = class_weight_map(balanced_weights(df, "y"))
    assert abs(w[1] - 52 / (2 * 12)) < 1e-12 and abs(w[0] - 52 / (2 * 40)) < 1e-12
    assert abs(scale_pos_weight(df, "y").first()["scale_pos_weight"] - 40 / 12) < 1e-12


def test_knn_plan_has_no_cartesian(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(50, 2)), columns=["a", "b"])
    pdf["id"] = range(50)
    plan = exact_knn(spark.createDataFrame(pdf), "id", ["a", "b"], k=3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_tile_kernel_ring_path_equals_full():
    """The pruned (ring) path of one tile returns the same top k as the full distance matrix."""
    from churnlab.operators.knn import _tile_topk

    rng = np.random.default_rng(4)
    piv = np.zeros(3)
    members = rng.normal(size=(400, 3)) * np.linspace(0.1, 5, 400)[:, None]
    probes = rng.normal(size=(50, 3))
    mdf = pd.DataFrame({"pid": np.arange(400, dtype="int64"), "vec": list(members),
                        "d0": np.sqrt(((members - piv) ** 2).sum(1))})
    full = _tile_topk(5, 3)(pd.DataFrame({"pid": np.arange(1000, 1050, dtype="int64"), "vec": list(probes),
                                           "dp": np.sqrt((probes ** 2).sum(1)), "r": np.inf}), mdf)
    # a true k-th distance as the bound makes the ring path prune most pairs
    r = full.groupby("a")["dist"].max().reindex(range(1000, 1050)).to_numpy()
    ring = _tile_topk(5, 3)(pd.DataFrame({"pid": np.arange(1000, 1050, dtype="int64"), "vec": list(probes),
                                           "dp": np.sqrt((probes ** 2).sum(1)), "r": r}), mdf)
    key = lambda d: sorted(zip(d["a"], d["b"], d["dist"]))
    assert key(full) == key(ring)


def test_memory_of_a_tile_and_of_a_block_of_pivots_does_not_grow():
    """Distances are held in blocks of about 1 MB, however many members a tile or pivots a search has."""
    import tracemalloc

    from churnlab.operators.knn import _pivot_dist, _row_chunk, _tile_topk

    rng = np.random.default_rng(6)
    x = rng.normal(size=(1024, 4))
    tile = pd.DataFrame({"pid": np.arange(1024, dtype="int64"), "vec": list(x), "d0": 0.0, "dp": 0.0, "r": np.inf})
    tracemalloc.start()
    got = _tile_topk(5, 4)(tile, tile)
    for pivots in (100, 1_000, 10_000):
        _pivot_dist(rng.normal(size=(_row_chunk(pivots), 4)), rng.normal(size=(pivots, 4)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12_000_000
    want = _brute(np.arange(1024), x, 5)
    assert {a: list(g["b"]) for a, g in got.groupby("a")} == want
