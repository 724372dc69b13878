"""Forests grown together against brute force, against the same forests grown alone and against Spark's."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.operators import boosting, forest
from churnlab.operators.boosting import BoostParams
from churnlab.operators.forest import ForestParams, child_paths, drawn, forest_scores, root_path, tree_scores, tried_columns
from churnlab.operators.metrics import evaluate
from churnlab.plans import search
from churnlab.plans.models import _subset_size, apply_hyperparameters, get_model
from churnlab.plans.search import SearchConfig, random_search
from churnlab.plans.train import fit_model, plan_fit, score_forests, with_probability

from test_boosting import fitted, frame, sample

BASE = ForestParams(n_estimators=7, max_depth=5, min_instances=2, columns=2, seed=3)


def brute_tree(bins, y, counts, held, p, tree):
    """P(class 1) of the held rows: every split of every node tried, one forest alone."""
    w, out = np.array(p.class_weights), np.zeros(len(held))

    def impurity(rows):
        c = np.bincount(y[rows], counts[rows], 2) * w
        return 1 - ((c / c.sum()) ** 2).sum(), c.sum()

    def grow(rows, asked, path, depth):
        c = np.bincount(y[rows], counts[rows], 2) * w
        out[asked] = c[1] / c.sum()
        best, whole = None, impurity(rows)
        if depth < p.max_depth and c.min() > 0:
            for column in tried_columns(path, bins.shape[1], p.columns)[0]:  # the first among equals wins
                for at in range(bins[:, column].max()):
                    left = bins[rows, column] <= at
                    a, b = rows[left], rows[~left]
                    if min(counts[a].sum(), counts[b].sum()) < p.min_instances:
                        continue
                    gain = round(whole[0] * whole[1] - sum(i * n for i, n in (impurity(a), impurity(b))), 9)
                    if gain > 0 and gain / whole[1] >= p.min_gain and (best is None or gain > best[0] + 1e-9):
                        best = (gain, column, at, a, b)
        if best:
            _, column, at, a, b = best
            left, paths = bins_held[asked, column] <= at, child_paths(path)
            grow(a, asked[left], paths[:1], depth + 1)
            grow(b, asked[~left], paths[1:], depth + 1)

    bins_held = held
    grow(np.flatnonzero(counts), np.arange(len(held)), root_path(p.kin, tree), 0)
    return out


def binned(n=500, seed=0):
    rng = np.random.default_rng(seed)
    bins = np.column_stack([rng.integers(0, k, n) for k in (12, 2, 7, 30, 5)]).astype(np.uint8)
    y = (bins[:, 0] + 4 * bins[:, 1] - bins[:, 2] + rng.normal(0, 4, n) > 6).astype(np.int64)
    return bins, y


@pytest.mark.parametrize("change", [{}, {"class_weights": (0.6, 2.5)}, {"min_gain": 0.001}, {"columns": 5}, {"bootstrap": False}])
def test_trees_of_all_shapes_at_once_equal_brute_force(change, monkeypatch):
    monkeypatch.setattr(forest, "LEVEL_CELLS", 500)  # a few nodes at once
    bins, y = binned()
    held, _ = binned(200, seed=1)
    shapes = [(1, 30), (1, 2), (2, 5), (3, 30), (3, 0), (8, 30), (400, 30)]
    for tree in range(3):
        base = dataclasses.replace(BASE, **change)
        counts = drawn(base.kin, tree, 0, len(y)).astype(float)
        got = tree_scores(bins, y, 30, counts, held, base.kin, tree, shapes)
        for (least, depth), p in zip(shapes, got):
            one = dataclasses.replace(base, min_instances=least, max_depth=depth)
            assert np.allclose(p, brute_tree(bins, y, counts, held, one, tree), atol=1e-12)
    assert len({p.tobytes() for p in got}) >= 4


def test_forests_grown_together_equal_single_forests(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    x, y = sample(seed=20, missing=False)
    df, names = frame(spark, x, y)
    held = df.where("id % 3 = 0")
    fits = {4: BASE, 9: dataclasses.replace(BASE, n_estimators=3), 2: dataclasses.replace(BASE, max_depth=30, min_instances=1),
            1: dataclasses.replace(BASE, min_instances=20), 7: dataclasses.replace(BASE, seed=4), 8: dataclasses.replace(BASE, columns=4),
            5: dataclasses.replace(BASE, bootstrap=False), 6: dataclasses.replace(BASE, class_weights=(1.0, 3.0))}

    def scores(which):
        got = forest_scores(df, held, F.array(*names), len(names), F.col("y"), which).collect()
        return {f: sorted((r.label, r.p1, r.prediction) for r in got if r.fit == f) for f in which}

    together = scores(fits)
    assert all(len(s) == held.count() for s in together.values()) and len({str(s) for s in together.values()}) == len(fits)
    assert all((p > 0.5) == (label == 1) for s in together.values() for _, p, label in s)
    for f in (9, 2, 6):
        assert scores({f: fits[f]})[f] == together[f]


def test_settings_are_those_of_sparks_forests_and_so_is_the_quality(spark):
    spec, _ = apply_hyperparameters(get_model("rf"), {"max_depth": 100, "min_samples_split": 5, "min_samples_leaf": 2, "n_estimators": 60})
    est, own = spec.estimator("f", "y", None), spec.forest_params(9, {0: 0.6, 1: 2.5})
    assert (own.n_estimators, own.max_depth, own.min_instances) == (est.getNumTrees(), est.getMaxDepth(), est.getMinInstancesPerNode())
    assert (own.columns, own.min_gain, own.bootstrap, own.class_weights, own.seed) == (3, est.getMinInfoGain(), True, (0.6, 2.5), est.getSeed())
    assert [_subset_size(s, 9, 5) for s in ("all", "log2", "onethird", "4", "0.5", "auto")] == [9, 4, 3, 4, 5, 3]
    x, y = sample(n=1500, seed=21, missing=False)
    df, names = frame(spark, x, y)
    train, held = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    counts = {0: train.where("y = 0").count(), 1: train.where("y = 1").count()}
    for hp in ({"n_estimators": 60, "max_depth": 5}, {"n_estimators": 60, "max_depth": 100, "min_samples_leaf": 1, "min_samples_split": 2}):
        plan = plan_fit("rf", counts, "balanced", 42, hp)
        scored = score_forests(train, held, names, "y", {0: plan})
        got = evaluate(scored, "label", "prediction", "p1")
        model, _ = fit_model("rf", train, names, "y", "balanced", 42, hp, class_counts=counts)
        want = evaluate(with_probability(model.transform(held)), "y", "prediction", "p1")
        assert got["roc_auc"] > 0.8 and abs(got["roc_auc"] - want["roc_auc"]) < 0.02 and abs(got["f1"] - want["f1"]) < 0.04


def test_a_search_grows_its_forests_in_one_job_and_beyond_a_task_by_spark(spark, monkeypatch):
    x, y = sample(n=300, seed=22, missing=False)
    df, names = frame(spark, x, y)
    rows = df.withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    space = {"use_smote": ["true"], "rf": {"n_estimators": [4, 12], "max_depth": [2, 100], "min_samples_leaf": [1, 9]},
             "logreg": {"C": [1.0]}}
    fit, alone = search.fit_model, []
    monkeypatch.setattr(search, "fit_model", lambda name, *a, **k: alone.append(name) or fit(name, *a, **k))

    def found():
        runs = random_search(spark, rows, names, "y", SearchConfig(space=space), id_col="id").collect()
        trials = [r for r in runs if r.run_type == "trial"]
        assert len(trials) == 9 and {r.tags["scored_rows"] for r in trials} == {"75"}
        return {r.run_id: r.metrics["roc_auc"] for r in trials}

    small = found()
    assert not alone  # forests used to be a fit each, with a job for every level of its trees
    assert len(set(small.values())) >= 6
    monkeypatch.setattr(boosting, "TASK_CELLS", 0)
    large = found()
    assert alone == ["rf"] * 8 and small.keys() == large.keys()
    assert all(abs(small[k] - large[k]) < 0.15 for k in small)


def test_boosted_fits_that_differ_in_their_trees_only_are_grown_once(spark, monkeypatch):
    grown_apart, grown = boosting._grown_apart, []
    monkeypatch.setattr(boosting, "_grown_apart", lambda blocks, fits, *a: grown.append(fits) or grown_apart(blocks, fits, *a))
    x, y = sample(seed=23)
    base = BoostParams(n_estimators=6, max_depth=3, subsample=0.7, seed=4)
    fits = [dataclasses.replace(base, n_estimators=2), base, dataclasses.replace(base, max_depth=2), dataclasses.replace(base, n_estimators=0)]
    margins = [f.margins(x) for f in fitted(spark, x, y, fits)]
    assert [sorted((p.n_estimators, p.max_depth) for p in g) for g in grown] == [[(6, 2), (6, 3)]]
    for p, m in zip(fits, margins):
        assert np.allclose(m, fitted(spark, x, y, [p])[0].margins(x), atol=1e-12)
