"""Newton boosting and the shared-scan solvers against dense brute force."""

import dataclasses
import os

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from churnlab.operators import boosting
from churnlab.operators.boosting import BoostParams, Forest, fit_boosted
from churnlab.operators.logistic import LogisticParams, fit_logistic
from churnlab.plans import boosted
from churnlab.operators import imbalance as imb
from churnlab.operators.metrics import evaluate
from churnlab.plans.search import PROD_SPACE, SearchConfig, fold_of, param_grid, random_search, sample_trials
from churnlab.plans.train import assembler, fit_model, fit_together, plan_fit, with_probability


def sample(n=400, seed=0, missing=True):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 2, n), rng.integers(-5, 5, n) / 4, rng.integers(0, 30, n)]).astype(float)
    y = (x[:, 0] + 3 * x[:, 1] - 2 * x[:, 2] + rng.normal(0, 3, n) > 7).astype(int)
    if missing:
        x[rng.random(n) < 0.15, 0] = np.nan
        x[(rng.random(n) < 0.5) & (y == 1), 2] = np.nan
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(*[None if np.isnan(v) else float(v) for v in r], int(t), i) for i, (r, t) in enumerate(zip(x, y))]
    names = [f"c{i}" for i in range(x.shape[1])]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", y int, id long").repartition(parts, "id"), names


def brute_margins(x, y, p, rounds):
    """Every split of every node tried on the raw values."""
    margin = np.zeros(len(y))
    w = np.where(y > 0, p.pos_weight, 1.0)
    cut = lambda g: np.sign(g) * max(abs(g) - p.reg_alpha, 0)
    score = lambda g, h: cut(g) ** 2 / (h + p.reg_lambda)

    def grow(rows, depth, g, h, out):
        total = score(g[rows].sum(), h[rows].sum())
        best = None
        if depth < p.max_depth:
            for c in range(x.shape[1]):
                v = x[rows, c]
                for at in [*np.unique(x[~np.isnan(x[:, c]), c])[1:], np.inf]:
                    for missing_left in (False, True):
                        left = np.where(np.isnan(v), missing_left, v < at)
                        a, b = rows[left], rows[~left]
                        if min(h[a].sum(), h[b].sum()) < max(p.min_child_weight, 1e-12) or not len(a) or not len(b):
                            continue
                        gain = round(score(g[a].sum(), h[a].sum()) + score(g[b].sum(), h[b].sum()) - total, 9)
                        if gain > 1e-6 and gain >= p.gamma and (best is None or gain > best[0]):
                            best = (gain, a, b)
        if best is None:
            out[rows] = -p.learning_rate * cut(g[rows].sum()) / (h[rows].sum() + p.reg_lambda)
        else:
            grow(best[1], depth + 1, g, h, out)
            grow(best[2], depth + 1, g, h, out)

    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        grow(np.arange(len(y)), 0, w * (q - y), w * q * (1 - q), step)
        margin += step
    return margin


def fitted(spark, x, y, fits, **options):
    df, names = frame(spark, x, y)
    found = fit_boosted(df, F.array(*names), len(names), F.col("y"), F.lit(1.0), fits, **options)
    return [Forest(*f) for f in found]


@pytest.mark.parametrize("change", [{}, {"reg_lambda": 7.5}, {"gamma": 4.0}, {"min_child_weight": 20.0}, {"reg_alpha": 3.0},
                                    {"pos_weight": 3.0}, {"max_depth": 5, "reg_lambda": 0.0}])
def test_splits_and_weights_equal_brute_force(spark, change):
    x, y = sample()
    p = dataclasses.replace(BoostParams(n_estimators=4, max_depth=3, learning_rate=0.3), **change)
    got = fitted(spark, x, y, [p])[0].margins(x)
    assert np.allclose(got, brute_margins(x, y, p, 4), atol=1e-8)


def test_fits_in_one_scan_equal_single_fits_and_keys_matter(spark, monkeypatch):
    monkeypatch.setattr(boosting, "CHECKPOINT_TREES", 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    x, y = sample(seed=3)
    base = BoostParams(n_estimators=5, max_depth=3, seed=4, subsample=0.7, colsample_bytree=0.5)
    changes = [{}, {"n_estimators": 3}, {"max_depth": 2}, {"learning_rate": 0.1}, {"subsample": 0.9}, {"colsample_bytree": 1.0},
               {"reg_lambda": 5.0}, {"gamma": 3.0}, {"min_child_weight": 15.0}]
    fits = [dataclasses.replace(base, **c) for c in changes]
    margins = [f.margins(x) for f in fitted(spark, x, y, fits)]
    assert all(not np.allclose(margins[0], m) for m in margins[1:])
    for i in (0, 1, 5):
        assert np.allclose(fitted(spark, x, y, [fits[i]])[0].margins(x), margins[i], atol=1e-12)
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 1)  # a pass per node
    assert np.allclose(fitted(spark, x, y, [fits[2]])[0].margins(x), margins[2], atol=1e-12)


def test_fits_grown_apart_equal_those_of_the_passes(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    summed, passes = boosting._summed, []
    monkeypatch.setattr(boosting, "_summed", lambda parts: passes.append(1) or summed(parts))
    x, y = sample(seed=12)
    fits = [BoostParams(n_estimators=2, max_depth=2), BoostParams(n_estimators=0),
            BoostParams(n_estimators=5, max_depth=4, subsample=0.7, colsample_bytree=0.5, seed=4, gamma=0.5)]
    apart = [f.margins(x) for f in fitted(spark, x, y, fits)]
    assert not passes  # a few rows are not worth a job per level of a tree
    monkeypatch.setattr(boosting, "TASK_CELLS", 0, raising=False)
    monkeypatch.setattr(boosting, "CHECKPOINT_TREES", 2)
    assert np.allclose(apart, [f.margins(x) for f in fitted(spark, x, y, fits)], atol=1e-12) and len(passes) == 5 * 4
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 1)  # a pass per node
    assert np.allclose(apart, [f.margins(x) for f in fitted(spark, x, y, fits)], atol=1e-12)


def test_a_forest_deals_few_rows_to_few_tasks(spark, monkeypatch):
    x, y = sample(n=200, seed=13, missing=False)
    df, names = frame(spark, x, y, parts=9)
    fit, seen = Pipeline.fit, []
    monkeypatch.setattr(Pipeline, "fit", lambda self, data: seen.append(data.rdd.getNumPartitions()) or fit(self, data))
    fit_model("rf", df, names, "y", "balanced", 42, {"n_estimators": 2})
    fit_model("logreg", df, names, "y", "balanced", 42, {})
    assert seen == [1, 9]


def test_wide_columns_are_cut_at_quantiles_and_odd_tables_work(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=2000), np.ones(2000), np.full(2000, np.nan)])
    y = (x[:, 0] > 0.3).astype(int)
    model = fitted(spark, x, y, [BoostParams(n_estimators=20, max_depth=2, learning_rate=0.5)], max_bins=32)[0]
    assert ((model.margins(x) > 0) == (y > 0)).mean() > 0.97
    same = fitted(spark, x[:50], np.zeros(50, int), [BoostParams(n_estimators=3)])[0].margins(x[:50])
    assert np.allclose(same, same[0]) and same[0] < 0
    assert fitted(spark, x[:50], y[:50], [BoostParams(n_estimators=0)])[0].margins(x[:5]).tolist() == [0] * 5


def test_boosted_stage_in_a_pipeline(spark, tmp_dir):
    x, y = sample(seed=5)
    df, names = frame(spark, x, y)
    model, logged = fit_model("xgboost", df, names, "y", "balanced", 42, {"n_estimators": 10, "max_depth": 3, "reg_lambda": 2})
    pos = int(y.sum())
    assert logged["scale_pos_weight"] == (len(y) - pos) / pos and logged["reg_lambda"] == 2
    scored = with_probability(model.transform(df)).select("id", "p1", "prediction", "y").orderBy("id").collect()
    assert all((r.p1 > 0.5) == (r.prediction == 1) for r in scored)
    assert np.mean([r.prediction == r.y for r in scored]) > 0.75
    path = os.path.join(tmp_dir, "boosted")
    model.write().overwrite().save(path)
    again = with_probability(PipelineModel.load(path).transform(df)).select("id", "p1", "prediction", "y").orderBy("id").collect()
    assert again == scored
    with pytest.raises(ValueError, match="no rows"):
        boosted.fit_many(assembler(names, "xgboost").transform(df.limit(0)), [BoostParams()], "features", "y")


def dense_optimum(x, y, c, penalise, weights=(1.0, 1.0), rounds=60):
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.ones(x.shape[1])
    penalty[-1] = float(penalise)
    weight, w = np.where(y > 0, weights[1], weights[0]), np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(c * (x.T * (weight * q * (1 - q))) @ x + np.diag(penalty), c * x.T @ (weight * (q - y)) + penalty * w)
    return w


def test_logistic_fits_in_one_scan_reach_the_optimum(spark):
    x, y = sample(seed=6, missing=False)
    df, names = frame(spark, x, y)
    fits = [LogisticParams(C=c, penalise_intercept=pen, class_weights=cw)
            for c in (0.01, 1.0, 10.0) for pen in (False, True) for cw in ((1.0, 1.0), (0.6, 2.5))]
    got = fit_logistic(df, F.array(*names), len(names), F.col("y"), fits)
    for p, w in zip(fits, got):
        assert np.allclose(w, dense_optimum(x, y, p.C, p.penalise_intercept, p.class_weights), atol=1e-6)
    single = fit_logistic(df, F.array(*names), len(names), F.col("y"), fits[3:4])[0]
    assert np.allclose(single, got[3], atol=1e-8)


def test_solvers_of_the_logistic_family(spark, tmp_dir):
    x, y = sample(seed=8, missing=False)
    df, names = frame(spark, x, y)
    lbfgs, _ = fit_model("logreg", df, names, "y", None, 42, {"C": 0.1, "tol": 1e-12})
    spark_model = lbfgs.stages[-1]
    assert isinstance(spark_model, LogisticRegressionModel)
    assert np.allclose(spark_model.coefficients.toArray(), dense_optimum(x, y, 0.1, False)[:-1], atol=1e-4)
    liblinear, logged = fit_model("logreg", df, names, "y", "balanced", 42, {"C": 0.1, "solver": "liblinear"})
    assert logged["solver"] == "liblinear" and "ignored" not in logged
    n = np.bincount(y)
    balanced = tuple(len(y) / (2 * n))
    want = dense_optimum(x, y, 0.1, True, balanced)
    stage = liblinear.stages[-1]
    assert np.allclose([*stage.getOrDefault("coefficients"), stage.getOrDefault("intercept")], want, atol=1e-6)
    path = os.path.join(tmp_dir, "linear")
    liblinear.write().overwrite().save(path)
    p = [r.p1 for r in with_probability(PipelineModel.load(path).transform(df)).orderBy("id").select("p1").collect()]
    assert np.allclose(p, 1 / (1 + np.exp(-(np.hstack([x, np.ones((len(x), 1))]) @ want))), atol=1e-6)
    with pytest.raises(ValueError, match="solver"):
        fit_model("logreg", df, names, "y", None, 42, {"solver": "newton"})


def test_families_fitted_together_equal_single_fits(spark):
    x, y = sample(seed=9, missing=False)
    df, names = frame(spark, x, y)
    counts = {0: int((y == 0).sum()), 1: int(y.sum())}
    for name, points in (("xgboost", [{"n_estimators": 3}, {"n_estimators": 4, "max_bins": 8}, {"n_estimators": 2, "max_depth": 1}]),
                         ("logreg", [{"C": 0.1}, {"C": 0.1, "solver": "liblinear"}])):
        plans = [plan_fit(name, counts, "balanced", 1, p) for p in points]
        for point, model in zip(points, fit_together(name, df, names, "y", plans)):
            single, _ = fit_model(name, df, names, "y", "balanced", 1, point, class_counts=counts)
            both = [np.array([r.p1 for r in with_probability(m.transform(df)).orderBy("id").select("p1").collect()])
                    for m in (model, single)]
            assert np.allclose(*both, atol=1e-4)


def test_production_grid_has_68_trials():
    trials = sample_trials(param_grid(PROD_SPACE), 30, 42)
    assert {m: len(t) for m, t in trials.items()} == {"logreg": 8, "rf": 30, "xgboost": 30}


def test_search_in_shared_passes(spark):
    x, y = sample(n=300, seed=10, missing=False)
    df, names = frame(spark, x, y)
    rows = df.withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    space = {"use_smote": ["false", "true"], "logreg": {"C": [0.1, 1.0], "solver": ["lbfgs", "liblinear"]},
             "rf": {"n_estimators": [5], "max_depth": [2, 3]}, "xgboost": {"n_estimators": [2, 5], "max_depth": [2], "gamma": [0, 50.0]}}
    runs = random_search(spark, rows, names, "y", SearchConfig(space=space, max_trials=30, max_concurrent=3), id_col="id").collect()
    trials = [r for r in runs if r.run_type == "trial"]
    assert len(trials) == 8 + 4 + 8 and len({r.run_id for r in trials}) == 20
    boosted_scores = {(r.params["xgboost_gamma"], r.params["xgboost_n_estimators"], r.params["use_smote"]): r.metrics["roc_auc"]
                      for r in trials if r.model == "xgboost"}
    assert len(set(boosted_scores.values())) > 2


def test_trials_scored_out_of_fold_read_no_test_row(spark):
    x, y = sample(n=300, seed=11, missing=False)
    df, names = frame(spark, x, y)
    rows = df.withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    # any use of a test row would fail the assembler
    rows = rows.withColumn("c0", F.when(F.col("split") == "train", F.col("c0")))
    space = {"use_smote": ["true"], "logreg": {"C": [0.1, 1.0]}, "xgboost": {"n_estimators": [5], "max_depth": [2]}}
    runs = random_search(spark, rows, names, "y", SearchConfig(space=space, folds=3), id_col="id").collect()
    trials = [r for r in runs if r.run_type == "trial"]
    assert len(trials) == 3 and {r.tags["scored_rows"] for r in trials} == {"225"}
    # the same score by hand, for one trial
    train = rows.where("split = 'train'").drop("split").withColumn("fold", fold_of("id", 42, 3))
    parts = []
    for f in range(3):
        fit = imb.smote(train.where(F.col("fold") != f).drop("fold"), "id", "y", names, seed=42)
        model, _ = fit_model("logreg", fit.select(*names, "y"), names, "y", None, 42, {"C": 1.0})
        parts.append(with_probability(model.transform(train.where(F.col("fold") == f))).select("y", "prediction", "p1"))
    by_hand = evaluate(parts[0].unionByName(parts[1]).unionByName(parts[2]), "y", "prediction", "p1")
    got = next(r.metrics for r in trials if r.model == "logreg" and r.params["logreg_C"] == "1.0")
    assert abs(got["roc_auc"] - by_hand["roc_auc"]) < 5e-3
