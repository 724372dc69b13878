"""Hyper-parameter search as Spark jobs: grid, seeded sampling, concurrent trials, best trial, export.

The search space is configuration (a few lists), so the grid is expanded on
the driver. All boosted trials of a training set grow over the same blocks, in
shared passes or, where the blocks are few, in a task each; all logistic ones
share passes; so do all forests, whose trees are dealt to tasks and scored
there. Only forests whose bins no task may hold are fits of their own,
``max_concurrent`` at a time from a thread pool (Spark schedules their jobs side
by side).
"""

from __future__ import annotations

import hashlib
import itertools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions.hashing import seeded_hash
from churnlab.functions.scalars import (
    MODEL_PREFIXES,
    TRAINING_LEVEL_KEYS,
    coerce_value,
    parse_bool_value,
    strip_param_prefix,
)
from churnlab.operators import imbalance as imb
from churnlab.operators.boosting import TASK_FITS, fits_a_task
from churnlab.operators.metrics import evaluate_each, score_counts
from churnlab.operators.select import select_best
from churnlab.plans.train import fit_model, fit_together, plan_fit, score_forests, with_probability
from churnlab.session import checkpoint, scratch_path
from churnlab.sources.runs import RUNS_SCHEMA, run_id_of, run_row

# Fixed search spaces (values as in the reference's hpo config: production and quick-validation blocks).
PROD_SPACE = {
    "model_types": ["logreg", "rf", "xgboost"],
    "use_smote": ["true"],
    "logreg": {"C": [0.01, 0.1, 1.0, 10.0], "solver": ["lbfgs", "liblinear"]},
    "rf": {"n_estimators": [100, 200, 300], "max_depth": [4, 6, 8, 10, 100], "min_samples_split": [2, 5, 10],
           "min_samples_leaf": [1, 2, 4], "max_features": ["sqrt"]},
    "xgboost": {"n_estimators": [100, 200, 300], "max_depth": [3, 4, 5, 6], "learning_rate": [0.01, 0.05, 0.1],
                "subsample": [0.6, 0.8, 1.0], "colsample_bytree": [0.6, 0.8, 1.0]},
}
TEST_SPACE = {
    "model_types": ["logreg", "rf", "xgboost"],
    "use_smote": ["true"],
    "logreg": {"C": [0.1, 1.0, 10.0], "solver": ["lbfgs", "liblinear"]},
    "rf": {"n_estimators": [100, 200], "max_depth": [4, 6], "min_samples_split": [2, 5], "min_samples_leaf": [1, 2],
           "max_features": ["sqrt"]},
    "xgboost": {"n_estimators": [50, 100], "max_depth": [3, 4], "learning_rate": [0.05, 0.1], "subsample": [0.8, 1.0],
                "colsample_bytree": [0.6, 0.8]},
}
NO_ROWS = {"accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1": 0.0, "roc_auc": 0.5}  # of a trial without a row to score


@dataclass
class SearchConfig:
    space: dict = field(default_factory=lambda: PROD_SPACE)
    metric: str = "f1"
    mode: str = "max"
    max_trials: int = 30
    max_concurrent: int = 4
    seed: int = 42
    experiment: str = "hpo"
    sweep_name: str = "hpo"
    class_weight: str | None = "balanced"
    random_state: int = 42
    folds: int = 0  # two or more: trials are scored out of fold and never see a test row


def _clean(values) -> list:
    """Drop null / 'none' / 'null' / '' entries (recursively for nested lists)."""
    out = []
    for v in values or []:
        if v is None or str(v).strip().lower() in ("none", "null", ""):
            continue
        out.append(_clean(v) if isinstance(v, list) else v)
    return out


def model_types(space: dict) -> list[str]:
    """The models to search: the listed ones, or those that the space has a block for."""
    return list(space.get("model_types") or sorted(space.keys() & set(MODEL_PREFIXES), key=MODEL_PREFIXES.index))


def param_grid(space: dict) -> dict[str, list[dict]]:
    """Per model, the cartesian product of its value lists plus training-level lists (prefixed keys)."""
    grids = {}
    for m in model_types(space):
        mspace = space.get(m)
        if not mspace:
            continue
        axes = []
        for k in TRAINING_LEVEL_KEYS:
            if isinstance(space.get(k), list):
                vals = _clean(space[k])
                if vals:
                    axes.append((k, vals))
        for p, vals in mspace.items():
            vals = _clean(vals)
            if vals:
                axes.append((f"{m}_{p}", vals))
        names = [a[0] for a in axes]
        grids[m] = [dict(zip(names, combo)) for combo in itertools.product(*[a[1] for a in axes])]
    return grids


def _draw_key(seed: int, model: str, point: dict) -> str:
    text = f"{seed}|{model}|" + "|".join(f"{k}={point[k]}" for k in sorted(point))
    return hashlib.md5(text.encode()).hexdigest()


def sample_trials(grids: dict[str, list[dict]], max_trials: int, seed: int = 42) -> dict[str, list[dict]]:
    """Random sampling without replacement: order each grid by md5(seed|model|point), keep max_trials."""
    return {m: sorted(g, key=lambda p: _draw_key(seed, m, p))[:max_trials] for m, g in grids.items()}


def trial_hyperparams(model: str, point: dict) -> tuple[dict, dict]:
    """Prefixed sweep keys -> (training-level settings, the model's own hyper-parameters)."""
    training, hp = {}, {}
    for k, v in point.items():
        if v is None or str(v).strip().lower() == "none":
            continue
        if k in TRAINING_LEVEL_KEYS:
            training[k] = v
        elif k.startswith(f"{model}_"):
            hp[k[len(model) + 1:]] = coerce_value(str(v)) if isinstance(v, str) else v
    return training, hp


def fold_of(id_col: str, seed: int, folds: int) -> Column:
    """The fold of a row, 0 to ``folds`` - 1, from its id alone."""
    return F.pmod(F.conv(F.substring(seeded_hash(seed, "fold", F.col(id_col)), 1, 8), 16, 10).cast("long"), F.lit(folds))


def _settings(job: tuple, config: SearchConfig) -> tuple:
    """(hyper-parameters, use SMOTE, seed, class weighting) of a trial."""
    m, _, _, point = job
    tr, hp = trial_hyperparams(m, point)
    use_smote = parse_bool_value(tr.get("use_smote"), default=False)
    cw = None if use_smote else tr.get("class_weight", config.class_weight)
    return hp, use_smote, int(tr.get("random_state", config.random_state)), cw


def _fit_trials(jobs: list[tuple], train: DataFrame, held: DataFrame, feature_names: list[str], target: str, config: SearchConfig,
                int_features, id_col: str) -> tuple[dict[int, PipelineModel], list[DataFrame]]:
    """(a model per trial, stored score counts of the ``held`` rows by trials without a model): each family's trials together
    over each training set. Forests have scores and no model, but where a task may not hold their bins they are Spark's own."""
    sets: dict[tuple, tuple] = {}
    parts: dict[tuple, list[int]] = {}
    for i, job in enumerate(jobs):
        _, use_smote, seed, _ = _settings(job, config)
        # SMOTE sets are built on the driver thread first, so that concurrent trials share them
        if (use_smote, seed) not in sets:
            rows = train
            if use_smote:
                rows = imb.smote(train, id_col, target, feature_names, int_features=int_features, seed=seed)
            stored = rows.select(*feature_names, target).persist(StorageLevel.MEMORY_AND_DISK)
            sets[(use_smote, seed)] = (stored, imb.class_count_map(stored, target))
        # forests are dealt to tasks by trees
        alone = job[0] == "rf" and not fits_a_task(sum(sets[(use_smote, seed)][1].values()), len(feature_names), TASK_FITS)
        parts.setdefault((job[0], use_smote, seed, i if alone else None), []).append(i)

    def fit(key: tuple) -> list[PipelineModel] | DataFrame:
        part = parts[key]
        m, (_, use_smote, seed, _) = jobs[part[0]][0], _settings(jobs[part[0]], config)
        data, counts = sets[(use_smote, seed)]
        plans = [(hp, cw, seed) for hp, _, seed, cw in (_settings(jobs[i], config) for i in part)]
        if m == "rf" and key[-1] is None:
            scored = score_forests(data, held, feature_names, target, {
                i: plan_fit(m, counts, cw, seed, hp) for i, (hp, cw, seed) in zip(part, plans)})
            return checkpoint(score_counts(scored.withColumnRenamed("fit", "trial"), "label", "p1", "prediction", "trial"))
        if m == "rf":
            return [fit_model(m, data, feature_names, target, cw, seed, hp, class_counts=counts)[0] for hp, cw, seed in plans]
        return fit_together(m, data, feature_names, target, [plan_fit(m, counts, cw, seed, hp) for hp, cw, seed in plans])

    models: dict[int, PipelineModel] = {}
    counted = []
    try:
        with ThreadPoolExecutor(max_workers=max(1, config.max_concurrent)) as pool:
            # the shared passes are the longest, so they start first
            ordered = sorted(parts, key=lambda key: key[0] == "rf")
            for key, fitted in zip(ordered, pool.map(fit, ordered)):
                if isinstance(fitted, DataFrame):
                    counted.append(fitted)
                else:
                    models.update(zip(parts[key], fitted))
    finally:
        for rows, _ in sets.values():
            rows.unpersist()
    return models, counted


def random_search(spark: SparkSession, prepared: DataFrame, feature_names: list[str], target: str,
                  config: SearchConfig, int_features=(), id_col: str = "customer_id") -> DataFrame:
    """Fit and score each sampled trial; returns the trials as ``runs`` rows (params keep sweep keys).

    With ``config.folds`` of two or more, a trial is scored out of fold: each
    fold of the train rows by a model of the other folds (oversampled on their
    own), all folds in one evaluation, and the test rows are not read. Otherwise
    the trials are scored on the test rows, as the reference does. The tag
    ``scored_rows`` says on how many rows.
    """
    trials = sample_trials(param_grid(config.space), config.max_trials, config.seed)
    train = prepared.where(F.col("split") == "train").drop("split")
    jobs = []
    for m, points in trials.items():
        parent = run_id_of(config.experiment, config.sweep_name, m, config.seed)
        for i, point in enumerate(points):
            jobs.append((m, parent, i, point))
    if config.folds > 1:
        folded = train.withColumn("_fold", fold_of(id_col, config.seed, config.folds)).persist(StorageLevel.MEMORY_AND_DISK)
        parts = [(folded.where(F.col("_fold") != f).drop("_fold"), folded.where(F.col("_fold") == f)) for f in range(config.folds)]
        kept = [folded]
    else:
        test = prepared.where(F.col("split") == "test").select(id_col, *feature_names, target).persist(StorageLevel.MEMORY_AND_DISK)
        parts, kept = [(train, test)], [test]

    scores = scratch_path(spark, "trial-scores")

    def score(i: int) -> None:
        """A trial's scores, counted, into a folder of its own."""
        scored = [with_probability(models[i].transform(held)).select(target, "prediction", "p1") for models, _, held in fitted if i in models]
        score_counts(reduce(DataFrame.unionByName, scored), target, "p1", "prediction").write.parquet(f"{scores}/trial={i}")

    def record(i: int):
        m, parent, nth, point = jobs[i]
        return run_row(run_id=run_id_of(parent, nth, sorted(point.items())), parent_run_id=parent, experiment=config.experiment,
                       run_name=f"{config.sweep_name}-{m}", run_type="trial", model=m, params={k: v for k, v in point.items()},
                       metrics=measured.get(i, NO_ROWS), tags={"trial": str(nth), "scored_rows": str(n_scored)})

    try:
        fitted = [(*_fit_trials(jobs, rows, held, feature_names, target, config, int_features, id_col), held) for rows, held in parts]
        modelled = sorted({i for models, _, _ in fitted for i in models})
        n_scored = kept[0].count()
        with ThreadPoolExecutor(max_workers=max(1, config.max_concurrent)) as pool:
            list(pool.map(score, modelled))
    finally:
        for df in kept:
            df.unpersist()
    # all trials are measured by the same few jobs
    counted = [df for _, stored, _ in fitted for df in stored]
    if modelled:
        counted.append(spark.read.schema("_s double, prediction int, _pos long, _neg long, trial int").parquet(scores))
    measured = evaluate_each(reduce(DataFrame.unionByName, counted), "trial", "prediction") if counted else {}
    rows = [record(i) for i in range(len(jobs))]
    # One sweep (parent) row per model, carrying its best score like the scheduler's sweep job.
    sweeps = []
    for m, parent in dict((j[0], j[1]) for j in jobs).items():
        scores = [r[7].get(config.metric) for r in rows if r[1] == parent and r[7].get(config.metric) is not None]
        best = (max(scores) if config.mode == "max" else min(scores)) if scores else None
        sweeps.append(run_row(run_id=parent, parent_run_id=None, experiment=config.experiment,
                              run_name=f"{config.sweep_name}-{m}", run_type="sweep", model=m,
                              metrics={"score": best} if best is not None else {},
                              tags={"primary_metric": config.metric, "mode": config.mode}))
    return spark.createDataFrame(sweeps + rows, RUNS_SCHEMA)


def best_trials(trials: DataFrame, metric: str = "f1", mode: str = "max") -> DataFrame:
    """Best trial of each sweep (parent run): null scores skipped, the first ordinal wins ties."""
    scored = trials.where(F.col("run_type") == "trial").withColumns({
        "score": F.col("metrics")[metric], "ordinal": F.col("tags")["trial"].cast("long")})
    return select_best(scored, "score", mode, "ordinal", ["parent_run_id"])


def best_trial(trials: DataFrame, metric: str = "f1", mode: str = "max") -> DataFrame:
    """The best of the sweeps' best trials; among equals the first model of MODEL_PREFIXES, then the first ordinal and id."""
    order = F.array_position(F.array(*[F.lit(m) for m in MODEL_PREFIXES]), F.col("model"))
    # one row per sweep; the struct orders what select_best orders by its order column
    sweeps = best_trials(trials, metric, mode).withColumn("_order", F.struct(order, "ordinal", "run_id"))
    return select_best(sweeps, "score", mode, "_order").drop("_order")


def export_best(best: DataFrame, config: DataFrame) -> DataFrame:
    """The training config (section, key, value) with the winner laid over it.

    ``models`` becomes the winner, its training-level keys and hyper-parameters
    replace those of the config, all other keys of the config stay.
    """
    s = best.select("model", strip_param_prefix(F.col("params"), F.col("model")).alias("cfg"))
    models = s.select(F.lit("training").alias("section"), F.lit("models").alias("key"),
                      F.concat(F.lit("["), F.col("model"), F.lit("]")).alias("value"))
    training = s.select(F.lit("training").alias("section"), F.explode("cfg.training").alias("key", "value"))
    hp = s.select(F.concat(F.lit("hyperparameters."), F.col("model")).alias("section"),
                  F.explode("cfg.hyperparameters").alias("key", "value"))
    winner = models.unionByName(training).unionByName(hp)
    return winner.unionByName(config.join(winner, ["section", "key"], "left_anti").select("section", "key", "value"))


def training_config(spark: SparkSession, training: dict, hyperparameters: dict) -> DataFrame:
    """A training config as rows (section, key, value)."""
    text = lambda v: "[" + ",".join(v) + "]" if isinstance(v, list) else None if v is None else str(v)
    rows = [("training", k, text(v)) for k, v in training.items()]
    rows += [(f"hyperparameters.{m}", k, text(v)) for m, ps in hyperparameters.items() for k, v in ps.items()]
    return spark.createDataFrame(rows, "section string, key string, value string")


def config_table(spark: SparkSession, hyperparameters: dict) -> DataFrame:
    """Training config hyper-parameters as rows (model, param, value) -- a handful of rows."""
    rows = [(m, k, None if v is None else str(v)) for m, ps in (hyperparameters or {}).items() for k, v in ps.items()]
    return spark.createDataFrame(rows, "model string, param string, value string")


def merge_overrides(base: DataFrame, overrides: DataFrame) -> DataFrame:
    """Effective hyper-parameters per run: the last override of a key wins, merged over the base config.

    ``base``: (model, param, value); ``overrides``: (run_id, ordinal, model, param, value).
    Returns (run_id, model, param, value, source) with source 'override' or 'base'.
    """
    last = overrides.groupBy("run_id", "model", "param").agg(F.max_by("value", "ordinal").alias("_ov"))
    runs = overrides.select("run_id", "model").distinct()
    base_per_run = runs.join(base.withColumnRenamed("value", "_bv"), "model")
    merged = base_per_run.join(last, ["run_id", "model", "param"], "full_outer")
    return merged.select("run_id", "model", "param", F.coalesce("_ov", "_bv").alias("value"),
                         F.when(F.col("_ov").isNotNull(), "override").otherwise("base").alias("source"))
