"""Training job: load prepared data once, optional SMOTE, fit each family, evaluate, keep the best."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions.scalars import parse_bool_value
from churnlab.operators import imbalance as imb
from churnlab.operators.forest import forest_scores
from churnlab.operators.metrics import evaluate
from churnlab.plans import boosted, linear
from churnlab.plans.models import MAX_BINS, ModelSpec, apply_hyperparameters, get_model, without_effect
from churnlab.sources.runs import log_runs, run_id_of, run_row

FEATURES_COL = "features"
WEIGHT_COL = "weight"
FOREST_ROWS = 16_384  # rows of a forest's task


@dataclass
class TrainConfig:
    models: list[str] = field(default_factory=lambda: ["logreg", "rf", "xgboost"])
    class_weight: str | None = "balanced"
    random_state: int = 42
    use_smote: object = False
    hyperparameters: dict = field(default_factory=dict)
    experiment: str = "train"
    run_name: str = "train-run"
    smote_k: int = 5


@dataclass
class ModelResult:
    name: str
    run_id: str
    model: PipelineModel
    metrics: dict
    params: dict


@dataclass
class TrainResult:
    parent_run_id: str
    results: dict
    best: str
    runs: DataFrame

    @property
    def best_model(self) -> PipelineModel:
        return self.results[self.best].model


def assembler(feature_names: list[str], model: str = "logreg") -> VectorAssembler:
    """Boosted trees take missing values as they are; for the other families a null is an error."""
    return VectorAssembler(inputCols=feature_names, outputCol=FEATURES_COL,
                           handleInvalid="keep" if model == "xgboost" else "error")


def with_probability(pred: DataFrame) -> DataFrame:
    """P(class 1) as a double column next to the int label."""
    return pred.withColumn("p1", vector_to_array("probability")[1]).withColumn(
        "prediction", F.col("prediction").cast("int"))


def plan_fit(name: str, counts: dict, class_weight, random_state: int,
             hyperparams: dict | None) -> tuple[ModelSpec, dict | None, dict]:
    """(spec, weight per class or None, what the run logs) of one fit on rows with these class counts.

    Every weighting rule needs only the rows per class, so no extra pass over
    the training set computes weights or their sum. Boosted trees carry their
    positive weight as a parameter.
    """
    spec, applied = apply_hyperparameters(get_model(name, class_weight=class_weight, random_state=random_state), hyperparams)
    logged = {**applied, **without_effect(spec, hyperparams)}
    if name != "xgboost":
        return spec, imb.balanced_weight_map(counts) if spec.class_weight == "balanced" else None, logged
    weights = imb.pos_weight_from_counts(counts, current=spec.params.get("scale_pos_weight"), tuned=applied,
                                         class_weight=spec.class_weight)
    if weights:
        spec.params["scale_pos_weight"] = logged["scale_pos_weight"] = weights[1]
    return spec, None, logged


def fit_model(name: str, train: DataFrame, feature_names: list[str], target: str, class_weight, random_state: int,
              hyperparams: dict | None, class_counts: dict | None = None) -> tuple[PipelineModel, dict]:
    """Fit one family (assembler + estimator) with its weighting rule; return (model, logged params)."""
    counts = class_counts if class_counts is not None else imb.class_count_map(train, target)
    spec, weights, logged = plan_fit(name, counts, class_weight, random_state, hyperparams)
    data = imb.with_weight_column(train, target, weights, WEIGHT_COL) if weights else train
    if name == "rf":  # every task sends the sums of all nodes of a level, so a few rows are not dealt to many tasks
        data = data.coalesce(max(1, -(-sum(counts.values()) // FOREST_ROWS)))
    total = sum(n * (weights.get(c, 1.0) if weights else 1.0) for c, n in counts.items())
    est = spec.estimator(FEATURES_COL, target, WEIGHT_COL if weights else None, float(total) or 1.0, weights)
    return _without_summary(Pipeline(stages=[assembler(feature_names, name), est]).fit(data)), logged


def _without_summary(model: PipelineModel) -> PipelineModel:
    """The model as one that was saved and loaded: Spark's training summary holds the session, which tasks would be sent
    with the model and which cannot be sent once anything in it was observed."""
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.active().sparkContext._jvm.scala.Option.empty())
    return model


def fit_together(name: str, train: DataFrame, feature_names: list[str], target: str, plans: list[tuple]) -> list[PipelineModel]:
    """One model per plan of ``plan_fit``, all fitted in the same passes over ``train`` (families ``logreg`` and ``xgboost``)."""
    front = assembler(feature_names, name)
    data = front.transform(train).select(FEATURES_COL, target)
    if name == "logreg":
        models = linear.fit_many(data, [spec.logistic_params(weights) for spec, weights, _ in plans], FEATURES_COL, target)
        return [PipelineModel(stages=[front, m]) for m in models]
    out: list = [None] * len(plans)
    bins = [int(spec.params.get("max_bins") or MAX_BINS) for spec, _, _ in plans]
    for size in sorted(set(bins)):  # fits share their blocks only where they share their bins
        these = [i for i, b in enumerate(bins) if b == size]
        models = boosted.fit_many(data, [plans[i][0].boost_params() for i in these], FEATURES_COL, target, size)
        for i, m in zip(these, models):
            out[i] = PipelineModel(stages=[front, m])
    return out


def score_forests(train: DataFrame, held: DataFrame, feature_names: list[str], target: str, plans: dict[int, tuple]) -> DataFrame:
    """(fit, label, p1, prediction) of the ``held`` rows by a forest per plan of ``plan_fit``; the forests themselves are not kept."""
    front = assembler(feature_names, "rf")
    rows, asked = (front.transform(df).select(FEATURES_COL, target) for df in (train, held))
    by_bins: dict[int, dict] = {}
    for fit, (spec, weights, _) in plans.items():
        by_bins.setdefault(spec.forest_settings()["maxBins"], {})[fit] = spec.forest_params(len(feature_names), weights)
    return reduce(DataFrame.unionByName, [
        forest_scores(rows, asked, vector_to_array(FEATURES_COL), len(feature_names), F.col(target), fits, size)
        for size, fits in by_bins.items()])


def effective_class_weight(class_weight: str | None, use_smote) -> str | None:
    """SMOTE balances the classes, so it switches class weighting off (the reference's rule)."""
    return None if parse_bool_value(use_smote, default=False) else class_weight


def applied_weights(train: DataFrame, target: str, class_weight: str | None, use_smote,
                    model: str = "logreg") -> DataFrame:
    """(label, n_c, weight): the rows per class a fit sees and the weight each class gets."""
    cw = effective_class_weight(class_weight, use_smote)
    counts = imb.class_count_map(train, target)
    if model in ("logreg", "rf") and cw == "balanced":
        w = imb.balanced_weight_map(counts)
    elif model == "xgboost":
        w = imb.pos_weight_from_counts(counts, class_weight=cw) or {}
    else:
        w = {}
    return train.sparkSession.createDataFrame([(int(c), int(n), float(w.get(c, 1.0))) for c, n in sorted(counts.items())],
                                              "label int, n_c bigint, weight double")


def train_stage(spark: SparkSession, prepared: DataFrame, feature_names: list[str], target: str,
                config: TrainConfig, int_features=(), id_col: str = "customer_id",
                runs_path: str | None = None, model_path: str | None = None) -> TrainResult:
    """The whole stage: balance, fit and test each family, log the runs, keep the best model (F1, first wins ties).

    Any failure aborts. ``runs_path`` appends the run records, ``model_path``
    saves the best model.
    """
    if not config.models:
        raise ValueError("no model to train")
    train, test = _training_sets(prepared, feature_names, target, config, int_features, id_col)
    parent = run_id_of(config.experiment, config.run_name, config.random_state, tuple(config.models))
    try:
        counts = imb.class_count_map(train, target)  # once for every family's weighting rule
        results = {name: _fit_and_test(name, train, test, feature_names, target, config, counts, parent)
                   for name in config.models}
    finally:
        train.unpersist()
        test.unpersist()
    best = select_best_name(results)
    runs = log_runs(spark, _run_rows(results, best, parent, config), runs_path)
    if model_path:
        save_model(results[best].model, model_path)
    return TrainResult(parent, results, best, runs)


def _training_sets(prepared: DataFrame, feature_names: list[str], target: str, config: TrainConfig, int_features,
                   id_col: str) -> tuple[DataFrame, DataFrame]:
    train = prepared.where(F.col("split") == "train").drop("split")
    if parse_bool_value(config.use_smote, default=False):
        train = imb.smote(train, id_col, target, feature_names, int_features=int_features, k=config.smote_k,
                          seed=config.random_state)
    test = prepared.where(F.col("split") == "test").select(id_col, *feature_names, target)
    return (train.select(*feature_names, target).persist(StorageLevel.MEMORY_AND_DISK),
            test.persist(StorageLevel.MEMORY_AND_DISK))


def _fit_and_test(name: str, train: DataFrame, test: DataFrame, feature_names: list[str], target: str,
                  config: TrainConfig, counts: dict, parent: str) -> ModelResult:
    weighting = effective_class_weight(config.class_weight, config.use_smote)
    try:
        model, logged = fit_model(name, train, feature_names, target, weighting, config.random_state,
                                  (config.hyperparameters or {}).get(name), class_counts=counts)
        metrics = evaluate(with_probability(model.transform(test)), target, "prediction", "p1")
    except Exception as exc:
        raise RuntimeError(f"training of {name} failed: {exc}") from exc
    return ModelResult(name, run_id_of(parent, name), model, metrics, logged)


def _run_rows(results: dict[str, ModelResult], best: str, parent: str, config: TrainConfig) -> list:
    """One row per model and the parent's summary (metric and tag names are fixed values)."""
    rows = [run_row(run_id=r.run_id, parent_run_id=parent, experiment=config.experiment, run_name=r.name, run_type="model",
                    model=r.name, params=r.params, metrics={f"test_{k}": v for k, v in r.metrics.items()})
            for r in results.values()]
    f1, auc = results[best].metrics["f1"], results[best].metrics["roc_auc"]
    if len(results) == 1:
        summary, tags = {f"{best}_f1": f1, f"{best}_roc_auc": auc, "f1": f1, "roc_auc": auc}, {"model_type": best}
    else:
        summary = {"best_model_f1": f1, "best_model_roc_auc": auc}
        tags = {"best_model": best, "best_model_run_id": results[best].run_id}
    settings = {"use_smote": parse_bool_value(config.use_smote, default=False), "class_weight": config.class_weight,
                "random_state": config.random_state}
    rows.append(run_row(run_id=parent, parent_run_id=None, experiment=config.experiment, run_name=config.run_name,
                        run_type="parent", model=None, params=settings, metrics=summary, tags=tags))
    return rows


def select_best_name(results: dict) -> str:
    """Arg-max of F1 in training order; the first wins ties; one model is itself."""
    names = list(results)
    best = names[0]
    for n in names[1:]:
        if results[n].metrics["f1"] > results[best].metrics["f1"]:
            best = n
    return best


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as exc:  # noqa: BLE001
        raise FileNotFoundError(f"no saved model at {path}") from exc
