"""Model factory: the reference's three families as ``pyspark.ml`` estimators, Spark's own and those of this package."""

from __future__ import annotations

import copy
import math
import warnings
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier

from churnlab.operators.boosting import BoostParams
from churnlab.operators.forest import ForestParams
from churnlab.operators.logistic import LogisticParams
from churnlab.plans.boosted import NewtonBooster
from churnlab.plans.linear import LogisticNewton

MODEL_NAMES = ("logreg", "rf", "xgboost")

# Fixed default hyper-parameters of each family (values as in the reference's factories).
DEFAULT_PARAMS = {
    "logreg": {"C": 1.0, "max_iter": 1000, "solver": "lbfgs"},
    "rf": {"n_estimators": 100, "max_depth": 10, "min_samples_split": 10, "min_samples_leaf": 4,
           "max_features": "sqrt"},
    "xgboost": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
                "colsample_bytree": 0.8},
}
# Keys with an effect on the estimators; any other key is reported as ignored.
KNOWN_KEYS = {
    "logreg": {"C", "max_iter", "tol", "class_weight", "random_state", "fit_intercept", "solver"},
    "rf": {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features", "class_weight",
           "random_state", "bootstrap", "max_bins", "min_impurity_decrease"},
    "xgboost": {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "scale_pos_weight",
                "random_state", "max_bins", "gamma", "min_child_weight", "reg_lambda", "reg_alpha"},
}
SOLVERS = ("lbfgs", "liblinear")
MAX_TREE_DEPTH = 30  # Spark's forests refuse deeper trees.
MAX_BINS = 64


@dataclass
class ModelSpec:
    name: str
    params: dict = field(default_factory=dict)
    class_weight: str | None = "balanced"
    random_state: int = 42

    @property
    def seed(self) -> int:
        return int(self.params.get("random_state", self.random_state))

    def boost_params(self) -> BoostParams:
        p = self.params
        number = lambda key, default: float(default if p.get(key) is None else p[key])
        return BoostParams(
            n_estimators=int(number("n_estimators", 100)), max_depth=int(number("max_depth", 6)),
            learning_rate=number("learning_rate", 0.3), reg_lambda=number("reg_lambda", 1.0), reg_alpha=number("reg_alpha", 0.0),
            gamma=number("gamma", 0.0), min_child_weight=number("min_child_weight", 1.0), subsample=number("subsample", 1.0),
            colsample_bytree=number("colsample_bytree", 1.0), pos_weight=number("scale_pos_weight", 1.0), seed=self.seed)

    def logistic_params(self, class_weights: dict | None = None) -> LogisticParams:
        """The objective of either solver; ``liblinear`` shrinks the intercept like a coefficient."""
        p, w = self.params, class_weights or {}
        if p.get("solver", "lbfgs") not in SOLVERS:
            raise ValueError(f"solver {p['solver']!r} is none of {', '.join(SOLVERS)}")
        return LogisticParams(C=float(p.get("C", 1.0)), max_iter=int(p.get("max_iter", 1000)),
                              fit_intercept=bool(p.get("fit_intercept", True)),
                              penalise_intercept=p.get("solver") == "liblinear",
                              class_weights=(float(w.get(0, 1.0)), float(w.get(1, 1.0))))

    def forest_settings(self) -> dict:
        """Settings of a forest in the words of Spark's estimator."""
        p = self.params
        depth = p.get("max_depth", 10)
        return {"numTrees": int(p.get("n_estimators", 100)),
                "maxDepth": MAX_TREE_DEPTH if depth is None else min(int(depth), MAX_TREE_DEPTH),
                "minInstancesPerNode": max(int(p.get("min_samples_leaf", 1)), math.ceil(int(p.get("min_samples_split", 2)) / 2)),
                "featureSubsetStrategy": _subset(p.get("max_features", "sqrt")),
                "minInfoGain": float(p.get("min_impurity_decrease") or 0.0),
                "bootstrap": bool(p.get("bootstrap", True)), "maxBins": int(p.get("max_bins", 32))}

    def forest_params(self, width: int, class_weights: dict | None = None) -> ForestParams:
        """The same settings for forests that are grown together (``operators/forest.py``), on ``width`` columns."""
        s, w = self.forest_settings(), class_weights or {}
        return ForestParams(n_estimators=s["numTrees"], max_depth=s["maxDepth"], min_instances=s["minInstancesPerNode"],
                            min_gain=s["minInfoGain"], columns=_subset_size(s["featureSubsetStrategy"], width, s["numTrees"]),
                            bootstrap=s["bootstrap"], class_weights=(float(w.get(0, 1.0)), float(w.get(1, 1.0))), seed=self.seed)

    def estimator(self, features_col: str, label_col: str, weight_col: str | None, total_weight: float = 1.0,
                  class_weights: dict | None = None):
        """``class_weights`` are those of ``weight_col``, for the estimators that take them as numbers."""
        p, seed = self.params, self.seed
        if self.name == "logreg" and self.logistic_params().penalise_intercept:
            return LogisticNewton(self.logistic_params(class_weights), features_col, label_col)
        if self.name == "xgboost":
            return NewtonBooster(self.boost_params(), features_col, label_col, int(p.get("max_bins") or MAX_BINS))
        if self.name == "logreg":
            c = float(p.get("C", 1.0))
            # scikit-learn minimises C * sum(w * loss) + ||b||^2 / 2; Spark minimises
            # sum(w * loss) / sum(w) + regParam * ||b||^2 / 2, so regParam = 1 / (C * sum(w)).
            est = LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=int(p.get("max_iter", 1000)),
                                     regParam=1.0 / (c * max(total_weight, 1e-12)), elasticNetParam=0.0,
                                     standardization=False, tol=float(p.get("tol", 1e-6)),
                                     fitIntercept=bool(p.get("fit_intercept", True)))
        elif self.name == "rf":
            est = RandomForestClassifier(featuresCol=features_col, labelCol=label_col, seed=seed, **self.forest_settings(),
                                         # a forest grows many nodes per level: cache each row's node ids
                                         # (lineage cut every 10 levels via the shared checkpoint folder)
                                         # and aggregate more nodes per pass.
                                         cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=1024)
        else:  # pragma: no cover - guarded by get_model
            raise ValueError(self.name)
        if weight_col:
            est.setWeightCol(weight_col)
        return est


def _subset(v) -> str:
    """featureSubsetStrategy text; whole fractions keep a decimal point ('1' means ONE feature)."""
    if isinstance(v, str):
        try:
            f = float(v)
        except ValueError:
            return v
        v = f
    if v is None:
        return "all"
    f = float(v)
    return "all" if f >= 1.0 else repr(f)


def _subset_size(strategy: str, width: int, trees: int) -> int:
    """Columns that a node tries under Spark's ``featureSubsetStrategy``."""
    named = {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))),
             "onethird": math.ceil(width / 3), "auto": width if trees == 1 else math.ceil(math.sqrt(width))}
    size = named.get(strategy)
    if size is None:
        size = int(strategy) if strategy.isdigit() else math.ceil(float(strategy) * width)
    return min(max(1, size), width)


def get_model(name: str, class_weight: str | None = "balanced", random_state: int = 42) -> ModelSpec:
    if name not in MODEL_NAMES:
        raise ValueError(f"no model called {name!r}; there are {', '.join(MODEL_NAMES)}")
    return ModelSpec(name, copy.deepcopy(DEFAULT_PARAMS[name]), class_weight, random_state)


def apply_hyperparameters(spec: ModelSpec, hyperparams: dict | None) -> tuple[ModelSpec, dict]:
    """Apply known keys, ignore unknown ones, clamp min_samples_split >= 2; return (spec, applied)."""
    if not hyperparams:
        return spec, {}
    applied = {k: v for k, v in hyperparams.items() if k in KNOWN_KEYS[spec.name]}
    if "min_samples_split" in applied and applied["min_samples_split"] is not None \
            and float(applied["min_samples_split"]) < 2:
        applied["min_samples_split"] = 2
    new = copy.deepcopy(spec)
    new.params.update(applied)
    if "class_weight" in applied:
        new.class_weight = applied["class_weight"]
    if "random_state" in applied:
        new.random_state = int(applied["random_state"])
    return new, applied


def without_effect(spec: ModelSpec, hyperparams: dict | None) -> dict[str, str]:
    """What a run record must say besides the requested values: keys that are ignored and the depth that a forest really uses."""
    notes = {}
    ignored = sorted(set(hyperparams or {}) - KNOWN_KEYS[spec.name])
    if ignored:
        notes["ignored"] = ",".join(ignored)
    depth = spec.params.get("max_depth")
    if spec.name == "rf" and (depth is None or int(depth) > MAX_TREE_DEPTH):
        notes["max_depth_used"] = str(MAX_TREE_DEPTH)
    if notes:
        warnings.warn(f"{spec.name}: {notes}", stacklevel=2)
    return notes


def models_to_train(model_type: str | None, training_config: dict | None) -> list[str]:
    """One model if given (search mode), else the configured list, else all three."""
    if model_type:
        return [model_type]
    models = (training_config or {}).get("models")
    return list(models) if models is not None else list(MODEL_NAMES)
