"""Evaluation metrics as aggregates: confusion counts, accuracy/precision/recall/F1, exact ROC AUC."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlab.operators.quantiles import in_ranges
from churnlab.session import checkpoint


def _safe_div(a, b):
    # zero_division=0 semantics, ANSI-safe.
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row (tp, fp, tn, fn) for the positive class 1; one pass."""
    y, p = F.col(label), F.col(prediction)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))


def metrics_from_confusion(conf: DataFrame, *keys: str) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    return conf.select(*keys, _safe_div(tp + tn, tp + fp + tn + fn).alias("accuracy"), precision.alias("precision"),
                       recall.alias("recall"), _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """accuracy, precision, recall, F1 (class 1, zero_division=0)."""
    return metrics_from_confusion(confusion(df, label, prediction))


def roc_auc(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """Exact rank AUC (ties count one half); one class only -> 0.5.

    Score counts of :func:`score_counts` are dealt into ranges of the score,
    the negatives per range (one row per range) are prefix-summed, and inside
    each range a window gives the negatives strictly below each score;
    AUC = sum(pos * (neg_below + neg / 2)) / (P * N).
    """
    return _auc(score_counts(df, label, score), buckets).select("roc_auc")


def score_counts(df: DataFrame, label: str, score: str, *more: str) -> DataFrame:
    """(_s, more..., _pos, _neg): rows of class 1 and 0 per distinct score, map-side combined."""
    return df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("_s"), *more).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))


def _auc(counts: DataFrame, ranges: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys..., roc_auc) of the score counts of each combination of ``keys``."""
    ranged = in_ranges(counts, [*keys, "_s"], ranges)
    before = Window.partitionBy(*keys or [F.lit(0)]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    below = (ranged.groupBy(*keys, "_b").agg(F.sum("_neg").alias("_bneg"))
             .select(*keys, "_b", F.coalesce(F.sum("_bneg").over(before), F.lit(0)).alias("_off")))
    inside = Window.partitionBy(*keys, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.join(below, [*keys, "_b"]).withColumn("_below", F.col("_off") + F.coalesce(F.sum("_neg").over(inside), F.lit(0)))
    tot = ranked.groupBy(*keys).agg(F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0)).alias("_num"),
                     F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    one_class = (F.coalesce(F.col("_P"), F.lit(0)) == 0) | (F.coalesce(F.col("_N"), F.lit(0)) == 0)
    return tot.select(*keys, F.when(one_class, F.lit(0.5)).otherwise(
        F.col("_num") / (F.col("_P").cast("double") * F.col("_N"))).alias("roc_auc"))


def evaluate(df: DataFrame, label: str, prediction: str, score: str) -> dict[str, float]:
    """The five reported metrics. One pass over ``df`` counts rows per (score, prediction); all five come from it."""
    conf, auc = _measured(checkpoint(score_counts(df, label, score, prediction)), prediction)
    return {k: float(v) for k, v in {**conf.first().asDict(), **auc.first().asDict()}.items()}


def evaluate_each(counted: DataFrame, key: str, prediction: str) -> dict[object, dict[str, float]]:
    """The five metrics of every value of ``key``, all at once, from the stored :func:`score_counts` by key and prediction."""
    conf, auc = _measured(counted, prediction, key)
    found: dict[object, dict[str, float]] = {}
    for row in [*conf.collect(), *auc.collect()]:
        found.setdefault(row[key], {}).update({k: float(v) for k, v in row.asDict().items() if k != key})
    return found


def _measured(counted: DataFrame, prediction: str, *keys: str) -> tuple[DataFrame, DataFrame]:
    """(accuracy, precision, recall, f1) and (roc_auc) per ``keys``."""
    p = F.col(prediction)
    total = lambda column, on: F.coalesce(F.sum(F.when(p == on, F.col(column))), F.lit(0))
    conf = counted.groupBy(*keys).agg(total("_pos", 1).alias("tp"), total("_neg", 1).alias("fp"), total("_neg", 0).alias("tn"),
                                      total("_pos", 0).alias("fn"))
    per_score = counted.groupBy(*keys, "_s").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    return metrics_from_confusion(conf, *keys), _auc(per_score, keys=keys)
