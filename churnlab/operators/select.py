"""Choosing among models, trials and runs: arg-max with deterministic tie-breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def metrics_by_model(long: DataFrame, label: str, prediction: str, model_cols=("ordinal", "model")) -> DataFrame:
    """Confusion-based metrics for many models in ONE grouped pass over (model..., label, prediction)."""
    y, p = F.col(label), F.col(prediction)
    c = long.groupBy(*model_cols).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))
    d = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.select(*model_cols, d(tp + tn, tp + fp + tn + fn).alias("accuracy"), d(tp, tp + fp).alias("precision"),
                    d(tp, tp + fn).alias("recall"), d(2 * tp, 2 * tp + fp + fn).alias("f1"))


def select_best(table: DataFrame, metric: str, mode: str = "max", order_col: str = "ordinal",
                partition_cols: list[str] | None = None) -> DataFrame:
    """Top-1 per partition by metric (mode max/min), nulls skipped, first ordinal wins ties.

    The input is a result table (one row per model / trial), not raw data.
    """
    m = F.col(metric)
    key = m.desc() if mode == "max" else m.asc()
    w = Window.partitionBy(*(partition_cols or [])).orderBy(key, F.col(order_col).asc())
    return (table.where(m.isNotNull()).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))
