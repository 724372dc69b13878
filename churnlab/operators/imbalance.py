"""Class-imbalance handling: balanced class weights, positive-class weight, SMOTE."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlab.functions.hashing import seeded_hash, seeded_uniform
from churnlab.operators.knn import exact_knn
from churnlab.operators.rank import bucketed_rank, digits_for


def balanced_weights(df: DataFrame, target: str) -> DataFrame:
    """(label, n_c, weight) with weight = n / (k * n_c) -- scikit-learn's 'balanced'.

    The window runs over the per-class count table (k rows).
    """
    c = df.groupBy(F.col(target).alias("label")).agg(F.count("*").alias("n_c"))
    all_rows = Window.partitionBy()
    return c.select("label", "n_c", (F.sum("n_c").over(all_rows) /
                                     (F.count("*").over(all_rows) * F.col("n_c"))).alias("weight"))


def class_weight_map(weights: DataFrame) -> dict:
    """Per-class weights as driver-side parameters (one number per class)."""
    return {r["label"]: float(r["weight"]) for r in weights.collect()}


def with_weight_column(df: DataFrame, target: str, weights: dict, out: str = "weight") -> DataFrame:
    """Per-row weight from a class -> weight map (a literal map; no join)."""
    m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    return df.withColumn(out, F.coalesce(m[F.col(target)], F.lit(1.0)))


def class_count_map(df: DataFrame, target: str) -> dict:
    """Rows per class (one aggregate, one number per class)."""
    return {r["label"]: int(r["count"]) for r in df.groupBy(F.col(target).alias("label")).count().collect()}


def balanced_weight_map(counts: dict) -> dict:
    """n / (k * n_c) per class, from the class counts."""
    n, k = sum(counts.values()), len(counts)
    return {c: n / (k * nc) for c, nc in counts.items() if nc}


def pos_weight_from_counts(counts: dict, current=None, tuned: dict | None = None,
                           class_weight: str | None = "balanced") -> dict | None:
    """{0: 1, 1: neg/pos} for boosted trees under the reference's conditions (see :func:`pos_weight_map`)."""
    if class_weight != "balanced" or "scale_pos_weight" in (tuned or {}) or current not in (None, 0, 1):
        return None
    pos, neg = counts.get(1, 0), counts.get(0, 0)
    if pos == 0 or neg == 0:
        return None
    return {0: 1.0, 1: neg / pos}


def scale_pos_weight(df: DataFrame, target: str) -> DataFrame:
    """One row (positives, negatives, scale_pos_weight = neg/pos, null when a class is absent)."""
    c = df.agg(F.count_if(F.col(target) == 1).alias("positives"), F.count_if(F.col(target) == 0).alias("negatives"))
    return c.select("positives", "negatives",
                    F.when((F.col("positives") > 0) & (F.col("negatives") > 0),
                           F.col("negatives") / F.col("positives")).alias("scale_pos_weight"))


def pos_weight_map(df: DataFrame, target: str, current=None, tuned: dict | None = None,
                   class_weight: str | None = "balanced") -> dict | None:
    """Weights {0: 1, 1: neg/pos} for boosted trees, under the reference's conditions:
    class_weight 'balanced', not tuned explicitly, current value unset/0/1, both classes present."""
    if class_weight != "balanced" or "scale_pos_weight" in (tuned or {}) or current not in (None, 0, 1):
        return None
    r = scale_pos_weight(df, target).first()
    if r["scale_pos_weight"] is None:
        return None
    return {0: 1.0, 1: float(r["scale_pos_weight"])}


def smote(df: DataFrame, id_col: str, target: str, features: list[str], int_features=(), k: int = 5,
          seed: int = 42, **knn_options) -> DataFrame:
    """Synthetic minority oversampling: every class below the largest is raised to its count.

    Originals are kept unchanged (``smote_source`` null). For a class with
    n_c rows and n_new = n_max - n_c new rows, each row makes
    n_new div n_c samples, and the first n_new mod n_c rows in seeded hash
    order one more (counts by arithmetic, rows by ``explode(sequence)``).
    Sample j of row x: neighbour = one of x's k exact nearest same-class rows
    (drawn by md5(seed|nn|id|j)), gap u = md5(seed|gap|id|j) in [0, 1);
    value = x + u (nn - x); integer features are truncated back, as the
    reference library does.
    """
    counts = class_count_map(df, target)
    n_max = max(counts.values()) if counts else 0
    majority = min(c for c, n in counts.items() if n == n_max) if counts else None
    base = df.withColumn("smote_source", F.lit(None).cast("long")).withColumn("smote_draw", F.lit(None).cast("int"))
    parts = [base]
    ints = set(int_features)
    for cls, n_c in sorted(counts.items()):
        if cls == majority or n_c >= n_max:
            continue
        if n_c <= k:
            raise ValueError(f"Expected n_neighbors <= n_samples_fit, but n_samples_fit = {n_c}, n_neighbors = {k + 1}")
        rows = df.where(F.col(target) == F.lit(cls)).select(id_col, *features)
        knn = exact_knn(rows, id_col, features, k=k, seed=seed, **knn_options)
        q, r = divmod(n_max - n_c, n_c)
        ranked = bucketed_rank(rows.withColumn("_h", seeded_hash(seed, "smote", F.col(id_col))), [], "_h", id_col,
                               "_rk", digits=digits_for(n_c))
        cnt = F.lit(q) + F.when(F.col("_rk") <= F.lit(r), 1).otherwise(0)
        draws = (ranked.withColumn("_cnt", cnt).where(F.col("_cnt") > 0)
                 .withColumn("smote_draw", F.explode(F.sequence(F.lit(1), F.col("_cnt"))))
                 .withColumn("nn_rank", (F.floor(seeded_uniform(seed, "nn", F.col(id_col), F.col("smote_draw")) * k) + 1)
                             .cast("int"))
                 .withColumn("_gap", seeded_uniform(seed, "gap", F.col(id_col), F.col("smote_draw"))))
        nbrs = knn.select(F.col("a").alias(id_col), F.col("nn_rank").cast("int").alias("nn_rank"), F.col("b").alias("_b"))
        nb_feats = rows.select(F.col(id_col).cast("long").alias("_b"), *[F.col(c).alias(f"_nb_{c}") for c in features])
        joined = draws.join(nbrs, [id_col, "nn_rank"]).join(nb_feats, "_b")
        cols = []
        for c in df.columns:
            if c == id_col:
                cols.append(F.lit(None).cast(df.schema[c].dataType).alias(c))
            elif c == target:
                cols.append(F.lit(cls).cast(df.schema[c].dataType).alias(c))
            elif c in features:
                v = F.col(c).cast("double") + F.col("_gap") * (F.col(f"_nb_{c}").cast("double") - F.col(c).cast("double"))
                # listed columns hold whole numbers whatever their type: truncate towards zero
                cols.append((v.cast("bigint") if c in ints else v).cast(df.schema[c].dataType).alias(c))
            else:
                cols.append(F.lit(None).cast(df.schema[c].dataType).alias(c))
        parts.append(joined.select(*cols, F.col(id_col).cast("long").alias("smote_source"), "smote_draw"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
