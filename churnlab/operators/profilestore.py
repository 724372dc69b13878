"""Profiles that merge: one stored row per partition of the data and column, never a second scan.

A part has counts, moments, extremes, a HyperLogLog sketch of the distinct
values and a KLL sketch of the quantiles, all by Spark's own aggregates. A new
partition of the data adds its rows to the store, a partition that is delivered
again replaces its own, and the profile of everything, or of some partitions, is
a merge of parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.operators.joins import unpivot

LG_DISTINCT = 14  # HyperLogLog: standard error 0.8 %
KLL_K = 800  # rank error of a quantile: about 0.4 %, 99 % of the time
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def profile_parts(df: DataFrame, columns: list[str], part: str, by: list[str] | None = None) -> DataFrame:
    """(part, by..., column_name, n_rows, n, mean, deviations, min, max, distinct, quantiles) of the numeric ``columns``.

    One scan; nulls and NaN count as missing. ``by`` splits a part further, as
    for statistics by class.
    """
    keys = ["part", *(by or [])]
    rows = df.select(F.col(part).cast("string").alias("part"), *(by or []), *[F.col(c).cast("double").alias(c) for c in columns])
    long = unpivot(rows, keys, columns, "column_name", "value", cast="double")
    value = F.when(~F.isnan("value"), F.col("value"))
    return long.withColumn("value", value).groupBy(*keys, "column_name").agg(
        F.count("*").alias("n_rows"), F.count("value").alias("n"), F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("deviations"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.hll_sketch_agg(F.xxhash64("value"), LG_DISTINCT).alias("distinct"),
        F.kll_sketch_agg_double("value", KLL_K).alias("quantiles")).withColumn(
        # a sketch of hashes has one for missing values as well
        "distinct", F.when(F.col("n") > 0, F.col("distinct")))


def add_parts(parts: DataFrame, path: str) -> None:
    """Write parts to the store; parts of a partition that is there already replace it, all others stay."""
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("part", F.col("part").cast("string"))


def merged_profile(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., column_name, n_rows, n, mean, std, min, max, unique_count, q25, q50, q75) over all ``parts``.

    Counts, extremes and moments are exact; ``unique_count`` and the quartiles
    are those of the merged sketches.
    """
    keys = [*(by or []), "column_name"]
    means = parts.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("_mean"))
    moved = F.col("deviations") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2)
    merged = parts.join(means, keys).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.first("_mean").alias("mean"), F.sum(moved).alias("_moved"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.hll_union_agg("distinct").alias("_distinct"),
        F.kll_merge_agg_double("quantiles").alias("_quantiles"))
    quartiles = F.kll_sketch_get_quantile_double("_quantiles", F.array(*[F.lit(p) for p in QUARTILES.values()]))
    some = F.col("n") > 0
    return merged.select(
        *keys, "n_rows", "n", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("_moved") / (F.col("n") - 1))).alias("std"), "min", "max",
        F.when(some, F.hll_sketch_estimate("_distinct")).otherwise(0).alias("unique_count"),
        *[F.when(some, quartiles[i]).alias(name) for i, name in enumerate(QUARTILES)])
