"""Exact percentiles (linear interpolation) without holding a group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a describe over a 100 TB table would funnel a whole
column into one reducer. Here, for any size:

1. distinct values with multiplicity per (group, column) -- map-side
   combined, so one hot value is one row however often it occurs;
2. these rows are dealt into ranges of (group, column, value), one task each,
   and stored with the number of their range;
3. range totals give each range's first rank within its (group, column);
4. only the ranges holding a wanted rank are ordered, by a window partitioned
   by (group, column, range).

The result equals NumPy/pandas ``quantile`` (linear) and DuckDB ``quantile_cont``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlab.session import checkpoint


def in_ranges(df: DataFrame, columns: list[str], ranges: int | None = None) -> DataFrame:
    """``df`` stored once, in ranges of ``columns`` numbered in order by ``_b``.

    Unless given there are as many ranges as the session has shuffle partitions,
    less those that adaptive execution merges because they are small.
    """
    dealt = df.repartitionByRange(ranges, *columns) if ranges else df.repartitionByRange(*columns)
    return checkpoint(dealt.withColumn("_b", F.spark_partition_id()))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], group_cols: list[str] | None = None,
                    buckets: int | None = None) -> DataFrame:
    """Return (group..., column_name, p, q); nulls skipped; empty groups absent."""
    group_cols = list(group_cols or [])
    data = df.select(*group_cols, *[F.col(c).cast("double").alias(c) for c in columns])
    long = data.select(*group_cols, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("_v")) for c in columns])))
    long = long.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    keys = group_cols + ["column_name"]
    counted = in_ranges(long.groupBy(*keys, "_v").agg(F.count("*").alias("_w")), [*keys, "_v"], buckets)
    per_bucket = counted.groupBy(*keys, "_b").agg(F.sum("_w").alias("_bw"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select(*keys, "_b", "_bw", F.coalesce(F.sum("_bw").over(before), F.lit(0)).alias("_start"),
                                   F.sum("_bw").over(Window.partitionBy(*keys)).alias("_n"))
    prob_arr = F.array(*[F.lit(float(p)) for p in probs])
    # (groups x columns x buckets) rows in, (groups x columns x probs x 2) rows out.
    targets = (per_bucket.select(*keys, "_b", "_bw", "_start", "_n", F.explode(prob_arr).alias("p"))
               .withColumn("_pos", F.col("p") * (F.col("_n") - 1))
               .withColumn("_r", F.explode(F.array(F.floor("_pos").cast("bigint"), F.ceil("_pos").cast("bigint"))))
               .where((F.col("_r") >= F.col("_start")) & (F.col("_r") < F.col("_start") + F.col("_bw")))
               .select(*keys, "p", "_pos", "_r", "_b", "_start"))
    # The small sides below (wanted buckets, target ranks) are left unhinted: AQE measures the
    # materialised aggregates at runtime and broadcasts them when small, else keeps a shuffle join.
    wanted = targets.select(*keys, "_b").distinct()
    wb = Window.partitionBy(*keys, "_b").orderBy("_v")
    in_bucket = (counted.join(wanted, keys + ["_b"], "left_semi")
                 .withColumn("_hi_rank", F.sum("_w").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
                 .withColumn("_lo_rank", F.col("_hi_rank") - F.col("_w")))
    at_rank = targets.join(in_bucket, keys + ["_b"]).where(
        (F.col("_r") - F.col("_start") >= F.col("_lo_rank")) & (F.col("_r") - F.col("_start") < F.col("_hi_rank")))
    out = at_rank.groupBy(*keys, "p", "_pos").agg(F.min_by("_v", "_r").alias("_vlo"), F.max_by("_v", "_r").alias("_vhi"))
    frac = F.col("_pos") - F.floor("_pos")
    return out.select(*keys, "p", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac).alias("q"))


def quantiles_wide(df: DataFrame, columns: list[str], probs: dict[str, float], group_cols: list[str] | None = None,
                   **kw) -> DataFrame:
    """(group..., column_name, <name>...) with one column per named probability."""
    group_cols = list(group_cols or [])
    long = exact_quantiles(df, columns, list(probs.values()), group_cols, **kw)
    return long.groupBy(*group_cols, "column_name").agg(
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(name) for name, p in probs.items()])
