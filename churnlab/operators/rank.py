"""Exact per-group ranks without putting a whole group into one window task.

``row_number() over (partition by class order by h)`` sends every row of a
class -- possibly most of the table -- to one task. Because the order key is
a uniform hash, its leading hex digits split each class into up to 16**d
equal buckets:

1. count rows per (group, bucket)              -- at most groups x 16**d rows
2. prefix-sum those counts per group            -- tiny window
3. join the offsets back, ``row_number`` inside (group, bucket), add offset.

The rank equals the plain window's rank (order by (h, tie)) exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.operators.joins import bounded_broadcast


def digits_for(max_group_rows: int, rows_per_bucket: int = 50_000, max_digits: int = 5) -> int:
    """Hex digits so that a (group, bucket) window holds about ``rows_per_bucket`` rows."""
    d = 1
    while d < max_digits and max_group_rows / 16 ** d > rows_per_bucket:
        d += 1
    return d


def bucketed_rank(df: DataFrame, group_cols: list[str], hash_col: str, tie_col: str,
                  out: str = "rank", digits: int = 4) -> DataFrame:
    """Add 1-based ``out``: position of each row within its group ordered by (hash_col, tie_col).

    ``hash_col`` must be a hex string whose prefix is uniformly distributed.
    """
    bucket: Column = F.substring(F.col(hash_col), 1, digits)
    rows = df.withColumn("_bkt", bucket)
    counts = rows.groupBy(*group_cols, "_bkt").agg(F.count("*").alias("_cnt"))
    before = Window.partitionBy(*group_cols).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, "_bkt", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    # At most (#groups x 16**digits) rows; checked before broadcasting.
    offsets = bounded_broadcast(offsets, 4_000_000)
    inner = Window.partitionBy(*group_cols, "_bkt").orderBy(hash_col, tie_col)
    return (rows.join(offsets, group_cols + ["_bkt"])
            .withColumn(out, F.row_number().over(inner) + F.col("_off"))
            .drop("_bkt", "_off"))
