"""Column profiling and target-rate reports.

Every report is a small DataFrame computed in as few passes as possible:
per-column statistics are one wide aggregate (not one job per column), and
multi-column group reports unpivot first so that a single shuffle serves all
dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.operators.corr import correlations
from churnlab.operators.joins import unpivot
from churnlab.operators.quantiles import quantiles_wide
from churnlab.session import checkpoint

NUMERIC_TYPES = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType)
# pandas' dtype-based numeric selection in the reference names exactly these.
SCALABLE_TYPES = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType)

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _r(c, places: int = 6):
    return F.round(c, places)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in set(exclude)]


def profile_info(df: DataFrame) -> DataFrame:
    """Like ``DataFrame.info()``: (position, column, non_null, dtype), one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = unpivot(counts, [], df.columns, "column_name", "non_null", cast="bigint")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pos = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(c), F.lit(i))])
    dt = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return long.select(pos[F.col("column_name")].cast("bigint").alias("position"), "column_name", "non_null",
                       dt[F.col("column_name")].alias("dtype"))


def describe(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, exact linear quartiles, max per numeric column.

    One wide aggregate (read back: one row) gives the moments; the quartiles
    are exact and distributed (``exact_quantiles``) unless ``approx``.
    """
    cols = columns or numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    row = df.agg(*aggs).first()
    stats = df.sparkSession.createDataFrame(
        [(c, row[f"{c}__count"], row[f"{c}__mean"], row[f"{c}__std"], row[f"{c}__min"], row[f"{c}__max"]) for c in cols],
        "column_name string, count bigint, mean double, std double, min double, max double")
    if approx:
        long = unpivot(df, [], cols, "column_name", "value", cast="double")
        q = long.groupBy("column_name").agg(
            F.percentile_approx("value", F.array(*[F.lit(p) for p in QUARTILES.values()]), 10_000).alias("_q")
        ).select("column_name", *[F.col("_q")[i].alias(k) for i, k in enumerate(QUARTILES)])
    else:
        q = quantiles_wide(df, cols, QUARTILES)
    out = stats.join(q, "column_name", "left")
    return out.select("column_name", "count", *[_r(F.col(c)).alias(c) for c in ("mean", "std", "min")],
                      *[_r(F.col(c)).alias(c) for c in QUARTILES], _r(F.col("max")).alias("max"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) for columns with at least one null; one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return unpivot(counts, [], df.columns, "column_name", "n_null", cast="bigint").where(F.col("n_null") > 0)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows equal (nulls equal) to an earlier row: sum(count - 1) per full-row group."""
    return df.groupBy(*df.columns).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def cardinality(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column, unique_count, unique_ratio, dtype): distinct non-null values per column.

    Unpivot to (column, value) and count distinct per column: one distributed
    distinct instead of one Expand branch per column.
    """
    long = unpivot(df, [], df.columns, "column_name", "value", cast="string")
    fn = F.approx_count_distinct if approx else F.count_distinct
    # count(*) per column over the unpivoted rows is the table's row count.
    per = long.groupBy("column_name").agg(fn("value").cast("bigint").alias("unique_count"),
                                     F.count("*").alias("n_rows"))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    dt = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return per.select(
        "column_name", "unique_count",
        _r(F.try_divide(F.col("unique_count").cast("double"), F.col("n_rows"))).alias("unique_ratio"),
        dt[F.col("column_name")].alias("dtype"))


def drop_high_cardinality(profile: DataFrame, threshold: float) -> DataFrame:
    """Columns whose distinct ratio exceeds ``threshold`` (input: :func:`cardinality`)."""
    return profile.where(F.col("unique_ratio") > threshold).select("column_name")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count), nulls dropped, most frequent first."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).count()
            .orderBy(F.desc("count"), "value"))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.count_if(F.col(target) == 1).alias("positives"),
                  F.count_if(F.col(target) == 0).alias("negatives"))


def share_of_total(df: DataFrame, target: str) -> DataFrame:
    """(label, count, share) of each class.

    The total is a window over the aggregated table, which has one row per
    class (bounded), so the unpartitioned window never sees input rows.
    """
    g = df.groupBy(F.col(target).alias("label")).count()
    total = F.sum("count").over(Window.partitionBy())
    return g.select("label", "count", _r(F.col("count") / total).alias("share")).orderBy("label")


def churn_rate(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.sum(F.col(target)).cast("bigint").alias("n_positive"),
                  _r(F.avg(F.col(target).cast("double"))).alias("rate"))


def rate_by_group(df: DataFrame, dims: list[str], target: str) -> DataFrame:
    """(dimension, value, n, rate, overall, diff) for every dimension in ONE aggregate.

    The rows are unpivoted to (dimension, value, y) and counted per
    (dimension, value) -- null keys included -- in one shuffle. The overall
    rate (all rows, the reference line) is summed from that aggregated table
    per dimension (one row per listed dimension, broadcast); null keys are then
    dropped from the per-value rows, as the reference's groupby does.
    """
    long = unpivot(df.select(*dims, target), [target], dims, "dimension", "value", cast="string")
    agg = long.groupBy("dimension", "value").agg(F.count("*").alias("n"),
                                                 F.sum(F.col(target).cast("double")).alias("_sy"),
                                                 F.count(F.col(target)).alias("_ny"))
    # The aggregated table (one row per dimension value) is stored once, so the data is scanned
    # once; the overall rate is one row per listed dimension (a bounded, static list).
    agg = checkpoint(agg)
    overall = agg.groupBy("dimension").agg((F.sum("_sy") / F.sum("_ny")).alias("_overall"))
    agg = agg.join(F.broadcast(overall), "dimension")
    rate = F.col("_sy") / F.col("_ny")
    return agg.where(F.col("value").isNotNull()).select(
        "dimension", "value", "n", _r(rate).alias("rate"), _r(F.col("_overall")).alias("overall"),
        _r(rate - F.col("_overall")).alias("diff"))


def crosstab(df: DataFrame, columns: list[str], target: str, classes=None) -> DataFrame:
    """(dimension, value, n_<class>...) counts for every column in ONE pass, zero-filled.

    Unpivot to (dimension, value, y), one grouped count, then the pivot of that
    small table. ``classes`` fixes the columns; without it they are the classes
    that occur. A class outside a given list is an error, not a silent loss.
    Null values are dropped as the reference's groupby does.
    """
    long = unpivot(df.select(*columns, target), [target], columns, "dimension", "value", cast="string")
    counted = checkpoint(long.where(F.col("value").isNotNull() & F.col(target).isNotNull())
                         .groupBy("dimension", "value", target).count())
    found = sorted(r[0] for r in counted.select(target).distinct().collect())
    if classes is None:
        classes = found
    elif set(found) - set(classes):
        raise ValueError(f"'{target}' has classes outside {list(classes)}: {sorted(set(found) - set(classes))}")
    return counted.groupBy("dimension", "value").agg(*[
        F.coalesce(F.sum(F.when(F.col(target) == F.lit(c), F.col("count"))), F.lit(0)).cast("bigint").alias(f"n_{c}")
        for c in classes])


def _bin_frame(df: DataFrame, features: list[str], target: str | None, bins: int) -> tuple[DataFrame, list[str]]:
    keys = ["feature"] + (["label"] if target else [])
    ids = [F.col(target).alias("label")] if target else []
    long = unpivot(df.select(*features, *([target] if target else [])).select(*ids, *features)
                   if target else df.select(*features), ["label"] if target else [], features,
                   "feature", "value", cast="double").where(F.col("value").isNotNull())
    stats = long.groupBy(*keys).agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"), F.count("*").alias("n"))
    # NumPy widens a zero range to [v - 0.5, v + 0.5].
    stats = stats.select(
        *keys, "n",
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("hi"))
    stats = stats.withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    # stats: one row per (listed feature, class) -- as many rows as the report has groups
    stats = F.broadcast(stats)
    # Bin index exactly as NumPy's uniform-bin histogram: scaled index, then corrected
    # against the linspace edges (edge i = i * step + lo, the last edge = hi).
    def edge(i):
        return F.when(i == F.lit(bins), F.col("hi")).otherwise(i * F.col("width") + F.col("lo"))

    v = F.col("value")
    i0 = ((v - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))).cast("bigint")
    i1 = F.when(i0 == F.lit(bins), F.lit(bins - 1)).otherwise(i0)
    i2 = F.when(v < edge(i1), i1 - 1).otherwise(i1)
    i3 = F.when((v >= edge(i2 + 1)) & (i2 != F.lit(bins - 1)), i2 + 1).otherwise(i2)
    counted = long.join(stats, keys).groupBy(*keys, i3.cast("bigint").alias("bin")).agg(F.count("*").alias("count"))
    grid = stats.select(*keys, "n", "lo", "hi", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    grid = grid.withColumn("bin", F.col("bin").cast("bigint"))
    grid = grid.withColumn("bin_lo_raw", edge(F.col("bin"))).withColumn("bin_hi_raw", edge(F.col("bin") + 1))
    out = grid.join(counted, keys + ["bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint"))
    return out, keys


def histogram(df: DataFrame, features: list[str], target: str | None = None, bins: int = 30,
              density: bool = False) -> DataFrame:
    """Equal-width bins over each (feature[, class])'s own min..max; last bin closed."""
    out, keys = _bin_frame(df, features, target, bins)
    cols = [*keys, "bin", _r(F.col("bin_lo_raw")).alias("bin_lo"), _r(F.col("bin_hi_raw")).alias("bin_hi"), "count"]
    if density:
        # NumPy: count / (n * width of this bin), widths from the edges.
        cols.append(_r(F.col("count") / (F.col("n") * (F.col("bin_hi_raw") - F.col("bin_lo_raw")))).alias("density"))
    return out.select(*cols)


def boxplot_stats(df: DataFrame, features: list[str], target: str, whis: float = 1.5) -> DataFrame:
    """Per (feature, class): quartiles, whiskers (extreme data within whis x IQR), flier count."""
    q = quantiles_wide(df.select(F.col(target).alias("label"), *features), features,
                       {"q1": 0.25, "median": 0.5, "q3": 0.75}, group_cols=["label"])
    q = q.withColumnRenamed("column_name", "feature").withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("_lo", F.col("q1") - whis * F.col("iqr")).withColumn("_hi", F.col("q3") + whis * F.col("iqr"))
    long = unpivot(df.select(F.col(target).alias("label"), *features), ["label"], features,
                   "feature", "value", cast="double").where(F.col("value").isNotNull())
    v = F.col("value")
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    # q has one row per (listed feature, class) -- as many rows as the report has groups
    agg = long.join(F.broadcast(q.select("feature", "label", "_lo", "_hi")), ["feature", "label"]).groupBy(
        "feature", "label").agg(F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
                                F.count_if(~inside).alias("n_fliers"), F.count("*").alias("n"))
    # As the plotting library: a whisker never ends inside the box.
    out = q.join(agg, ["feature", "label"]).withColumn("whisker_lo", F.least("whisker_lo", "q1")) \
        .withColumn("whisker_hi", F.greatest("whisker_hi", "q3"))
    return out.select(
        "feature", "label", "n", *[_r(F.col(c)).alias(c) for c in ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")],
        "n_fliers")


def _pair_r(a: str, b: str):
    x = F.col(a).cast("double")
    y = F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    xx = F.when(both, x)
    yy = F.when(both, y)
    den = F.stddev_pop(xx) * F.stddev_pop(yy)
    return F.when(den > 0, F.covar_pop(xx, yy) / den)


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson, pairwise-complete; (a, b, r), all ordered pairs; constant column -> null.

    One job for any number of columns (``operators/corr.py``); no ``corr`` (it
    raises on constant columns under ANSI).
    """
    return correlations(df, columns).select("a", "b", _r(F.col("r")).alias("r"))


def target_corr(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(feature, r) against the target, strongest positive first; only p pairs computed."""
    cols = [c for c in columns if c != target] + [target]
    wide = df.agg(*[_pair_r(c, target).alias(f"r{i}") for i, c in enumerate(cols)])
    long = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("r"))
                                          for i, c in enumerate(cols)])))
    return long.select("feature", _r(F.col("r")).alias("r")).orderBy(F.desc_nulls_last("r"), "feature")


def rate_by_split(df: DataFrame, target: str) -> DataFrame:
    """(split, n, rate): target rate in each part."""
    return df.groupBy("split").agg(F.count("*").alias("n"), _r(F.avg(F.col(target).cast("double"))).alias("rate"))
