"""Split, encoder and scaler of a table from one scan of it.

The split orders a class's rows by a seeded hash and gives the first quota to
test, so train is the end of that order. One aggregate over the table makes a
table of mergeable parts:

* ``bucket``: per class and leading hash digits the rows, and count, mean and
  squared deviations of every numeric column;
* ``value``: per class, categorical column and value the last (hash, id) that
  has it, so a value is in train if that lies behind the class's cut;
* ``row``: the single rows of the few buckets around the test share, where the
  quota is going to end.

Class sizes, quotas and the bucket in which a quota ends follow from the first;
the cut from the third; train's moments are the sum of the whole buckets behind
the cut's and of the rows behind the cut in its bucket. Only where a quota ends
outside the buckets kept row by row (a rare class of a large table) is the
table scanned again, for those buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions.hashing import seeded_hash
from churnlab.operators.prep import _check_quotas, number_values, quotas_of
from churnlab.session import checkpoint

DIGITS = 3  # leading hex digits of a bucket: 4,096 of them
NEAR_BUCKETS = 8  # buckets on each side of the test share that are kept row by row
SMALL_BYTES = 64_000_000  # a table that Spark takes for smaller is kept row by row as a whole


@dataclass
class Fitted:
    """Cut per class (cls, cut_h, cut_id), encoder and scaler tables, and the sizes of both parts."""

    cuts: DataFrame
    encoder: DataFrame
    scaler: DataFrame
    n_train: int
    n_test: int


def fit_parts(df: DataFrame, id_col: str, target: str | None, categorical: list[str], numeric: list[str], test_size: float,
              seed: int, every_row: bool, only: DataFrame | None = None) -> DataFrame:
    """The parts (kind, cls, name, value, h, id, n, last, and per numeric column its count, mean and deviations).

    ``only`` (cls, bucket) limits the table to rows of those buckets, kept row by row.
    """
    cls = (F.col(target) if target else F.lit(0)).alias("cls")
    h, key = seeded_hash(seed, F.col(id_col)), F.col(id_col)
    rows = df.select(cls, h.alias("h"), key.alias("id"), *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categorical)],
                     *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(numeric)])
    rows = rows.withColumn("bucket", F.substring("h", 1, DIGITS))
    if only is not None:
        rows = rows.join(F.broadcast(only), (F.col("cls").eqNullSafe(F.col("_cls"))) & (F.col("bucket") == F.col("_bucket")), "left_semi")
    none, share = F.lit(None), F.conv("bucket", 16, 10).cast("double") / 16 ** DIGITS
    near = F.lit(True) if every_row or only is not None else F.abs(share - test_size) <= NEAR_BUCKETS / 16 ** DIGITS

    def record(kind: str, name, value, h, key, last, numbers: bool) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"), value.cast("string").alias("value"),
                        h.cast("string").alias("h"), key.cast(df.schema[id_col].dataType).alias("id"),
                        last.cast(T.StructType([T.StructField("h", T.StringType()), T.StructField("id", df.schema[id_col].dataType)])).alias("last"),
                        *[(F.col(f"x{i}") if numbers else none.cast("double")).alias(f"x{i}") for i in range(len(numeric))])

    records = [F.when(near, record("row", F.col("bucket"), none, F.col("h"), F.col("id"), none, True))]
    if only is None:
        records.append(record("bucket", F.col("bucket"), none, none, none, none, True))
        for i, c in enumerate(categorical):
            records.append(F.when(F.col(f"c{i}").isNotNull(), record("value", F.lit(c), F.col(f"c{i}"), none, none,
                                                                     F.struct("h", "id"), False)))
    long = rows.select("cls", F.inline(F.filter(F.array(*records), lambda r: r.isNotNull())))
    sums = [F.count("*").alias("n"), F.max("last").alias("last")]
    for i in range(len(numeric)):
        x = f"x{i}"
        sums += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), (F.var_pop(x) * F.count(x)).alias(f"d{i}")]
    return checkpoint(long.groupBy("kind", "cls", "name", "value", "h", "id").agg(*sums))


def fit_in_one_scan(df: DataFrame, id_col: str, target: str | None, categorical: list[str], numeric: list[str],
                    test_size: float = 0.2, seed: int = 42) -> Fitted:
    """Cut, encoder and scaler of the train part, equal to those of ``stratified_split``, ``encode_fit`` and ``scale_fit``."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must be in (0, 1)")
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = fit_parts(df, id_col, target, categorical, numeric, test_size, seed, size <= SMALL_BYTES)
    buckets = parts.where("kind = 'bucket'").withColumnRenamed("name", "bucket")
    quotas = checkpoint(quotas_of(buckets.groupBy("cls").agg(F.sum("n").alias("n_c")), test_size))
    if target:
        _check_quotas(quotas, target)
    n, n_test = quotas.agg(F.max("n"), F.max("n_test")).first()

    # the bucket in which each class's quota ends, and how far into it
    before = Window.partitionBy("cls").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.select("cls", "bucket", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    goal = quotas.select("cls", F.col("n_test_c").alias("quota"))
    ending = checkpoint(placed.join(goal, "cls").where("start < quota and quota <= start + n").select(
        "cls", "bucket", (F.col("quota") - F.col("start")).alias("wanted")))
    rows = parts.where("kind = 'row'").withColumnRenamed("name", "bucket")
    lacking = ending.join(rows, ["cls", "bucket"], "left_anti").select(F.col("cls").alias("_cls"), F.col("bucket").alias("_bucket"))
    if not lacking.isEmpty():
        more = fit_parts(df, id_col, target, categorical, numeric, test_size, seed, False, lacking)
        rows = rows.unionByName(more.withColumnRenamed("name", "bucket"))
    inside = Window.partitionBy("cls", "bucket").orderBy("h", "id")
    edge = checkpoint(rows.join(ending, ["cls", "bucket"]).withColumn("place", F.row_number().over(inside)))
    cuts = checkpoint(edge.where("place = wanted").select("cls", "bucket", F.col("h").alias("cut_h"), F.col("id").alias("cut_id")))

    # a class without a test row has no cut: all of it is train
    cut = cuts.select("cls", F.col("bucket").alias("cut_bucket"), "cut_h", "cut_id")
    whole = buckets.join(cut, "cls", "left").where("cut_bucket is null or bucket > cut_bucket")
    behind = whole.select(*_moments(numeric)).unionByName(edge.where("place > wanted").select(*_moments(numeric)))
    scaler = _scaler(behind, numeric)

    last = parts.where("kind = 'value'").join(cut, "cls", "left").where(
        F.col("cut_h").isNull() | (F.col("last") > F.struct(F.col("cut_h").alias("h"), F.col("cut_id").alias("id"))))
    numbers = [c for c in categorical if isinstance(df.schema[c].dataType, T.NumericType)]
    sort_as = F.when(F.col("name").isin(numbers), F.col("value").try_cast("double")) if numbers else F.lit(None).cast("double")
    values = last.select(F.col("name").alias("column_name"), "value", sort_as.alias("_num")).distinct()
    return Fitted(cuts.drop("bucket"), checkpoint(number_values(values)), scaler, int((n or 0) - (n_test or 0)), int(n_test or 0))


def _moments(numeric: list[str]) -> list[str]:
    return [f"{k}{i}" for i in range(len(numeric)) for k in "nmd"]


def _scaler(parts: DataFrame, numeric: list[str]) -> DataFrame:
    """Scaler table from parts (count, mean, squared deviations), summed around the smallest part mean.

    A deviation that the rounding of the means alone explains is zero: the column
    never changes.
    """
    spark = parts.sparkSession
    if not numeric:
        return spark.createDataFrame([], "column_name string, mean double, scale double")
    parts, width = checkpoint(parts), range(len(numeric))
    least = parts.agg(*[F.min(f"m{i}") for i in width]).first()
    away = [F.col(f"m{i}") - F.lit(least[i] or 0.0) for i in width]
    n = [F.col(f"n{i}") for i in width]
    sums = parts.agg(*[F.sum(x) for x in n], *[F.sum(n[i] * away[i]) for i in width],
                     *[F.sum(F.col(f"d{i}") + n[i] * away[i] * away[i]) for i in width]).first()
    rows = []
    for i, c in enumerate(numeric):
        count, total, squares = sums[i], sums[len(numeric) + i], sums[2 * len(numeric) + i]
        if count:
            mean = least[i] + total / count
            deviation = (max(squares - total * total / count, 0.0) / count) ** 0.5
            rows.append((c, mean, deviation if deviation > 1e-13 * abs(mean) else 1.0))
        else:
            rows.append((c, None, 1.0))
    return spark.createDataFrame(rows, "column_name string, mean double, scale double")
