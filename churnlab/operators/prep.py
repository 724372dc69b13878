"""Leak-free feature preparation: seeded exact split, label encoding, standard scaling.

Fitting (encoder values, scaler moments) reads the train part only; the
fitted parameters are small tables (one row per category value / per
column) that are applied to both parts as column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions.hashing import seeded_hash, seeded_uniform
from churnlab.operators.rank import digits_for
from churnlab.session import checkpoint

ENCODER_SCHEMA = "column_name string, value string, code int"
SCALER_SCHEMA = "column_name string, mean double, scale double"
VALUES_PER_RANGE = 100_000  # distinct category values that one task numbers


# ---------------------------------------------------------------- split

def class_quotas(df: DataFrame, target: str | None, test_size: float) -> DataFrame:
    """(cls, n_c, n_test_c) per class: exact test quotas from one count per class.

    n_test = ceil(test_size * n); the train quotas follow by largest remainder
    over n_train (equal remainders: smaller class value first). The windows run
    over the class table, one row per class.
    """
    cls = F.col(target) if target else F.lit(0)
    return quotas_of(df.groupBy(cls.alias("cls")).agg(F.count("*").alias("n_c")), test_size)


def quotas_of(sizes: DataFrame, test_size: float) -> DataFrame:
    """``class_quotas`` from the class sizes (cls, n_c)."""
    everything = Window.partitionBy(F.lit(0))
    n = F.sum("n_c").over(everything)
    n_test = F.ceil(F.lit(float(test_size)) * n)
    quotas = sizes.withColumns({"n": n, "n_test": n_test, "k": F.count("*").over(everything)})
    quotas = quotas.withColumn("share", F.col("n_c") / F.col("n") * (F.col("n") - F.col("n_test")))
    quotas = quotas.withColumn("whole", F.floor("share"))
    place = F.row_number().over(everything.orderBy(F.desc(F.col("share") - F.col("whole")), "cls"))
    spare = F.col("n") - F.col("n_test") - F.sum("whole").over(everything)
    train = F.col("whole") + F.when(place <= spare, 1).otherwise(0)
    return quotas.withColumn("n_test_c", (F.col("n_c") - train).cast("bigint"))


def _check_quotas(quotas: DataFrame, target: str) -> None:
    seen = quotas.agg(F.count_if(F.col("cls").isNull()).alias("nulls"), F.min("n_c").alias("least"), F.max("n").alias("n"),
                      F.max("n_test").alias("n_test"), F.max("k").alias("k")).first()
    if seen["nulls"]:
        raise ValueError(f"Cannot stratify by '{target}': it has nulls.")
    if seen["k"] and seen["least"] < 2:
        raise ValueError(f"Cannot stratify by '{target}': a class has fewer than 2 members.")
    for part, size in (("test", seen["n_test"]), ("train", (seen["n"] or 0) - (seen["n_test"] or 0))):
        if seen["k"] and size < seen["k"]:
            raise ValueError(f"Cannot stratify by '{target}': {size} {part} rows for {seen['k']} classes.")


def quota_cuts(rows: DataFrame, quotas: DataFrame, digits: int) -> DataFrame:
    """(cls, cut_h, cut_id): per class the last (hash, id) inside its quota.

    ``rows`` is (cls, h, id), ``quotas`` (cls, quota). Counting by the leading
    hex digits of the uniform hash finds the one bucket of each class in which
    the quota ends; only that bucket's rows are ordered.
    """
    dealt = rows.withColumn("bucket", F.substring("h", 1, digits))
    before = Window.partitionBy("cls").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (dealt.groupBy("cls", "bucket").agg(F.count("*").alias("rows"))
              .withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))))
    ending = (counts.join(quotas, "cls").where((F.col("start") < F.col("quota")) & (F.col("quota") <= F.col("start") + F.col("rows")))
              .select("cls", "bucket", (F.col("quota") - F.col("start")).alias("wanted")))
    inside = Window.partitionBy("cls", "bucket").orderBy("h", "id")
    return (dealt.join(ending, ["cls", "bucket"]).withColumn("place", F.row_number().over(inside))
            .where(F.col("place") == F.col("wanted")).select("cls", F.col("h").alias("cut_h"), F.col("id").alias("cut_id")))


def stratified_split(df: DataFrame, id_col: str, target: str | None, test_size: float = 0.2,
                     seed: int = 42, split_col: str = "split", digits: int | None = None) -> DataFrame:
    """Add ``split`` in {'train','test'}: exact class quotas, seeded hash order.

    Rows of each class are ordered by md5('seed|id') (ties by id); the first
    quota rows go to test. Only (class, hash, id) are read to find one cut per
    class; the split itself is a comparison of each row with its class's cut,
    so no feature column is shuffled or stored. Ids must be distinct. A class
    with fewer than 2 rows is refused, like the reference's library.
    """
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must be in (0, 1)")
    quotas = checkpoint(class_quotas(df, target, test_size))
    if target:
        _check_quotas(quotas, target)
    cls = F.col(target) if target else F.lit(0)
    h = seeded_hash(seed, F.col(id_col))
    if digits is None:
        digits = digits_for(quotas.agg(F.max("n_c")).first()[0] or 0)
    rows = df.select(cls.alias("cls"), h.alias("h"), F.col(id_col).alias("id"))
    cuts = checkpoint(quota_cuts(rows, quotas.select("cls", F.col("n_test_c").alias("quota")), digits))
    return split_by_cuts(df, id_col, target, cuts, seed, split_col)


def split_by_cuts(df: DataFrame, id_col: str, target: str | None, cuts: DataFrame, seed: int, split_col: str = "split") -> DataFrame:
    """Add ``split`` by comparing each row's (hash, id) with its class's cut; ``cuts`` has one row per class."""
    cls, h = F.col(target) if target else F.lit(0), seeded_hash(seed, F.col(id_col))
    cuts = cuts.select(F.col("cls").alias("_cls"), F.col("cut_h").alias("_cut_h"), F.col("cut_id").alias("_cut_id"))
    in_test = (h < F.col("_cut_h")) | ((h == F.col("_cut_h")) & (F.col(id_col) <= F.col("_cut_id")))
    return (df.join(cuts, cls.eqNullSafe(F.col("_cls")), "left")
            .withColumn(split_col, F.when(in_test, "test").otherwise("train"))
            .drop("_cls", "_cut_h", "_cut_id"))


def random_split(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42,
                 split_col: str = "split") -> DataFrame:
    """Unstratified exact split (one class)."""
    return stratified_split(df, id_col, None, test_size, seed, split_col)


def split_approx(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42,
                 split_col: str = "split") -> DataFrame:
    """Map-only split: test when u(md5('seed|id')) < test_size; stable when rows are appended."""
    u = seeded_uniform(seed, F.col(id_col))
    return df.withColumn(split_col, F.when(u < F.lit(float(test_size)), "test").otherwise("train"))


# ---------------------------------------------------------------- encode

def encode_fit(train: DataFrame, columns) -> DataFrame:
    """Encoder table (column_name, value, code): codes 0..k-1 in sorted value order.

    Numeric categoricals sort numerically, strings by code point. Columns
    absent from the frame are skipped. Nulls are not encoded.
    """
    cols = [c for c in columns if c in train.columns]
    if not cols:
        return train.sparkSession.createDataFrame([], ENCODER_SCHEMA)
    numeric = {f.name for f in train.schema.fields if isinstance(f.dataType, T.NumericType)}
    parts = []
    for c in cols:
        parts.append(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                              (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("_num")))
    return number_values(train.select(F.inline(F.array(*parts))).where(F.col("value").isNotNull()).distinct())


def number_values(values: DataFrame) -> DataFrame:
    """The encoder table of distinct values (column_name, value, _num)."""
    order = ["column_name", "_num", "value"]
    values = checkpoint(values)
    # Ranges of sorted values, one task each; a value's code is its place in its range plus the ranges before.
    ranges = max(1, -(-values.count() // VALUES_PER_RANGE))
    ranged = checkpoint(values.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy("column_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy("column_name", "_range").agg(F.count("*").alias("_n"))
              .select("column_name", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy("column_name", "_range").orderBy("_num", "value")
    return ranged.join(starts, ["column_name", "_range"]).select(
        "column_name", "value", (F.col("_start") + F.row_number().over(inside) - 1).cast("int").alias("code"))


def encode_transform(df: DataFrame, encoder: DataFrame, columns, handle_invalid: str = "error") -> DataFrame:
    """Replace each categorical by its code: one left join with the encoder's rows per column.

    The joins carry no hint, so the planner broadcasts an encoder of a few
    values and shuffles for a large one. Unseen values: 'error' fails the job,
    'keep' maps them to k (the number of codes), 'skip' drops the row. Nulls
    stay null.
    """
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    sizes = {r["column_name"]: r["k"] for r in encoder.groupBy("column_name").agg(F.count("*").alias("k")).collect()}
    out, unseen_any = df, F.lit(False)
    for c in cols:
        codes = encoder.where(F.col("column_name") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_code_{c}"))
        out = out.join(codes, F.col(c).cast("string") == F.col(f"_v_{c}"), "left")
        code, unseen = F.col(f"_code_{c}"), F.col(c).isNotNull() & F.col(f"_code_{c}").isNull()
        if handle_invalid == "error":
            message = F.concat(F.lit(f"column '{c}' has a value that the encoder was not fitted on: "), F.col(c).cast("string"))
            code = F.when(unseen, F.raise_error(message)).otherwise(code)
        elif handle_invalid == "keep":
            code = F.when(unseen, F.lit(sizes.get(c, 0))).otherwise(code)
        else:
            out = out.withColumn(f"_unseen_{c}", unseen)
            unseen_any = unseen_any | F.col(f"_unseen_{c}")
        out = out.withColumn(c, code.cast("int")).drop(f"_v_{c}", f"_code_{c}")
    if handle_invalid == "skip":
        out = out.where(~unseen_any).drop(*[f"_unseen_{c}" for c in cols])
    return out


# ---------------------------------------------------------------- scale

def scale_fit(train: DataFrame, columns: list[str]) -> DataFrame:
    """Scaler table (column_name, mean, scale): mean and POPULATION std; zero std -> 1; nulls skipped."""
    if not columns:
        return train.sparkSession.createDataFrame([], SCALER_SCHEMA)
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__m"), F.stddev_pop(x).alias(f"{c}__s")]
    wide = train.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__m").alias("mean"),
                              F.col(f"{c}__s").alias("_sd")) for c in columns])
    return wide.select(F.inline(rows)).select(
        "column_name", "mean", F.when((F.col("_sd") == 0) | F.col("_sd").isNull(), 1.0).otherwise(F.col("_sd")).alias("scale"))


def scaler_params(scaler: DataFrame) -> dict[str, tuple[float, float]]:
    """The fitted moments (two numbers per column) as driver-side parameters."""
    return {r["column_name"]: (r["mean"], r["scale"]) for r in scaler.collect()}


def scale_transform(df: DataFrame, params: dict[str, tuple[float, float]], columns: list[str]) -> DataFrame:
    """(x - mean) / scale on exactly the fitted columns; a pure projection."""
    out = df
    for c in columns:
        if c not in params:
            raise ValueError(f"Column '{c}' was not fitted by the scaler.")
        m, s = params[c]
        mean = F.lit(m if m is not None else 0.0).cast("double")
        out = out.withColumn(c, (F.col(c).cast("double") - mean) / F.lit(float(s)))
    return out


__all__ = ["stratified_split", "random_split", "split_approx", "class_quotas", "encode_fit", "encode_transform",
           "scale_fit", "scale_transform", "scaler_params"]
