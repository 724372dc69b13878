"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator key.

Every query reads the test tables (through the derived churn table) so its
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab import tracking
from churnlab.functions import scalars as sc
from churnlab.operators import columns as colops
from churnlab.operators import imbalance as imb
from churnlab.operators import metrics as mt
from churnlab.operators import prep
from churnlab.operators import profile as prof
from churnlab.operators.boosting import BoostParams
from churnlab.operators.joins import bounded_broadcast, unpivot
from churnlab.operators.profilestore import add_parts, merged_profile, profile_parts, read_parts
from churnlab.operators.select import metrics_by_model, select_best
from churnlab.plans.prepare import PrepOptions, Prepared, load_prepared, prepare
from churnlab.plans.scoring import (
    as_pipeline,
    parse_requests,
    requests_from_rows,
    respond,
    score_batch,
    score_requests,
)
from churnlab.plans.search import PROD_SPACE, SearchConfig, fold_of, random_search
from churnlab.plans import boosted
from churnlab.plans.train import (
    TrainConfig,
    applied_weights,
    assembler,
    load_model,
    save_model,
    train_stage,
    with_probability,
)
from churnlab.session import ensure_checkpoint_dir, scratch_path
from churnlab.sources.csv import scan_csv, scan_csv_dir, write_csv
from churnlab.sources.prepared import load_artifacts, read_prepared, save_artifacts, write_prepared
from churnlab.sources.runs import latest_artifact, read_runs, register_model
from churnlab.sources.tables import BASE_SCHEMA, ROLES, base_table
from churnlab.streaming.score_stream import score_stream

Query = Callable[[SparkSession, str], DataFrame]
R = ROLES

# Fixed report parameters shared with the oracle SQL.
RATE_DIMS = ["region", "segment", "n_priorities", "is_active"]
CROSSTAB_DIMS = ["region", "segment", "has_urgent", "is_active"]
HIGH_CARD_THRESHOLD = 0.5
HEAD_N = 5
TEST_SIZE = 0.2
SEED = 42
SMOTE_K = 5
PROFILE_ROWS = 100_000  # rows whose values one task counts


def _input_state(spark: SparkSession, sf: str) -> str:
    """Names, sizes and times of the input files of the churn table, by one job: changed data gets new stored tables."""
    paths = [f"{sf.rstrip('/')}/{table}.parquet" for table in ("customer", "orders", "nation", "region")]
    files = spark.read.format("binaryFile").load(paths)
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return repr(tuple(files.agg(F.count("*"), F.sum("length"), F.sum(mark)).first()))


def _stored_path(spark: SparkSession, name: str, sf: str) -> str:
    """Per application and state of the input files: reused by the queries of one session, never for other data."""
    app = spark.sparkContext.applicationId
    key = hashlib.md5(f"{app}|{sf}|{_input_state(spark, sf)}".encode()).hexdigest()[:16]
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/{name}-{key}"


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was finished; errors other than absence come through."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def _base(spark: SparkSession, sf: str) -> DataFrame:
    """The churn table, derived from the test tables once per state of the input and stored in the
    shared folder (an ETL output); every report reads it like any other table."""
    path = _stored_path(spark, "base", sf)
    if not _exists(spark, path):
        base_table(spark, sf).write.mode("overwrite").parquet(path)
    return spark.read.schema(BASE_SCHEMA).parquet(path)


def _duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Whole rows, id and name included; every seventh customer's row stands twice."""
    b = _base(spark, sf)
    return prof.duplicate_count(b.unionByName(b.where(F.col(R.id_col) % 7 == 0)))


def _merged_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The profile by region, the last region added to the store later, merged: exact figures, and whether the sketches hold.

    A quartile holds if its rank is within 2 % of the wanted share, a distinct
    count if it is within 5 % of the exact one.
    """
    b, path = _base(spark, sf), scratch_path(spark, "profile-store")
    late = F.col("region") == "EUROPE"
    add_parts(profile_parts(b.where(~late), list(R.numeric), "region"), path)
    add_parts(profile_parts(b.where(late), list(R.numeric), "region"), path)
    merged = bounded_broadcast(merged_profile(read_parts(spark, path)), 10_000)
    held = _sketches_hold(b.select(*R.numeric), merged)
    return round_doubles(merged.select("column_name", "n_rows", "n", "mean", "std", "min", "max"), 6).join(held, "column_name")


def _sketches_hold(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """(column_name, quartiles_hold, distinct_holds) of the ``merged`` profile against every value of ``rows``.

    The values are counted first, a bounded number of rows a task, and only then
    meet the profile: a column's rows never lie in one task.
    """
    n = rows.count()
    dealt = rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // PROFILE_ROWS)))
    counted = unpivot(dealt, [], rows.columns, "column_name", "value", cast="double").groupBy("column_name", "value").agg(
        F.count("*").alias("_n"))

    def share(held):  # of the values that are not missing
        return F.sum(F.when(held, F.col("_n")).when(~held, 0)) / F.sum(F.when(held.isNotNull(), F.col("_n")))

    shares = [share(F.col("value") <= F.col(q)) >= p - 0.02 for q, p in prof.QUARTILES.items()]
    shares += [share(F.col("value") < F.col(q)) <= p + 0.02 for q, p in prof.QUARTILES.items()]
    return counted.join(F.broadcast(merged), "column_name").groupBy("column_name").agg(
        reduce(lambda a, c: a & c, shares).alias("quartiles_hold"),
        (F.abs(F.count("value") - F.max("unique_count")) <= 0.05 * F.count("value") + 1).alias("distinct_holds"))


def _profile_queries() -> dict[str, Query]:
    t = R.target
    return {
        "scan_parquet": lambda s, sf: base_table(s, sf),
        "merged_profile": _merged_profile,
        "profile_info": lambda s, sf: prof.profile_info(_base(s, sf)),
        "describe": lambda s, sf: prof.describe(_base(s, sf)),
        # on the union of parts with different columns: the part without acct_balance yields nulls
        "null_counts": lambda s, sf: prof.null_counts(_union_all(s, sf)),
        "duplicate_count": lambda s, sf: _duplicates(s, sf),
        "cardinality": lambda s, sf: prof.cardinality(_base(s, sf)),
        "drop_high_cardinality": lambda s, sf: prof.drop_high_cardinality(
            prof.cardinality(_base(s, sf)), HIGH_CARD_THRESHOLD),
        "value_counts": lambda s, sf: prof.value_counts(_base(s, sf), "segment"),
        "share_of_total": lambda s, sf: prof.share_of_total(_base(s, sf), t),
        "churn_rate": lambda s, sf: prof.churn_rate(_base(s, sf), t),
        "rate_by_group": lambda s, sf: prof.rate_by_group(_base(s, sf), RATE_DIMS, t),
        "crosstab": lambda s, sf: prof.crosstab(_base(s, sf), CROSSTAB_DIMS, t),
        "class_counts": lambda s, sf: prof.class_counts(_base(s, sf), t),
        "histogram_density": lambda s, sf: prof.histogram(_base(s, sf), list(R.numeric), t, 30, density=True),
        "histogram_count": lambda s, sf: prof.histogram(_base(s, sf), ["tenure_years"], t, 30),
        "boxplot_stats": lambda s, sf: prof.boxplot_stats(_base(s, sf), list(R.numeric), t),
        "corr_matrix": lambda s, sf: prof.corr_matrix(_base(s, sf), R.correlation),
        "target_corr": lambda s, sf: prof.target_corr(_base(s, sf), R.correlation, t),
        "sort_values": lambda s, sf: prof.rate_by_group(_base(s, sf), ["region"], t).orderBy("rate", "value"),
    }


def _projection_queries() -> dict[str, Query]:
    t = R.target
    return {
        "remove_columns": lambda s, sf: colops.remove_columns(_base(s, sf), list(R.drop) + ["not_a_column"])[0],
        "split_xy": lambda s, sf: colops.split_xy(_base(s, sf), t)[0],
        "select_numeric": lambda s, sf: colops.select_numeric(_base(s, sf), exclude=[t, R.id_col]),
        "select_columns": lambda s, sf: _base(s, sf).select(*R.correlation),
        "filter_by_class": lambda s, sf: colops.filter_by_class(_base(s, sf), t, 1),
        "drop_nulls": lambda s, sf: colops.drop_nulls(_union_all(s, sf), ["acct_balance", "segment"]),
        "head": lambda s, sf: colops.head(_base(s, sf), R.id_col, HEAD_N),
        "flag_label": lambda s, sf: colops.with_flag_labels(_base(s, sf), t, "is_active"),
    }


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Comparison view: doubles rounded (engines differ in the last bits of sums)."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def _prepared(spark: SparkSession, sf: str) -> Prepared:
    return prepare(_base(spark, sf), PrepOptions(test_size=TEST_SIZE, seed=SEED))


def _prepared_stored(spark: SparkSession, sf: str) -> Prepared:
    """The preparation stage's output as the training stage reads it: prepared table + artifacts on storage."""
    path = _stored_path(spark, "prepared", sf)
    if not _exists(spark, path + "/metadata"):
        p = _prepared(spark, sf)
        write_prepared(p.data, path + "/data")
        save_artifacts(path, encoder=p.encoder, scaler=p.scaler, metadata=p.metadata())
    return load_prepared(spark, path, PrepOptions(test_size=TEST_SIZE, seed=SEED))


def _write_read(spark: SparkSession, sf: str) -> DataFrame:
    p = _prepared(spark, sf)
    path = scratch_path(spark, "prepared")
    write_prepared(p.data, path)
    return read_prepared(spark, path, R.target)


def _scaled_only(spark: SparkSession, sf: str) -> DataFrame:
    """The scaled columns alone, by a scaler read back from storage."""
    p = _prepared(spark, sf)
    path = scratch_path(spark, "scaler")
    p.scaler.write.parquet(path)
    params = prep.scaler_params(spark.read.parquet(path))
    raw = _base(spark, sf).select(R.id_col, *p.scaled_columns)
    return round_doubles(prep.scale_transform(raw, params, p.scaled_columns))


def _save_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    p = _prepared(spark, sf)
    path = scratch_path(spark, "artifacts")
    save_artifacts(path, encoder=p.encoder, scaler=p.scaler, metadata=p.metadata())
    got = load_artifacts(spark, path)
    none = F.lit(None)
    meta = got["metadata"]
    return (got["scaler"].select(F.lit("scaler").alias("artifact"), F.col("column_name").alias("name"), none.cast("string").alias("value"),
                                 none.cast("bigint").alias("n"), "mean", "scale")
            .unionByName(got["encoder"].select(F.lit("encoder").alias("artifact"), F.col("column_name").alias("name"), "value",
                                               F.col("code").cast("bigint").alias("n")), allowMissingColumns=True)
            .unionByName(meta.select(F.lit("metadata").alias("artifact"), F.lit("n_train").alias("name"),
                                     F.array_join("feature_names", ",").alias("value"), F.col("n_train").alias("n")),
                         allowMissingColumns=True))


def _prep_queries() -> dict[str, Query]:
    t = R.target
    idc = R.id_col

    def split_view(df):
        return df.select(idc, t, "split")

    return {
        "stratified_split": lambda s, sf: split_view(prep.stratified_split(_base(s, sf), idc, t, TEST_SIZE, SEED)),
        "random_split": lambda s, sf: split_view(prep.random_split(_base(s, sf), idc, TEST_SIZE, SEED)),
        "split_approx": lambda s, sf: prep.split_approx(_base(s, sf), idc, TEST_SIZE, SEED).select(idc, "split"),
        "encode_fit": lambda s, sf: _prepared(s, sf).encoder,
        "encode_transform": lambda s, sf: _prepared(s, sf).data.select(idc, *R.categorical, "split"),
        "scale_fit": lambda s, sf: round_doubles(_prepared(s, sf).scaler),
        "scale_transform": lambda s, sf: _scaled_only(s, sf),
        "prepare": lambda s, sf: round_doubles(_prepared(s, sf).data),
        "metadata": lambda s, sf: _prepared(s, sf).metadata(),
        "write_prepared": lambda s, sf: round_doubles(_write_read(s, sf)),
        "read_prepared": lambda s, sf: _write_read(s, sf).groupBy("split", R.target).agg(F.count("*").alias("n")),
        "save_artifacts": lambda s, sf: round_doubles(_save_artifacts(s, sf)),
        "churn_share_by_split": lambda s, sf: prof.rate_by_split(
            prep.stratified_split(_base(s, sf), idc, t, TEST_SIZE, SEED), t),
    }


# Fixed SQL-expressible stand-in scorers, so metric queries can be checked by an oracle.
SCORERS = {
    "rule_activity": "CAST(10 * (1 - is_active) - tenure_years + n_priorities AS DOUBLE) / 10",
    "rule_orders": "CAST(6 * (1 - is_active) + 2 * has_urgent - n_orders AS DOUBLE) / 10",
    "rule_balance": "CAST(4 * (1 - is_active) + n_priorities - tenure_years AS DOUBLE) / 10",
}
THRESHOLD = 0.0


def scored(spark: SparkSession, sf: str, scorer: str = "rule_activity") -> DataFrame:
    b = _base(spark, sf)
    sc = F.expr(SCORERS[scorer])
    return b.select(R.id_col, R.target, sc.alias("score"),
                    F.when(sc > F.lit(THRESHOLD), 1).otherwise(0).alias("prediction"))


def _best_model(spark: SparkSession, sf: str) -> DataFrame:
    b = _base(spark, sf)
    names = list(SCORERS)
    preds = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(n).alias("model"),
                               F.when(F.expr(SCORERS[n]) > F.lit(THRESHOLD), 1).otherwise(0).alias("prediction"))
                      for i, n in enumerate(names)])
    long = b.select(R.target, F.inline(preds))
    return select_best(metrics_by_model(long, R.target, "prediction"), "f1")


def _metric_queries() -> dict[str, Query]:
    t = R.target
    return {
        "confusion": lambda s, sf: mt.confusion(scored(s, sf), t, "prediction"),
        "metrics": lambda s, sf: round_doubles(mt.classification_metrics(scored(s, sf), t, "prediction")),
        "roc_auc": lambda s, sf: round_doubles(mt.roc_auc(scored(s, sf), t, "score")),
        "best_model": lambda s, sf: round_doubles(_best_model(s, sf)),
        "smote": _smote,
        "smote_disables_weights": _smote_weights,
        "balanced_weights": lambda s, sf: round_doubles(imb.balanced_weights(_train(s, sf), t)),
        "scale_pos_weight": lambda s, sf: round_doubles(imb.scale_pos_weight(_train(s, sf), t)),
    }


def _smote(spark: SparkSession, sf: str) -> DataFrame:
    p = _prepared_stored(spark, sf)
    # Features rounded to 6 places first so an oracle engine sees the same inputs.
    train = round_doubles(p.data.where(F.col("split") == "train").drop("split"))
    out = imb.smote(train, R.id_col, R.target, p.feature_names, int_features=p.encoded_columns, k=SMOTE_K, seed=SEED)
    return round_doubles(out)


def _smote_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Class sizes after SMOTE and the class weights a balanced-weight fit then applies (all 1: switched off)."""
    p = _prepared_stored(spark, sf)
    train = p.data.where(F.col("split") == "train").drop("split")
    balanced = imb.smote(train, R.id_col, R.target, p.feature_names, int_features=p.encoded_columns, k=SMOTE_K,
                         seed=SEED)
    return round_doubles(applied_weights(balanced, R.target, "balanced", use_smote=True))


def _train(spark: SparkSession, sf: str) -> DataFrame:
    return prep.stratified_split(_base(spark, sf), R.id_col, R.target, TEST_SIZE, SEED).where(F.col("split") == "train")


# ---------------------------------------------------------------- sources, unions, scalar functions

def _base_csv(spark: SparkSession, sf: str) -> str:
    """The base as CSV, its columns in another order than the schema's."""
    path = scratch_path(spark, "base-csv")
    b = _base(spark, sf)
    write_csv(b.select(*sorted(b.columns, reverse=True)), path)
    return path


def _scan_csv_dir(spark: SparkSession, sf: str) -> DataFrame:
    """Two writes into one folder: churned rows with every column, the others without acct_balance."""
    b = _base(spark, sf)
    path = scratch_path(spark, "csv-dir")
    write_csv(b.where(F.col(R.target) == 1), path)
    write_csv(b.where(F.col(R.target) == 0).drop("acct_balance"), path, mode="append")
    return scan_csv_dir(spark, path, BASE_SCHEMA)


def _coerced(spark: SparkSession, sf: str) -> DataFrame:
    """Every CSV field read back as text, then typed by literal coercion."""
    path = _base_csv(spark, sf)
    text = scan_csv(spark, path + "/*.csv", T.StructType([T.StructField(f.name, T.StringType())
                                                          for f in BASE_SCHEMA.fields]))
    cols = [c for c in text.columns if c != R.id_col]
    long = unpivot(text, [R.id_col], cols, "column_name", "text")
    kind, n = F.col(R.id_col).cast("bigint") % 12, F.col("n_orders")
    odd = (F.when(kind == 0, F.concat(F.lit("00"), n)).when(kind == 1, F.concat(n, F.lit("_000")))
           .when(kind == 2, F.concat(F.lit("'"), "segment", F.lit("'"))).when(kind == 3, "tRue").when(kind == 4, "NONE")
           .when(kind == 6, F.concat(F.lit("  "), n, F.lit(" "))).when(kind == 7, F.concat(n, F.lit("e3")))
           .when(kind == 8, F.concat(F.lit("."), n)).when(kind == 9, F.concat(F.lit("it's "), "segment"))
           .when(kind == 10, F.concat(F.lit("-"), n, F.lit("."))).when(kind == 11, F.concat(F.lit('"'), "region", F.lit('"'))))
    long = long.unionByName(text.select(R.id_col, F.lit("odd").alias("column_name"), odd.alias("text")))
    return long.select(F.col(R.id_col).cast("bigint").alias(R.id_col), "column_name",
                       sc.coerce_literal(F.col("text")).alias("v")).select(R.id_col, "column_name", "v.*")


FLAG_WORDS = [" Yes ", "TRUE", "y", "On", "1", "no ", "False", "N", "oFF", "0", None]


def _parse_flags(spark: SparkSession, sf: str) -> DataFrame:
    path = _base_csv(spark, sf)
    text = scan_csv(spark, path + "/*.csv", T.StructType([T.StructField(f.name, T.StringType())
                                                          for f in BASE_SCHEMA.fields]))
    key = F.col(R.id_col).cast("bigint")
    word = F.array(*[F.lit(x) for x in FLAG_WORDS])[(key % len(FLAG_WORDS)).cast("int")]
    return text.select(key.alias(R.id_col), *[sc.parse_bool(F.col(f), default=False).alias(f) for f in list(R.flags) + [R.target]],
                       sc.parse_bool(word, default=True).alias("word"),
                       sc.parse_bool(F.col("n_orders").cast("int") - 3, default=False, numeric=True).alias("number"))


def _union_all(spark: SparkSession, sf: str) -> DataFrame:
    b = _base(spark, sf)
    return b.where(F.col(R.target) == 1).unionByName(
        b.where(F.col(R.target) == 0).drop("acct_balance"), allowMissingColumns=True)


def _source_queries() -> dict[str, Query]:
    return {
        "scan_csv": lambda s, sf: scan_csv(s, _base_csv(s, sf) + "/*.csv", BASE_SCHEMA),
        "scan_csv_dir": _scan_csv_dir,
        "union_all": _union_all,
        "coerce_literal": lambda s, sf: round_doubles(_coerced(s, sf)),
        "parse_bool": _parse_flags,
    }


# ---------------------------------------------------------------- models, scoring, search (rows-only checks)

TRAIN_CONFIG = dict(class_weight="balanced", random_state=42)
# The reference's production training config (fixed values): boosted trees, SMOTE on.
PROD_TRAIN = dict(models=["xgboost"], class_weight="balanced", random_state=42, use_smote="true",
                  hyperparameters={
                      "logreg": {"C": 1.0, "max_iter": 1000, "solver": "lbfgs"},
                      "rf": {"n_estimators": 100, "max_depth": 6, "min_samples_split": 2, "min_samples_leaf": 1,
                             "max_features": "sqrt"},
                      "xgboost": {"n_estimators": 200, "max_depth": 5, "learning_rate": 0.05, "subsample": 1,
                                  "colsample_bytree": 0.6}})
REQUEST_GROUP = 4  # rows per JSON request


def _train_one(spark: SparkSession, sf: str, model: str, use_smote=False):
    p = _prepared_stored(spark, sf)
    cfg = TrainConfig(models=[model], use_smote=use_smote, **TRAIN_CONFIG)
    res = train_stage(spark, p.data, p.feature_names, R.target, cfg, int_features=p.encoded_columns)
    return p, res


def learned(scored: DataFrame, target: str = R.target) -> bool:
    """Whether ``probability`` loses less than any constant does, each class weighing the same (all models here are balanced).

    A constant, and so a model that has learned nothing, loses ln 2 at least.
    """
    p = F.when(F.col(target) == 1, F.col("probability")).otherwise(1 - F.col("probability"))
    losses = scored.groupBy(target).agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("loss"))
    loss, classes = losses.agg(F.avg("loss"), F.count("*")).first()
    return classes == 2 and loss < math.log(2) - 1e-9


def at_optimum(scored: DataFrame, model, features: list[str], weights: dict, c: float = 1.0, target: str = R.target) -> bool:
    """Whether logistic regression has solved its problem: no coefficient can move without loss.

    The gradient sum(w (p - y) x) + b / C is zero in every coefficient, up to
    1e-4 a row.
    """
    w = F.when(F.col(target) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0])) * (F.col("probability") - F.col(target))
    sums = scored.agg(F.count("*"), F.sum(w), *[F.sum(w * F.col(f)) for f in features]).first()
    pulls = [sums[1], *[g + b / c for g, b in zip(sums[2:], model.coefficients.toArray().tolist())]]
    return max(abs(x) for x in pulls) <= 1e-4 * sums[0]


def _facts(scored: DataFrame, *keys: str, **known: bool) -> DataFrame:
    """What must hold of the rows and of the model: the label follows the probability, which is one; ``known`` as columns."""
    p = F.col("probability")
    return scored.select(*keys, p.between(0, 1).alias("is_probability"), ((F.col("prediction") == 1) == (p > 0.5)).alias("label_follows"),
                         *[F.lit(v).alias(k) for k, v in known.items()])


def _predictions(p: Prepared, model, split: str = "test", *keep: str) -> DataFrame:
    rows = p.data.where(F.col("split") == split)
    return with_probability(model.transform(rows)).select(R.id_col, R.target, "prediction", F.col("p1").alias("probability"), *keep)


def _trained_family(model: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        p, res = _train_one(spark, sf, model)
        train = _predictions(p, res.best_model, "train", *p.feature_names)
        known = {"beats_constant": learned(train)}
        if model == "logreg":
            weights = imb.balanced_weight_map(imb.class_count_map(train, R.target))
            known["at_optimum"] = at_optimum(train, res.best_model.stages[-1], p.feature_names, weights)
        return _facts(_predictions(p, res.best_model), R.id_col, R.target, **known)
    return q


STUMP_FEATURES = ["n_orders", "n_priorities", "tenure_years", "has_urgent", "is_active"]
STUMP = BoostParams(n_estimators=1, max_depth=1, learning_rate=0.3, reg_lambda=1.0, min_child_weight=1.0)


def _boosted_stump(spark: SparkSession, sf: str) -> DataFrame:
    """The first split of the second-order booster on raw columns: the test rows' probabilities, which SQL can repeat."""
    rows = assembler(STUMP_FEATURES, "xgboost").transform(
        prep.stratified_split(_base(spark, sf), R.id_col, R.target, TEST_SIZE, SEED))
    train = rows.where(F.col("split") == "train")
    counts = imb.class_count_map(train, R.target)
    model = boosted.fit_many(train, [replace(STUMP, pos_weight=counts[0] / counts[1])], "features", R.target)[0]
    scored = with_probability(model.transform(rows.where(F.col("split") == "test")))
    return scored.select(R.id_col, F.round("p1", 9).alias("probability"), "prediction")


def _train_stage(spark: SparkSession, sf: str) -> DataFrame:
    """The stage's runs as its store holds them, with what it trained and tested on and whether the best model was kept."""
    p = _prepared_stored(spark, sf)
    runs, kept = scratch_path(spark, "train-runs"), scratch_path(spark, "best-model")
    res = train_stage(spark, p.data, p.feature_names, R.target, TrainConfig(**PROD_TRAIN),
                      int_features=p.encoded_columns, runs_path=runs, model_path=kept)
    sizes = p.data.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    loaded = _predictions(p, load_model(kept))
    same = loaded.join(_predictions(p, res.best_model).select(R.id_col, F.col("probability").alias("_p")), R.id_col).agg(
        F.count_if(F.col("probability") == F.col("_p")).alias("n_same_after_load"))
    rows = read_runs(spark, runs).select("run_type", "model", F.size("metrics").alias("n_metrics"))
    facts = {**sizes.first().asDict(), **same.first().asDict()}
    return rows.select("*", *[F.lit(v).cast("long").alias(k) for k, v in facts.items()])


def _predict(spark: SparkSession, sf: str) -> DataFrame:
    """The deployed model's labels and probabilities on the test rows."""
    p, pipe = _serving(spark, sf)
    return _facts(score_batch(pipe, _raw_test(spark, sf), [R.id_col, R.target]), R.id_col, R.target,
                  beats_constant=learned(score_batch(pipe, _train(spark, sf), [R.target])))


def _score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """All raw rows scored by the deployed model."""
    _, pipe = _serving(spark, sf)
    return _facts(score_batch(pipe, _base(spark, sf), [R.id_col]), R.id_col,
                  beats_constant=learned(score_batch(pipe, _train(spark, sf), [R.target])))


def _serving(spark: SparkSession, sf: str):
    """The deployed pipeline: trained and registered once per state of the input, then loaded like an endpoint does."""
    path = _stored_path(spark, "serving-model", sf)
    p = _prepared_stored(spark, sf)
    if not _exists(spark, path + "/metadata"):
        p, res = _train_one(spark, sf, "logreg")
        pipe = as_pipeline(p.encoder, p.scaler_params, p.feature_names, res.best_model)
        save_model(pipe, path)
        register_model(spark, _stored_path(spark, "model-registry", sf), "logreg-serving", path, res.results["logreg"].run_id)
    return p, load_model(path)


RAW_FEATURES = ["region", "segment", "acct_balance", "n_orders", "n_priorities", "avg_price_cents", "tenure_years",
                "has_urgent", "is_active"]
RAW_TYPES = {f.name: f.dataType.simpleString() for f in BASE_SCHEMA.fields}


def _raw_test(spark: SparkSession, sf: str) -> DataFrame:
    return prep.stratified_split(_base(spark, sf), R.id_col, R.target, TEST_SIZE, SEED).where(F.col("split") == "test")


def _as_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """All raw rows through the pipeline against the prepared rows through the bare model."""
    p, res = _train_one(spark, sf, "logreg")
    pipe = as_pipeline(p.encoder, p.scaler_params, p.feature_names, res.best_model)
    direct = with_probability(res.best_model.transform(p.data)).select(R.id_col, F.col("p1").alias("_p"))
    both = score_batch(pipe, _base(spark, sf), [R.id_col]).join(direct, R.id_col)
    return both.select(R.id_col, (F.abs(F.col("probability") - F.col("_p")) < 1e-9).alias("same"))


def _save_load(spark: SparkSession, sf: str) -> DataFrame:
    """All rows scored before the model is saved and after it is loaded."""
    _, pipe = _serving(spark, sf)
    again = load_model(save_model(pipe, scratch_path(spark, "model")))
    before = score_batch(pipe, _base(spark, sf), [R.id_col]).select(R.id_col, F.col("probability").alias("_p"))
    both = score_batch(again, _base(spark, sf), [R.id_col]).join(before, R.id_col)
    return both.select(R.id_col, (F.col("probability") == F.col("_p")).alias("same"))


def _load(spark: SparkSession, sf: str) -> DataFrame:
    """The model that the registry names, loaded: labels of all rows against those of the served one."""
    _, pipe = _serving(spark, sf)
    newest = latest_artifact(spark.read.parquet(_stored_path(spark, "model-registry", sf)), name_like="logreg%").first()["path"]
    served = score_batch(pipe, _base(spark, sf), [R.id_col]).select(R.id_col, F.col("prediction").alias("_l"))
    both = score_batch(load_model(newest), _base(spark, sf), [R.id_col]).join(served, R.id_col)
    return both.select(R.id_col, (F.col("prediction") == F.col("_l")).alias("same_label"))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    b = _base(spark, sf).withColumn("_g", F.floor(F.col(R.id_col) / REQUEST_GROUP))
    return requests_from_rows(b, R.id_col, RAW_FEATURES, "_g")


def _faulty_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of which some are broken: by id, a cut-off body, a missing column, a category that no row has."""
    r, g = _requests(spark, sf), F.col("request_id")
    body = (F.when(g % 11 == 3, F.substring("body", 1, 30)).when(g % 11 == 5, F.replace("body", F.lit('"region"'), F.lit('"area"')))
            .when(g % 11 == 7, F.replace("body", F.lit('"BUILDING"'), F.lit('"CASTLES"'))).otherwise(F.col("body")))
    return r.withColumn("body", body)


def _score_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every request gets an answer: its scored rows, and its rejects with their reasons."""
    scored, rejects = score_requests(_serving(spark, sf)[1], _faulty_requests(spark, sf), RAW_FEATURES, RAW_TYPES, with_rejects=True)
    answers = respond(scored, rejects).select("request_id", F.from_json(
        "response", "index array<long>, predictions array<int>, rejected array<struct<index: long, reason: string>>").alias("a"))
    return answers.select("request_id", F.size("a.predictions").alias("n_predictions"),
                          F.array_join("a.index", ",").alias("indexes"),
                          F.array_join(F.transform("a.rejected", lambda x: F.concat(
                              F.coalesce(x["index"].cast("string"), F.lit("all")), F.lit(" "), x["reason"])), ";").alias("rejected"))


def _score_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's rows against the batch's: same requests, same probabilities."""
    _, pipe = _serving(spark, sf)
    src = scratch_path(spark, "requests")
    _requests(spark, sf).write.mode("overwrite").json(src)
    streamed = score_stream(spark, pipe, src, scratch_path(spark, "scored"), scratch_path(spark, "stream-ckpt"), RAW_FEATURES, RAW_TYPES)
    batch = score_requests(pipe, _requests(spark, sf), RAW_FEATURES, RAW_TYPES).select(
        "request_id", "index", F.col("probability").alias("_p"))
    return streamed.join(batch, ["request_id", "index"]).select("request_id", "index", (F.col("probability") == F.col("_p")).alias("same"))


def _run_search(spark: SparkSession, sf: str) -> DataFrame:
    p = _prepared_stored(spark, sf)
    cfg = SearchConfig(space=PROD_SPACE, max_trials=30, max_concurrent=4, experiment="hpo", sweep_name="hpo")
    return random_search(spark, p.data, p.feature_names, R.target, cfg, int_features=p.encoded_columns)


def _search_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Every trial's and sweep's record; a sweep's score must be the best of its trials."""
    runs = _run_search(spark, sf)
    trials, sweeps = runs.where(F.col("run_type") == "trial"), runs.where(F.col("run_type") == "sweep")
    best = trials.groupBy(F.col("parent_run_id").alias("_sweep")).agg(F.max(F.col("metrics")["f1"]).alias("_best"), F.count("*").alias("n_trials"),
                                               F.count_distinct("run_id").alias("n_ids"))
    return sweeps.join(best, F.col("run_id") == F.col("_sweep")).select(
        "model", "n_trials", "n_ids", (F.col("metrics")["score"] == F.col("_best")).alias("score_is_best"))


OOF_FOLDS = 3
OOF_SPACE = {"model_types": ["logreg", "xgboost"], "use_smote": ["false"], "logreg": PROD_SPACE["logreg"],
             "xgboost": {"n_estimators": [10, 20], "max_depth": [3], "learning_rate": [0.1], "reg_lambda": [1.0, 10.0]}}


def _search_out_of_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Trials chosen without the test rows: those are left out of the input, so a trial that asked for one would fail."""
    p = _prepared_stored(spark, sf)
    train = p.data.where(F.col("split") == "train")
    cfg = SearchConfig(space=OOF_SPACE, max_trials=30, max_concurrent=4, experiment="oof", sweep_name="oof", folds=OOF_FOLDS)
    runs = random_search(spark, train, p.feature_names, R.target, cfg, int_features=p.encoded_columns)
    folds = train.select(fold_of(R.id_col, cfg.seed, OOF_FOLDS).alias("fold")).groupBy().agg(
        *[F.count_if(F.col("fold") == f).alias(f"fold_{f}") for f in range(OOF_FOLDS)]).first()
    trials = runs.where(F.col("run_type") == "trial")
    return trials.groupBy("model").agg(
        F.count("*").alias("n_trials"), F.min(F.col("tags")["scored_rows"].cast("long")).alias("scored_rows"),
        F.min(F.col("metrics")["roc_auc"].between(0, 1)).alias("scores_hold")).withColumns(
        {f"fold_{f}": F.lit(folds[f]) for f in range(OOF_FOLDS)})


def _model_queries() -> dict[str, Query]:
    return {
        "train_logreg": _trained_family("logreg"),
        "train_rf": _trained_family("rf"),
        "train_gbt": _trained_family("xgboost"),
        "boosted_stump": _boosted_stump,
        "train_stage": _train_stage,
        "predict": _predict,
        "as_pipeline": _as_pipeline,
        "save_model": _save_load,
        "load_model": _load,
        "score_batch": _score_batch,
        "score_requests": _score_requests,
        "score_stream": _score_stream,
        "random_search": _search_facts,
        "search_out_of_fold": _search_out_of_fold,
        **tracking.queries(_base),
    }


def _parse_requests_query(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = parse_requests(_requests(spark, sf), RAW_FEATURES, RAW_TYPES)
    return rows


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {"score_requests_parse": _parse_requests_query}
    out.update(_model_queries())
    out.update(_source_queries())
    out.update(_metric_queries())
    out.update(_profile_queries())
    out.update(_projection_queries())
    out.update(_prep_queries())
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn rate by region, segment, priorities and activity vs the overall rate."""
    return prof.rate_by_group(_base(spark, sf_dir), RATE_DIMS, R.target)


__all__ = ["queries", "flagship"]
