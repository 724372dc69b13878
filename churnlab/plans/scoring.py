"""Scoring: one fitted pipeline (encode + scale + assemble + classifier) applied to raw rows or JSON requests.

The reference's endpoint received encoded-but-unscaled rows for a model
fitted on scaled data; here the saved object is the whole pipeline, so a
request carries raw values and cannot skew from training.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.plans.encoding import INDEX_SUFFIX, TableEncoderModel

REQUEST_SCHEMA = T.StructType([T.StructField("input_data", T.StructType([
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("index", T.ArrayType(T.LongType())),
    T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
]))])
PREP_SUFFIX = "__prep"


def as_pipeline(encoder: DataFrame, scaler_params: dict[str, tuple[float, float]], feature_names: list[str],
                trained: PipelineModel) -> PipelineModel:
    """Raw rows in, label + probability out: the encoder table (``TableEncoderModel``), a SQL projection
    that scales with the fitted moments, the assembler and the fitted classifier."""
    encoded = {r["column_name"] for r in encoder.select("column_name").distinct().collect()}
    encoded_names = [f for f in feature_names if f in encoded]
    exprs = []
    for f in feature_names:
        if f in encoded:
            exprs.append(f"`{f}{INDEX_SUFFIX}` AS `{f}{PREP_SUFFIX}`")
        elif f in scaler_params:
            m, s = scaler_params[f]
            exprs.append(f"(CAST(`{f}` AS DOUBLE) - CAST({float(m)!r} AS DOUBLE)) / CAST({float(s)!r} AS DOUBLE) "
                         f"AS `{f}{PREP_SUFFIX}`")
        else:
            exprs.append(f"CAST(`{f}` AS DOUBLE) AS `{f}{PREP_SUFFIX}`")
    stages = [TableEncoderModel(encoded_names, encoder),
              SQLTransformer(statement="SELECT *, " + ", ".join(exprs) + " FROM __THIS__"),
              VectorAssembler(inputCols=[f + PREP_SUFFIX for f in feature_names], outputCol="features",
                              handleInvalid=trained.stages[0].getHandleInvalid()),
              trained.stages[-1]]
    return PipelineModel(stages=stages)


def score_batch(model: PipelineModel, rows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., prediction int, probability double)."""
    out = model.transform(rows)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability"))


def requests_from_rows(rows: DataFrame, id_col: str, columns: list[str], group_col: str) -> DataFrame:
    """Build request payloads {"input_data": {columns, index, data}} from table rows, one per ``group_col``."""
    vals = F.array(*[F.col(c).cast("string") for c in columns])
    g = rows.groupBy(group_col).agg(F.sort_array(F.collect_list(F.struct(F.col(id_col).alias("i"), vals.alias("d"))))
                                    .alias("_rows"))
    body = F.to_json(F.struct(F.struct(F.array(*[F.lit(c) for c in columns]).alias("columns"),
                                       F.col("_rows.i").alias("index"), F.col("_rows.d").alias("data"))
                              .alias("input_data")))
    return g.select(F.col(group_col).alias("request_id"), body.alias("body"))


def parse_requests(requests: DataFrame, required: list[str], types: dict[str, str],
                   body_col: str = "body") -> tuple[DataFrame, DataFrame]:
    """JSON split payloads -> (rows, rejects).

    rows: (request_id, index, required columns cast to their types), one per data element.
    rejects: (request_id, index, reason). A whole request is rejected (index null) when it is
    malformed JSON / not an object or lacks a required column; a single row when a value is
    missing or does not cast to its column type. Bad input never fails the job.
    """
    p = requests.withColumn("_p", F.from_json(F.col(body_col), REQUEST_SCHEMA))
    is_obj = F.trim(F.col(body_col)).startswith("{")
    cols = F.col("_p.input_data.columns")
    missing = F.filter(F.array(*[F.lit(c) for c in required]), lambda c: ~F.array_contains(cols, c))
    reason = (F.when(~is_obj | F.col("_p").isNull() | F.col("_p.input_data").isNull(), F.lit("malformed"))
              .when(cols.isNull() | F.col("_p.input_data.data").isNull(), F.lit("malformed"))
              .when(F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.array_join(missing, ","))))
    checked = p.withColumn("_reason", reason)
    bad_requests = checked.where(F.col("_reason").isNotNull()).select(
        "request_id", F.lit(None).cast("bigint").alias("index"), F.col("_reason").alias("reason"))
    good = checked.where(F.col("_reason").isNull())
    rows = good.select("request_id", "_p.input_data.columns", "_p.input_data.index",
                       F.posexplode("_p.input_data.data").alias("_pos", "_vals"))
    idx = F.coalesce(F.try_element_at(F.col("index"), (F.col("_pos") + 1).cast("int")), F.col("_pos").cast("bigint"))
    values = [F.try_element_at(F.col("_vals"), F.array_position(F.col("columns"), c).cast("int"))
              .try_cast(types.get(c, "string")).alias(c) for c in required]
    parsed = rows.select("request_id", idx.alias("index"), *values)
    invalid = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda x: x.isNotNull())
    parsed = parsed.withColumn("_bad", invalid)
    bad_rows = parsed.where(F.size("_bad") > 0).select(
        "request_id", "index", F.concat(F.lit("invalid values: "), F.array_join("_bad", ",")).alias("reason"))
    out = parsed.where(F.size("_bad") == 0).drop("_bad")
    return out, bad_requests.unionByName(bad_rows)


def split_unseen(model: PipelineModel, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scorable rows, rejects for rows with a category the model never saw) -- instead of a failed job."""
    tagged = rows
    for stage in model.stages:
        if isinstance(stage, TableEncoderModel):
            tagged = stage.marked(rows, "_unseen")
    if tagged is rows:
        return rows, rows.limit(0).select("request_id", "index", F.lit("").alias("reason"))
    rejects = tagged.where(F.size("_unseen") > 0).select(
        "request_id", "index", F.concat(F.lit("unseen categories: "), F.array_join("_unseen", ",")).alias("reason"))
    return tagged.where(F.size("_unseen") == 0).drop("_unseen"), rejects


def score_requests(model: PipelineModel, requests: DataFrame, required: list[str], types: dict[str, str],
                   with_rejects: bool = False):
    """Scored rows (request_id, index, prediction, probability); optionally also every reject."""
    rows, rejects = parse_requests(requests, required, types)
    ok, unseen = split_unseen(model, rows)
    scored = score_batch(model, ok, ["request_id", "index"])
    return (scored, rejects.unionByName(unseen)) if with_rejects else scored


def respond(scored: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """One JSON answer per request: predictions in request index order and, with ``rejects``, what was refused and why.

    A request holds a few rows; one that was refused as a whole has no
    predictions and a single reject without an index.
    """
    rows = scored.select("request_id", F.struct("index", "prediction", "probability").alias("_ok"),
                         F.lit(None).cast("struct<index:bigint,reason:string>").alias("_bad"))
    if rejects is not None:
        rows = rows.unionByName(rejects.select("request_id", F.lit(None).cast(rows.schema["_ok"].dataType).alias("_ok"),
                                               F.struct("index", "reason").alias("_bad")))
    g = rows.groupBy("request_id").agg(F.sort_array(F.collect_list("_ok")).alias("_r"), F.sort_array(F.collect_list("_bad")).alias("_x"))
    fields = [F.col("_r.index").alias("index"), F.col("_r.prediction").alias("predictions"),
              F.col("_r.probability").alias("probabilities")]
    if rejects is not None:
        fields.append(F.col("_x").alias("rejected"))
    return g.select("request_id", F.to_json(F.struct(*fields)).alias("response"))
