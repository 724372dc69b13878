"""Run records (the tracking server's role) and model registry as Parquet tables."""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUNS_SCHEMA = (
    "run_id string, parent_run_id string, experiment string, run_name string, run_type string, model string, "
    "params map<string,string>, metrics map<string,double>, tags map<string,string>, logged_at timestamp"
)
MODELS_SCHEMA = "name string, path string, run_id string, created_at timestamp"


def run_id_of(*parts) -> str:
    """The same id for the same run: MD5 of what defines it."""
    return hashlib.md5("|".join(repr(p) for p in parts).encode()).hexdigest()


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def run_row(*, run_id: str, parent_run_id: str | None, experiment: str, run_name: str, run_type: str,
            model: str | None, params: dict | None = None, metrics: dict | None = None, tags: dict | None = None,
            logged_at: _dt.datetime | None = None):
    return (run_id, parent_run_id, experiment, run_name, run_type, model,
            {str(k): _text(v) for k, v in (params or {}).items()},
            {str(k): float(v) for k, v in (metrics or {}).items() if v is not None},
            {str(k): str(v) for k, v in (tags or {}).items()}, logged_at or _now())


def _text(v) -> str | None:
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


def log_runs(spark: SparkSession, rows: list | DataFrame, path: str | None = None) -> DataFrame:
    """Append runs (rows of a training job, or a frame of them) to the runs table; returns them as a frame."""
    df = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows, RUNS_SCHEMA)
    if path:
        df.write.mode("append").parquet(path)
    return df


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(path)


def register_model(spark: SparkSession, registry: str, name: str, path: str, run_id: str,
                   created_at: _dt.datetime | None = None) -> None:
    register_models(spark.createDataFrame([(name, path, run_id, created_at or _now())], MODELS_SCHEMA), registry)


def register_models(models: DataFrame, registry: str) -> None:
    """Append (name, path, run_id, created_at) rows to the registry."""
    models.write.mode("append").parquet(registry)


def latest_artifact(models: DataFrame, name_like: str | None = None, override: str | None = None) -> DataFrame:
    """Newest model path (by created_at; ties by path), unless an explicit path overrides it."""
    if override:
        return models.sparkSession.createDataFrame([(override,)], "path string")
    m = models.where(F.col("name").like(name_like)) if name_like else models
    return m.agg(F.max_by("path", F.struct("created_at", "path")).alias("path"))


def filter_runs(runs: DataFrame, models: list[str], experiment: str | None = None, name_prefix: str | None = None,
                explicit: dict[str, str] | None = None, run_type: str = "sweep") -> DataFrame:
    """One run per model: explicit names first, else the first listed match.

    Matches: type == run_type, experiment ==, run_name starts with prefix, and
    run_name contains '-<model>' or ends with the model name.
    """
    r = runs.where(F.col("run_type") == run_type)
    if experiment:
        r = r.where(F.col("experiment") == experiment)
    explicit = explicit or {}
    rows = []
    for i, m in enumerate(models):
        hit = F.col("run_name").contains(f"-{m}") | F.col("run_name").endswith(m)
        if name_prefix:
            hit = hit & F.col("run_name").startswith(name_prefix)
        if m in explicit:
            hit = hit | (F.col("run_name") == explicit[m])
        rows.append(r.where(hit).select(F.lit(m).alias("for_model"), F.lit(i).alias("_ord"),
                                        (F.col("run_name") == F.lit(explicit.get(m, ""))).alias("_explicit"), "*"))
    if not rows:
        return runs.limit(0)
    u = rows[0]
    for x in rows[1:]:
        u = u.unionByName(x)
    w = Window.partitionBy("for_model").orderBy(F.desc("_explicit"), "logged_at", "run_id")
    return u.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", "_explicit", "_ord")
