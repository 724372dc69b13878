"""Tracking queries over runs, overrides and registries that are derived from the churn table.

Every customer stands for a trial: its columns give model, parameters, score and
time, so run tables are as large as the data and SQL can repeat them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions import scalars as sc
from churnlab.plans.search import best_trial, best_trials, config_table, export_best, merge_overrides, training_config
from churnlab.session import scratch_path
from churnlab.sources.runs import filter_runs, latest_artifact, log_runs, read_runs, register_models
from churnlab.sources.tables import BASE_CTE

# Fixed values shared with the SQL below.
MODELS = ("logreg", "rf", "xgboost")
CONFIG_TRAINING = {"models": ["xgboost"], "class_weight": "balanced", "random_state": 42, "use_smote": "true"}
CONFIG_HYPER = {"logreg": {"C": 1.0, "max_iter": 1000}, "rf": {"n_estimators": 100, "max_depth": 6},
                "xgboost": {"n_estimators": 200, "learning_rate": 0.05}}
EPOCH = "2024-01-01 00:00:00"
NAME_PREFIX = "a"


def trial_runs(base: DataFrame) -> DataFrame:
    """One trial per customer in the runs schema; sweeps are (region, model)."""
    model = F.element_at(F.array(*[F.lit(m) for m in MODELS]), (F.col("customer_id") % 3 + 1).cast("int"))
    b = base.withColumn("model", model)
    other = F.when(F.col("model") == "rf", "xgboost_max_depth").otherwise("rf_max_depth")
    params = F.map_from_arrays(
        F.array(F.concat("model", F.lit("_n_estimators")), other, F.lit("use_smote"), F.lit("note"), F.lit("empty")),
        F.array(F.col("n_orders").cast("string"), F.col("tenure_years").cast("string"),
                F.when(F.col("is_active") == 1, "true").otherwise("false"), F.col("segment"),
                F.when(F.col("has_urgent") == 1, "None").otherwise("")))
    score = F.when(F.col("avg_price_cents") % 11 != 0, (F.col("avg_price_cents") % 1000) / 1000)
    return b.select(
        F.md5(F.concat(F.lit("trial|"), F.col("customer_id").cast("string"))).alias("run_id"),
        F.md5(F.concat(F.lit("sweep|"), "region", F.lit("|"), "model")).alias("parent_run_id"),
        F.col("segment").alias("experiment"), F.concat(F.lower("region"), F.lit("-"), "model").alias("run_name"),
        F.lit("trial").alias("run_type"), "model", params.alias("params"),
        F.map_from_arrays(F.array(F.lit("f1")), F.array(score)).alias("metrics"),
        F.map_from_arrays(F.array(F.lit("trial")), F.array(F.col("customer_id").cast("string"))).alias("tags"),
        (F.lit(EPOCH).cast("timestamp") + F.make_dt_interval(secs=F.col("customer_id"))).alias("logged_at"))


def _log_run(spark: SparkSession, base: DataFrame) -> DataFrame:
    """Two jobs append their trials; what the store then holds."""
    path, runs = scratch_path(spark, "runs"), trial_runs(base)
    log_runs(spark, runs.where("model = 'rf'"), path)
    log_runs(spark, runs.where("model <> 'rf'"), path)
    return read_runs(spark, path).select("run_id", "parent_run_id", "experiment", "run_name", "run_type", "model",
                                         F.col("metrics")["f1"].alias("f1"), F.size("params").alias("n_params"),
                                         F.unix_timestamp("logged_at").alias("logged_at"))


def _params(base: DataFrame) -> DataFrame:
    rows = trial_runs(base).select("run_id", F.explode("params").alias("key", "value"))
    return rows.where(~sc.is_null_word(F.col("value")))


def _rename(spark: SparkSession, base: DataFrame) -> DataFrame:
    return _params(base).select("run_id", "key", sc.rename_param(F.col("key")).alias("override_key"), "value")


def _override(spark: SparkSession, base: DataFrame) -> DataFrame:
    """Each trial's parameters as override texts, the model's own key given twice: the last one wins."""
    rows = _rename(spark, base).where(F.col("override_key").contains("."))
    texts = rows.select("run_id", F.explode(F.array(
        F.struct(F.lit(0).alias("ordinal"), F.concat("override_key", F.lit("=old="), "value").alias("text")),
        F.struct(F.lit(1).alias("ordinal"), F.concat("override_key", F.lit("="), "value").alias("text")))).alias("o"))
    parsed = texts.select("run_id", "o.ordinal", sc.parse_override(F.col("o.text")).alias("p")).select(
        "run_id", "ordinal", "p.model", "p.param", "p.value")
    return merge_overrides(config_table(spark, CONFIG_HYPER), parsed)


def _strip(spark: SparkSession, base: DataFrame) -> DataFrame:
    parts = trial_runs(base).select("run_id", sc.strip_param_prefix(F.col("params"), F.col("model")).alias("c"))
    each = [parts.select("run_id", F.lit(n).alias("part"), F.explode(f"c.{n}").alias("key", "value"))
            for n in ("training", "hyperparameters")]
    return each[0].unionByName(each[1])


def _filter_nulls(spark: SparkSession, base: DataFrame) -> DataFrame:
    odd = F.col("customer_id") % 4
    values = F.array(F.when(odd == 0, " None ").when(odd == 1, "null").when(odd == 2, "  "),
                     F.when(F.col("is_active") == 1, F.col("segment")), F.lit(""),
                     F.when(F.col("has_urgent") == 1, F.col("region")).otherwise("NONE"))
    return base.select("customer_id", F.array_join(sc.filter_nulls(values), "|").alias("kept"))


def _latest(spark: SparkSession, base: DataFrame) -> DataFrame:
    """Models registered by two jobs; the newest of those whose name fits."""
    registry = scratch_path(spark, "registry")
    models = base.select(F.concat(F.lit("model-"), F.lower("segment")).alias("name"),
                         F.concat(F.lit("models/"), F.col("customer_id").cast("string")).alias("path"),
                         F.md5(F.col("customer_id").cast("string")).alias("run_id"),
                         (F.lit(EPOCH).cast("timestamp") + F.make_dt_interval(secs=F.col("avg_price_cents") % 5000)).alias("created_at"))
    for part in (0, 1):
        register_models(models.where(F.length("path") % 2 == part), registry)
    return latest_artifact(spark.read.parquet(registry), name_like="model-b%")


def _best(spark: SparkSession, base: DataFrame) -> DataFrame:
    runs = trial_runs(base)
    winner = best_trial(runs).select(F.col("run_id").alias("_w"))
    return best_trials(runs).join(F.broadcast(winner), F.col("run_id") == F.col("_w"), "left").select(
        "parent_run_id", "model", "run_id", "score", F.col("_w").isNotNull().alias("winner"))


def queries(base_of: Callable[[SparkSession, str], DataFrame]) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    on = lambda f: lambda s, sf: f(s, base_of(s, sf))
    return {
        "log_run": on(_log_run), "rename_param": on(_rename), "parse_override": on(_override), "strip_param_prefix": on(_strip),
        "filter_nulls": on(_filter_nulls), "latest_artifact": on(_latest), "best_trial": on(_best),
        "filter_runs": on(lambda s, b: filter_runs(trial_runs(b), list(MODELS), "BUILDING", NAME_PREFIX, run_type="trial")
                          .select("for_model", "run_id", "run_name", "experiment")),
        "export_best": on(lambda s, b: export_best(best_trial(trial_runs(b)), training_config(s, CONFIG_TRAINING, CONFIG_HYPER))),
    }


# --- SQL ---------------------------------------------------------------------------------------------------------

_RUNS = f"""WITH {BASE_CTE},
m AS (SELECT *, CASE customer_id % 3 WHEN 0 THEN 'logreg' WHEN 1 THEN 'rf' ELSE 'xgboost' END AS model FROM base),
runs AS (SELECT *, md5('trial|' || customer_id) AS run_id, md5('sweep|' || region || '|' || model) AS parent_run_id,
  lower(region) || '-' || model AS run_name,
  CASE WHEN avg_price_cents % 11 <> 0 THEN (avg_price_cents % 1000) / 1000.0::DOUBLE END AS f1 FROM m),
params AS (
  SELECT run_id, model, model || '_n_estimators' AS key, CAST(n_orders AS VARCHAR) AS value FROM runs
  UNION ALL SELECT run_id, model, CASE model WHEN 'rf' THEN 'xgboost_max_depth' ELSE 'rf_max_depth' END,
    CAST(tenure_years AS VARCHAR) FROM runs
  UNION ALL SELECT run_id, model, 'use_smote', CASE is_active WHEN 1 THEN 'true' ELSE 'false' END FROM runs
  UNION ALL SELECT run_id, model, 'note', segment FROM runs
  UNION ALL SELECT run_id, model, 'empty', CASE has_urgent WHEN 1 THEN 'None' ELSE '' END FROM runs),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY parent_run_id ORDER BY f1 DESC, customer_id) AS nth
  FROM runs WHERE f1 IS NOT NULL) WHERE nth = 1),
winner AS (SELECT * FROM best ORDER BY f1 DESC, CASE model WHEN 'rf' THEN 1 WHEN 'logreg' THEN 2 ELSE 3 END, customer_id, run_id
  LIMIT 1)
"""
_HYPER_ROWS = ", ".join(f"('{m}', '{k}', '{v}')" for m, ps in CONFIG_HYPER.items() for k, v in ps.items())
_CONFIG_ROWS = ", ".join(
    [f"('training', '{k}', '{'[' + ','.join(v) + ']' if isinstance(v, list) else v}')" for k, v in CONFIG_TRAINING.items()]
    + [f"('hyperparameters.{m}', '{k}', '{v}')" for m, ps in CONFIG_HYPER.items() for k, v in ps.items()])
_STRIPPED = """SELECT run_id, 'training' AS part, key, value FROM params WHERE key = 'use_smote'
UNION ALL SELECT run_id, 'hyperparameters', 'n_estimators', value FROM params WHERE key LIKE '%_n_estimators'
UNION ALL SELECT run_id, 'hyperparameters', key, value FROM params WHERE key IN ('note', 'empty')"""


def oracle_sql() -> dict[str, str]:
    return {
        "log_run": _RUNS + f"""SELECT run_id, parent_run_id, segment AS experiment, run_name, 'trial' AS run_type, model, f1,
  5 AS n_params, CAST(epoch(TIMESTAMP '{EPOCH}') AS BIGINT) + customer_id AS logged_at FROM runs""",
        "rename_param": _RUNS + """SELECT run_id, key, CASE WHEN key IN ('note', 'use_smote') THEN key
  ELSE split_part(key, '_', 1) || '.' || substr(key, strpos(key, '_') + 1) END AS override_key, value
FROM params WHERE key <> 'empty'""",
        "parse_override": _RUNS + f""", base_config(model, param, value) AS (VALUES {_HYPER_ROWS}),
ov AS (SELECT run_id, split_part(key, '_', 1) AS model, substr(key, strpos(key, '_') + 1) AS param, value FROM params
  WHERE key LIKE '%_n_estimators' OR key LIKE '%_max_depth')
SELECT run_id, model, param, value, 'override' AS source FROM ov
UNION ALL SELECT r.run_id, c.model, c.param, c.value, 'base' FROM (SELECT DISTINCT run_id, model FROM ov) r
  JOIN base_config c USING (model) WHERE NOT EXISTS (
    SELECT 1 FROM ov WHERE ov.run_id = r.run_id AND ov.model = c.model AND ov.param = c.param)""",
        "strip_param_prefix": _RUNS + _STRIPPED,
        "filter_nulls": f"""WITH {BASE_CTE} SELECT customer_id, nullif(concat_ws('|',
  CASE is_active WHEN 1 THEN segment END, CASE has_urgent WHEN 1 THEN region END), '') AS kept FROM base""",
        "latest_artifact": f"""WITH {BASE_CTE} SELECT 'models/' || customer_id AS path FROM base WHERE lower(segment) LIKE 'b%'
ORDER BY avg_price_cents % 5000 DESC, 'models/' || customer_id DESC LIMIT 1""",
        "best_trial": _RUNS + """SELECT best.parent_run_id, best.model, best.run_id, best.f1 AS score,
  best.run_id = winner.run_id AS winner FROM best, winner""",
        "filter_runs": _RUNS + f"""SELECT model AS for_model, run_id, run_name, segment AS experiment FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY customer_id) AS nth FROM runs
  WHERE segment = 'BUILDING' AND run_name LIKE '{NAME_PREFIX}%') WHERE nth = 1""",
        "export_best": _RUNS + f""", config(section, key, value) AS (VALUES {_CONFIG_ROWS}),
laid AS (SELECT 'training' AS section, 'models' AS key, '[' || model || ']' AS value FROM winner
  UNION ALL SELECT CASE part WHEN 'training' THEN 'training' ELSE 'hyperparameters.' || w.model END, s.key, s.value
  FROM ({_STRIPPED}) s JOIN winner w USING (run_id))
SELECT * FROM laid UNION ALL SELECT * FROM config c WHERE NOT EXISTS (
  SELECT 1 FROM laid WHERE laid.section = c.section AND laid.key = c.key)""",
    }
