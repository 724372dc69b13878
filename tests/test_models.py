import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from churnlab import catalog
from churnlab.operators.metrics import roc_auc
from churnlab.plans.models import apply_hyperparameters, get_model, models_to_train, without_effect
from churnlab.plans.prepare import PrepOptions, prepare
from churnlab.plans.scoring import as_pipeline, requests_from_rows, respond, score_batch, score_requests
from churnlab.plans.search import SearchConfig, TEST_SPACE, best_trial, export_best, random_search, training_config
from churnlab.plans.train import TrainConfig, fit_model, load_model, save_model, train_stage, with_probability
from churnlab.sources.tables import BASE_SCHEMA, base_table
from churnlab.streaming.score_stream import score_stream

from conftest import SF_SMALL

FEATS = ["region", "segment", "acct_balance", "n_orders", "n_priorities", "avg_price_cents", "tenure_years",
         "has_urgent", "is_active"]


def test_factory_and_hyperparameters(spark):
    with pytest.raises(ValueError, match="no model called"):
        get_model("svm")
    spec, applied = apply_hyperparameters(get_model("rf"), {"min_samples_split": 1, "bogus": 3, "n_estimators": 7})
    assert applied == {"min_samples_split": 2, "n_estimators": 7} and spec.params["n_estimators"] == 7
    est = get_model("rf").estimator("f", "y", None)
    assert est.getMinInstancesPerNode() == 5 and est.getFeatureSubsetStrategy() == "sqrt"
    deep, _ = apply_hyperparameters(get_model("rf"), {"max_depth": 100})
    assert deep.estimator("f", "y", None).getMaxDepth() == 30
    assert without_effect(deep, {"max_depth": 100}) == {"max_depth_used": "30"}
    odd, applied = apply_hyperparameters(get_model("xgboost"), {"gamma": 0.5, "min_child_weight": 3, "reg_lambda": 2, "tree_method": "hist"})
    assert applied == {"gamma": 0.5, "min_child_weight": 3, "reg_lambda": 2}
    boost = odd.estimator("f", "y", None).boost
    assert (boost.gamma, boost.min_child_weight, boost.reg_lambda, boost.colsample_bytree) == (0.5, 3.0, 2.0, 0.8)
    assert without_effect(odd, {"gamma": 0.5, "tree_method": "hist"}) == {"ignored": "tree_method"}
    whole, _ = apply_hyperparameters(get_model("xgboost"), {"colsample_bytree": 1, "max_depth": 40})
    assert whole.boost_params().colsample_bytree == 1.0 and without_effect(whole, {"max_depth": 40}) == {}
    assert models_to_train("rf", {"models": ["logreg"]}) == ["rf"]
    assert models_to_train(None, {"models": ["logreg"]}) == ["logreg"]
    assert models_to_train(None, {}) == ["logreg", "rf", "xgboost"]


def _synthetic(spark, shuffle=False, n=400):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int)
    if shuffle:
        y = rng.permutation(y)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["y"] = y
    pdf["id"] = range(n)
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("shuffle,lo,hi", [(False, 0.9, 1.01), (True, 0.35, 0.65)])
def test_logreg_quality(spark, shuffle, lo, hi):
    df = _synthetic(spark, shuffle)
    model, _ = fit_model("logreg", df, ["a", "b", "c"], "y", "balanced", 42, {})
    auc = roc_auc(with_probability(model.transform(df)), "y", "p1").first()[0]
    assert lo < auc < hi


@pytest.mark.parametrize("name", ["logreg", "rf"])
def test_models_score_after_the_session_observed_something(spark, name):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    df = spark.range(0, 140, 1, 2).select((F.col("id") % 7).cast("double").alias("a"), ((F.col("id") % 7) > 3).cast("int").alias("y"))
    model, _ = fit_model(name, df, ["a"], "y", "balanced", 42, {"n_estimators": 3} if name == "rf" else {})
    assert all(r.prediction == r.y for r in with_probability(model.transform(df)).select("y", "prediction").collect())


@pytest.mark.parametrize("name,facts", [("predict", ["is_probability", "label_follows"]), ("as_pipeline", ["same"]),
                                        ("load_model", ["same_label"]), ("score_batch", ["is_probability", "label_follows"])])
def test_serving_queries_after_the_session_observed_something(spark, name, facts):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = catalog.queries()[name](spark, SF_SMALL).collect()
    assert rows and all(r[f] for r in rows for f in facts)


def test_train_stage_save_load_and_scoring(spark, tmp_dir):
    p = prepare(base_table(spark, SF_SMALL), PrepOptions())
    cfg = TrainConfig(models=["logreg", "rf"], use_smote="true",
                      hyperparameters={"rf": {"n_estimators": 10, "max_depth": 4}})
    res = train_stage(spark, p.data, p.feature_names, "churned", cfg, int_features=p.encoded_columns)
    runs = {r["run_type"]: r for r in res.runs.collect()}
    assert runs["parent"]["params"]["use_smote"] == "true"
    assert "best_model_f1" in runs["parent"]["metrics"]
    assert res.best in ("logreg", "rf")
    pipe = as_pipeline(p.encoder, p.scaler_params, p.feature_names, res.best_model)
    raw = base_table(spark, SF_SMALL)
    a = score_batch(pipe, raw, ["customer_id"])
    path = save_model(pipe, os.path.join(tmp_dir, "model"))
    b = score_batch(load_model(path), raw, ["customer_id"])
    assert a.exceptAll(b).count() == 0
    # the same rows scored through the prepared features give the same labels (no train/serve skew)
    direct = with_probability(res.best_model.transform(p.data)).select("customer_id", "prediction")
    assert a.select("customer_id", "prediction").exceptAll(direct).count() == 0
    reqs = requests_from_rows(raw.withColumn("g", F.floor(F.col("customer_id") / 4)), "customer_id", FEATS, "g")
    types = {f.name: f.dataType.simpleString() for f in BASE_SCHEMA.fields}
    via_req = score_requests(pipe, reqs, FEATS, types).select(F.col("index").alias("customer_id"), "prediction")
    import json
    answers = {r["request_id"]: json.loads(r["response"]) for r in respond(score_requests(pipe, reqs, FEATS, types)).collect()}
    assert sum(len(a["predictions"]) for a in answers.values()) == raw.count()
    assert all(a["index"] == sorted(a["index"]) for a in answers.values())
    assert via_req.exceptAll(a.select("customer_id", "prediction")).count() == 0
    src = os.path.join(tmp_dir, "req")
    reqs.write.json(src)
    streamed = score_stream(spark, pipe, src, os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ck"), FEATS, types)
    assert streamed.drop("batch_id").exceptAll(score_requests(pipe, reqs, FEATS, types)).count() == 0
    with pytest.raises(FileNotFoundError):
        load_model(os.path.join(tmp_dir, "nope"))


def test_search_best_and_export(spark):
    p = prepare(base_table(spark, SF_SMALL), PrepOptions())
    space = {"model_types": ["logreg"], "use_smote": ["false"], "logreg": TEST_SPACE["logreg"]}
    trials = random_search(spark, p.data, p.feature_names, "churned",
                           SearchConfig(space=space, max_trials=3, max_concurrent=2, sweep_name="t"),
                           int_features=p.encoded_columns)
    assert trials.where("run_type = 'trial'").count() == 3 and trials.where("run_type = 'sweep'").count() == 1
    best = best_trial(trials).collect()
    assert len(best) == 1
    scores = [r["metrics"]["f1"] for r in trials.where("run_type = 'trial'").collect()]
    assert best[0]["score"] == max(scores)
    base = training_config(spark, {"models": ["rf"], "use_smote": "true", "random_state": 7}, {"rf": {"max_depth": 3}})
    cfg = {(r["section"], r["key"]): r["value"] for r in export_best(best_trial(trials), base).collect()}
    assert cfg[("training", "random_state")] == "7" and cfg[("hyperparameters.rf", "max_depth")] == "3"
    assert cfg[("training", "models")] == "[logreg]" and cfg[("training", "use_smote")] == "false"
    assert ("hyperparameters.logreg", "C") in cfg


def test_stream_restarts_from_checkpoint(spark, tmp_dir):
    """A second availableNow run only scores files that arrived after the first (checkpointed progress)."""
    from churnlab.plans.train import fit_model as _fit
    p = prepare(base_table(spark, SF_SMALL), PrepOptions())
    model, _ = _fit("logreg", p.data.where("split = 'train'"), p.feature_names, "churned", "balanced", 42, {})
    pipe = as_pipeline(p.encoder, p.scaler_params, p.feature_names, model)
    raw = base_table(spark, SF_SMALL).withColumn("g", F.floor(F.col("customer_id") / 4))
    reqs = requests_from_rows(raw, "customer_id", FEATS, "g")
    types = {f.name: f.dataType.simpleString() for f in BASE_SCHEMA.fields}
    src, sink, ck = (os.path.join(tmp_dir, x) for x in ("src", "sink", "ck"))
    reqs.where("request_id < 10").write.json(src + "/a")
    first = score_stream(spark, pipe, src + "/*", sink, ck, FEATS, types)
    n1 = first.count()
    reqs.where("request_id >= 10").write.json(src + "/b")
    second = score_stream(spark, pipe, src + "/*", sink, ck, FEATS, types)
    assert second.count() == raw.count() and n1 < second.count()
    assert second.select("request_id", "index").distinct().count() == second.count()  # no batch scored twice


def test_unseen_category_is_rejected_not_fatal(spark):
    from churnlab.plans.scoring import score_requests as _score
    p = prepare(base_table(spark, SF_SMALL), PrepOptions())
    model, _ = fit_model("logreg", p.data.where("split = 'train'"), p.feature_names, "churned", "balanced", 42, {})
    pipe = as_pipeline(p.encoder, p.scaler_params, p.feature_names, model)
    body = ('{"input_data": {"columns": ' + str(FEATS).replace("'", '"') + ', "index": [1, 2], "data": ['
            '["ATLANTIS", "BUILDING", 1.0, 3, 2, 100, 4, 0, 1], ["ASIA", "BUILDING", 1.0, 3, 2, 100, 4, 0, 1]]}}')
    reqs = spark.createDataFrame([(9, body)], "request_id long, body string")
    types = {f.name: f.dataType.simpleString() for f in BASE_SCHEMA.fields}
    scored, rejects = _score(pipe, reqs, FEATS, types, with_rejects=True)
    assert [r["index"] for r in scored.collect()] == [2]
    assert [(r["index"], r["reason"]) for r in rejects.collect()] == [(1, "unseen categories: region")]


def test_an_encoder_of_500000_values_serves_without_a_list_of_labels(spark, tmp_dir):
    from churnlab.plans.encoding import TableEncoderModel

    encoder = spark.range(500_000).select(F.lit("region").alias("column_name"), F.concat(F.lit("v"), "id").alias("value"),
                                          F.col("id").cast("int").alias("code"))
    train = spark.createDataFrame([(float(i % 7), float(i % 2), i % 2) for i in range(60)], "region double, n double, y int")
    trained, _ = fit_model("logreg", train, ["region", "n"], "y", None, 1, {})
    pipe = load_model(save_model(as_pipeline(encoder, {"n": (0.5, 2.0)}, ["region", "n"], trained), os.path.join(tmp_dir, "wide")))
    assert isinstance(pipe.stages[0], TableEncoderModel)
    body = '{"input_data": {"columns": ["region", "n"], "index": [1, 2, 3], "data": [["v499999", 1], ["v7", 0], ["never", 1]]}}'
    reqs = spark.createDataFrame([(9, body)], "request_id long, body string")
    scored, rejects = score_requests(pipe, reqs, ["region", "n"], {"region": "string", "n": "double"}, with_rejects=True)
    assert len(scored._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert sorted(r["index"] for r in scored.collect()) == [1, 2]
    assert [(r["index"], r["reason"]) for r in rejects.collect()] == [(3, "unseen categories: region")]
    with pytest.raises(Exception, match="not fitted on"):
        score_batch(pipe, spark.createDataFrame([("never", 1.0)], "region string, n double"), ["n"]).collect()
