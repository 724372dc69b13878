import pytest
from pyspark.sql import functions as F

from churnlab.functions import scalars as S
from churnlab.plans.search import PROD_SPACE, TEST_SPACE, param_grid, sample_trials


def test_parse_bool(spark):
    df = spark.createDataFrame([(" Yes",), ("off",), (None,), ("1",), ("N",)], "v string")
    assert [r[0] for r in df.select(S.parse_bool(F.col("v"), default=True)).collect()] == [True, False, True, True, False]
    bad = spark.createDataFrame([("maybe",)], "v string")
    with pytest.raises(Exception):
        bad.select(S.parse_bool(F.col("v"))).collect()
    assert bad.select(S.parse_bool(F.col("v"), strict=False)).first()[0] is None
    assert S.parse_bool_value("TRUE", default=False) is True and S.parse_bool_value(None, default=True) is True
    assert S.parse_bool_value(0, default=True) is False
    with pytest.raises(ValueError):
        S.parse_bool_value("maybe", default=False)


def test_coerce_literal_matches_python(spark):
    texts = ["12", "-3", "1.5e3", "2.", ".5", "True", "false", "None", "none", "'abc'", "Customer#1", "x1"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = df.select("v", S.coerce_literal(F.col("v")).alias("c")).collect()
    for r in got:
        py = S.coerce_value(r["v"])
        c = r["c"]
        if py is None:
            assert c["kind"] == "none"
        elif isinstance(py, bool):
            assert c["kind"] == "bool" and c["as_bool"] == py
        elif isinstance(py, int):
            assert c["kind"] == "int" and c["as_long"] == py
        elif isinstance(py, float):
            assert c["kind"] == "float" and c["as_double"] == py
        else:
            assert c["kind"] == "str" and c["as_string"] == py


def test_overrides(spark):
    assert S.parse_override_value("rf.n_estimators=200") == ("rf", "n_estimators", 200)
    assert S.parse_override_value("a.b.c=x=y") == ("a", "b.c", "x=y")
    with pytest.raises(ValueError):
        S.parse_override_value("noequals")
    merged = S.apply_overrides(["rf.max_depth=4", "rf.max_depth=6", "logreg.C=0.5"], {"rf": {"n_estimators": 100}})
    assert merged == {"rf": {"n_estimators": 100, "max_depth": 6}, "logreg": {"C": 0.5}}
    df = spark.createDataFrame([("rf.n_estimators=200",), ("bad",)], "v string")
    rows = df.select(S.parse_override(F.col("v"), strict=False).alias("p")).collect()
    assert tuple(rows[0]["p"]) == ("rf", "n_estimators", "200") and rows[1]["p"] is None


def test_names_and_lists(spark):
    df = spark.createDataFrame([("rf_n_estimators",), ("use_smote",), ("xgboost_max_depth",)], "k string")
    assert [r[0] for r in df.select(S.rename_param(F.col("k"))).collect()] == \
        ["rf.n_estimators", "use_smote", "xgboost.max_depth"]
    a = spark.createDataFrame([(["a", None, "None", " ", "null", "b"],), ([None, "none"],)], "a array<string>")
    assert [r[0] for r in a.select(S.filter_nulls(F.col("a"))).collect()] == [["a", "b"], None]
    m = spark.createDataFrame([({"rf_n_estimators": "200", "use_smote": "true", "logreg_C": "1.0", "other": "x"},
                                "rf")], "p map<string,string>, m string")
    r = m.select(S.strip_param_prefix(F.col("p"), F.col("m")).alias("s")).first()["s"]
    assert r["training"] == {"use_smote": "true"} and r["hyperparameters"] == {"n_estimators": "200", "other": "x"}


def test_grid_sizes_and_sampling():
    g = param_grid(PROD_SPACE)
    assert {m: len(v) for m, v in g.items()} == {"logreg": 8, "rf": 135, "xgboost": 324}
    s = sample_trials(g, 30, 42)
    assert {m: len(v) for m, v in s.items()} == {"logreg": 8, "rf": 30, "xgboost": 30}
    assert sample_trials(g, 30, 42) == s and sample_trials(g, 30, 7) != s
    assert len(param_grid(TEST_SPACE)["logreg"]) == 6
    space = {"use_smote": ["true", None], "logreg": {"C": [None, "none", 1.0]}}
    assert param_grid(space) == {"logreg": [{"use_smote": "true", "logreg_C": 1.0}]}


def test_merge_overrides_last_wins(spark):
    from churnlab.plans.search import config_table, merge_overrides
    base = config_table(spark, {"rf": {"n_estimators": 100, "max_depth": 6}, "logreg": {"C": 1.0}})
    ov = spark.createDataFrame([("t1", 0, "rf", "max_depth", "4"), ("t1", 1, "rf", "max_depth", "8"),
                                ("t1", 2, "rf", "bootstrap", "false"), ("t2", 0, "logreg", "C", "0.1")],
                               "run_id string, ordinal int, model string, param string, value string")
    got = {(r["run_id"], r["param"]): (r["value"], r["source"]) for r in merge_overrides(base, ov).collect()}
    assert got == {("t1", "n_estimators"): ("100", "base"), ("t1", "max_depth"): ("8", "override"),
                   ("t1", "bootstrap"): ("false", "override"), ("t2", "C"): ("0.1", "override")}
