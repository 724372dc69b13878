import duckdb

import __spark_entry__ as entry
from churnlab.sources.tables import TABLES

from conftest import SF_SMALL

FAST = ["scan_parquet", "describe", "rate_by_group", "stratified_split", "prepare", "roc_auc", "smote",
        "boxplot_stats", "coerce_literal", "score_requests_parse"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"dimension", "value", "n", "rate", "overall", "diff"}


def test_oracle_keys_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_oracle_agreement_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    q, o = entry.queries(), entry.oracle_sql()
    for k in FAST:
        df = q[k](spark, SF_SMALL)
        cols = sorted(df.columns)
        key = lambda t: tuple((x is None, str(x)) for x in t)
        got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
        res = con.execute(o[k])
        names = [d[0] for d in res.description]
        assert sorted(names) == cols, k
        idx = [names.index(c) for c in cols]
        want = sorted((tuple(r[i] for i in idx) for r in res.fetchall()), key=key)
        assert got == want, k


def test_plans_have_no_cartesian_products(spark):
    q = entry.queries()
    for k in ("stratified_split", "rate_by_group", "cardinality", "describe", "roc_auc", "boxplot_stats",
              "histogram_density", "crosstab", "best_model", "corr_matrix"):
        plan = q[k](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, k


def test_scans_prune_columns_and_push_filters(spark):
    q = entry.queries()
    plan = q["filter_by_class"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(churned), EqualTo(churned,1)]" in plan
    base = q["scan_parquet"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # orders is read once, with only the four columns the features need
    assert base.count("orders.parquet") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in base


def test_split_has_no_single_partition_window(spark):
    plan = entry.queries()["stratified_split"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
