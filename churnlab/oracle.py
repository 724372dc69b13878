"""DuckDB oracle SQL for each registered key (views of the test tables are pre-registered)."""

from __future__ import annotations

from churnlab import tracking
from churnlab.catalog import (
    CROSSTAB_DIMS, FLAG_WORDS, HEAD_N, HIGH_CARD_THRESHOLD, OOF_FOLDS, OOF_SPACE, RATE_DIMS, RAW_FEATURES, REQUEST_GROUP, SCORERS, SEED, SMOTE_K, STUMP,
    STUMP_FEATURES, TEST_SIZE, THRESHOLD,
)
from churnlab.functions.hashing import sql_hash, sql_uniform
from churnlab.plans.search import PROD_SPACE
from churnlab.sources.tables import BASE_CTE, ROLES

R = ROLES
BASE_COLUMNS = [
    ("customer_id", "bigint"), ("name", "string"), ("region", "string"), ("segment", "string"),
    ("acct_balance", "double"), ("n_orders", "bigint"), ("n_priorities", "bigint"),
    ("avg_price_cents", "bigint"), ("tenure_years", "bigint"), ("has_urgent", "int"),
    ("is_active", "int"), ("churned", "int"),
]
FEATURES = ["region", "segment", "acct_balance", "n_orders", "n_priorities", "avg_price_cents",
            "tenure_years", "has_urgent", "is_active"]
SCALED = [f for f in FEATURES if f not in ROLES.categorical]


UNION_SQL = ("SELECT * FROM base WHERE churned = 1 UNION ALL SELECT " + ", ".join(
    "CAST(NULL AS DOUBLE) AS acct_balance" if c == "acct_balance" else c for c, _ in BASE_COLUMNS)
    + " FROM base WHERE churned = 0")


def w(sql: str) -> str:
    return f"WITH {BASE_CTE}\n{sql}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _r(x: str) -> str:
    return f"ROUND({x}, 6)"


def _corr(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    xa = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END"
    xb = f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
    den = f"(STDDEV_POP({xa}) * STDDEV_POP({xb}))"
    return f"CASE WHEN {den} > 0 THEN COVAR_POP({xa}, {xb}) / {den} END"


def profile_sql() -> dict[str, str]:
    cols = [c for c, _ in BASE_COLUMNS]
    num = list(R.numeric)
    t = R.target
    out = {}
    out["scan_parquet"] = w("SELECT * FROM base")
    out["profile_info"] = w(_union([
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, COUNT({c}) AS non_null, '{ty}' AS dtype FROM base"
        for i, (c, ty) in enumerate(BASE_COLUMNS)]))
    desc = []
    for c in cols:
        if c not in ("customer_id", "acct_balance", "n_orders", "n_priorities", "avg_price_cents",
                     "tenure_years", "has_urgent", "is_active", "churned"):
            continue
        x = f"CAST({c} AS DOUBLE)"
        desc.append(
            f"SELECT '{c}' AS column_name, COUNT({x}) AS count, {_r(f'AVG({x})')} AS mean, {_r(f'STDDEV_SAMP({x})')} AS std, "
            f"{_r(f'MIN({x})')} AS min, {_r(f'QUANTILE_CONT({x}, 0.25)')} AS q25, {_r(f'QUANTILE_CONT({x}, 0.5)')} AS q50, "
            f"{_r(f'QUANTILE_CONT({x}, 0.75)')} AS q75, {_r(f'MAX({x})')} AS max FROM base")
    out["describe"] = w(_union(desc))
    moments = [(c, f"CAST({c} AS DOUBLE)") for c in ROLES.numeric]
    out["merged_profile"] = w(_union([
        f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT({x}) AS n, {_r(f'AVG({x})')} AS mean, {_r(f'STDDEV_SAMP({x})')} AS std, "
        f"{_r(f'MIN({x})')} AS min, {_r(f'MAX({x})')} AS max, TRUE AS quartiles_hold, TRUE AS distinct_holds FROM base"
        for c, x in moments]))
    out["null_counts"] = w(f", u AS ({UNION_SQL})\nSELECT * FROM (" + _union([
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM u"
        for c, _ in BASE_COLUMNS]) + ") z WHERE n_null > 0")
    out["duplicate_count"] = w("SELECT COUNT(*) AS n_duplicates FROM base WHERE customer_id % 7 = 0")
    card = _union([
        f"SELECT '{c}' AS column_name, COUNT(DISTINCT CAST({c} AS VARCHAR)) AS unique_count, "
        f"{_r(f'COUNT(DISTINCT CAST({c} AS VARCHAR)) / COUNT(*)')} AS unique_ratio, '{ty}' AS dtype FROM base"
        for c, ty in BASE_COLUMNS])
    out["cardinality"] = w(card)
    out["drop_high_cardinality"] = w(f"SELECT column_name FROM ({card}) WHERE unique_ratio > {HIGH_CARD_THRESHOLD}")
    out["value_counts"] = w("SELECT segment AS value, COUNT(*) AS count FROM base WHERE segment IS NOT NULL "
                            "GROUP BY segment ORDER BY count DESC, value")
    out["share_of_total"] = w(f"SELECT {t} AS label, COUNT(*) AS count, "
                              f"{_r('COUNT(*) / SUM(COUNT(*)) OVER ()')} AS share FROM base GROUP BY {t} ORDER BY label")
    out["churn_rate"] = w(f"SELECT COUNT(*) AS n, CAST(SUM({t}) AS BIGINT) AS n_positive, "
                          f"{_r(f'AVG(CAST({t} AS DOUBLE))')} AS rate FROM base")
    out["rate_by_group"] = w(_rate_sql(RATE_DIMS))
    out["sort_values"] = w(_rate_sql(["region"]) + " ORDER BY rate, value")
    out["crosstab"] = w(_union([
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, COUNT(*) FILTER (WHERE {t} = 0) AS n_0, "
        f"COUNT(*) FILTER (WHERE {t} = 1) AS n_1 FROM base WHERE {d} IS NOT NULL GROUP BY {d}" for d in CROSSTAB_DIMS]))
    out["class_counts"] = w(f"SELECT COUNT(*) FILTER (WHERE {t} = 1) AS positives, "
                            f"COUNT(*) FILTER (WHERE {t} = 0) AS negatives FROM base")
    out["histogram_density"] = w(_hist_sql(num, True))
    out["histogram_count"] = w(_hist_sql(["tenure_years"], False))
    out["boxplot_stats"] = w(_box_sql(num))
    corr = R.correlation
    pairs = []
    for i, a in enumerate(corr):
        for b in corr[i:]:
            pairs.append(f"SELECT '{a}' AS a, '{b}' AS b, {_r(_corr(a, b))} AS r FROM base")
            if a != b:
                pairs.append(f"SELECT '{b}' AS a, '{a}' AS b, {_r(_corr(a, b))} AS r FROM base")
    out["corr_matrix"] = w(_union(pairs))
    out["target_corr"] = w(_union([f"SELECT '{c}' AS feature, {_r(_corr(c, t))} AS r FROM base" for c in corr])
                           + " ORDER BY r DESC NULLS LAST, feature")
    return out


def _rate_sql(dims: list[str]) -> str:
    t = R.target
    parts = [f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, CAST({t} AS DOUBLE) AS y FROM base" for d in dims]
    return (f"SELECT g.dimension, g.value, g.n, {_r('g.rate')} AS rate, {_r('o.overall')} AS overall, "
            f"{_r('g.rate - o.overall')} AS diff FROM "
            f"(SELECT dimension, value, COUNT(*) AS n, AVG(y) AS rate FROM ({_union(parts)}) l "
            f"WHERE value IS NOT NULL GROUP BY dimension, value) g "
            f"JOIN (SELECT dimension, AVG(y) AS overall FROM ({_union(parts)}) l2 GROUP BY dimension) o "
            f"ON g.dimension = o.dimension")


def _long_sql(features: list[str], with_label: bool) -> str:
    t = R.target
    lab = f"{t} AS label, " if with_label else ""
    return _union([f"SELECT '{f}' AS feature, {lab}CAST({f} AS DOUBLE) AS value FROM base WHERE {f} IS NOT NULL"
                   for f in features])


def _hist_sql(features: list[str], density: bool) -> str:
    keys = "feature, label"
    long = _long_sql(features, True)
    edge = lambda i: f"(CASE WHEN {i} = 30 THEN s.hi ELSE {i} * s.width + s.lo END)"
    i0 = "CAST(TRUNC((l.value - s.lo) * (30.0 / (s.hi - s.lo))) AS BIGINT)"
    i1 = f"(CASE WHEN {i0} = 30 THEN 29 ELSE {i0} END)"
    i2 = f"(CASE WHEN l.value < {edge(i1)} THEN {i1} - 1 ELSE {i1} END)"
    i3 = f"(CASE WHEN l.value >= {edge(f'({i2} + 1)')} AND {i2} <> 29 THEN {i2} + 1 ELSE {i2} END)"
    dens = (f", ROUND(COALESCE(c.count, 0) / (s.n * ({edge('(g.bin + 1)')} - {edge('g.bin')})), 6) AS density"
            if density else "")
    stats = f"""(SELECT {keys}, n, lo, hi, (hi - lo) / 30.0 AS width FROM (
    SELECT {keys}, COUNT(*) AS n,
      CASE WHEN MIN(value) = MAX(value) THEN MIN(value) - 0.5 ELSE MIN(value) END AS lo,
      CASE WHEN MIN(value) = MAX(value) THEN MAX(value) + 0.5 ELSE MAX(value) END AS hi
    FROM ({long}) l0 GROUP BY {keys}) x)"""
    return f"""
SELECT s.feature, s.label, g.bin, ROUND({edge('g.bin')}, 6) AS bin_lo, ROUND({edge('(g.bin + 1)')}, 6) AS bin_hi,
  CAST(COALESCE(c.count, 0) AS BIGINT) AS count{dens}
FROM {stats} s
CROSS JOIN (SELECT CAST(range AS BIGINT) AS bin FROM range(30)) g
LEFT JOIN (
  SELECT l.feature, l.label, {i3} AS bin, COUNT(*) AS count
  FROM ({long}) l JOIN {stats} s ON l.feature = s.feature AND l.label = s.label
  GROUP BY 1, 2, 3) c ON c.feature = s.feature AND c.label = s.label AND c.bin = g.bin"""


def _box_sql(features: list[str]) -> str:
    long = _long_sql(features, True)
    return f"""
SELECT b.feature, b.label, COUNT(*) AS n, ROUND(b.q1, 6) AS q1, ROUND(b.median, 6) AS median, ROUND(b.q3, 6) AS q3,
  ROUND(b.iqr, 6) AS iqr,
  ROUND(LEAST(MIN(CASE WHEN l.value >= b.lo AND l.value <= b.hi THEN l.value END), b.q1), 6) AS whisker_lo,
  ROUND(GREATEST(MAX(CASE WHEN l.value >= b.lo AND l.value <= b.hi THEN l.value END), b.q3), 6) AS whisker_hi,
  COUNT(*) FILTER (WHERE NOT (l.value >= b.lo AND l.value <= b.hi)) AS n_fliers
FROM ({long}) l JOIN (
  SELECT feature, label, q1, median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT feature, label, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.5) AS median,
      QUANTILE_CONT(value, 0.75) AS q3 FROM ({long}) l0 GROUP BY feature, label) q) b
  ON l.feature = b.feature AND l.label = b.label
GROUP BY b.feature, b.label, b.q1, b.median, b.q3, b.iqr"""


def projection_sql() -> dict[str, str]:
    t = R.target
    cols = [c for c, _ in BASE_COLUMNS]
    keep = [c for c in cols if c not in R.drop]
    out = {
        "remove_columns": w(f"SELECT {', '.join(keep)} FROM base"),
        "split_xy": w(f"SELECT {', '.join(c for c in cols if c != t)} FROM base"),
        "select_numeric": w("SELECT " + ", ".join(
            c for c, ty in BASE_COLUMNS if ty in ("bigint", "int", "double") and c not in (t, R.id_col)) + " FROM base"),
        "select_columns": w(f"SELECT {', '.join(R.correlation)} FROM base"),
        "filter_by_class": w(f"SELECT * FROM base WHERE {t} = 1"),
        "drop_nulls": w(f", u AS ({UNION_SQL})\nSELECT * FROM u WHERE acct_balance IS NOT NULL AND segment IS NOT NULL"),
        "head": w(f"SELECT * FROM base ORDER BY {R.id_col} LIMIT {HEAD_N}"),
        "flag_label": w(f"SELECT customer_id, CASE WHEN {t} = 1 THEN 'Churned' WHEN {t} = 0 THEN 'Retained' END AS status, "
                        "CASE WHEN is_active = 1 THEN 'Yes' WHEN is_active = 0 THEN 'No' END AS is_active_label FROM base"),
    }
    return out


def split_cte(name: str, stratify: bool) -> str:
    """CTE ``name``: base + split, by the plain (single-window) form of the seeded exact split."""
    t = R.target
    cls = t if stratify else "0"
    h = sql_hash(SEED, R.id_col)
    return f"""{name}_q AS (
  SELECT cls, n_c, n_c - (fl + CASE WHEN ord <= need THEN 1 ELSE 0 END) AS test_quota FROM (
    SELECT *, n_train - SUM(fl) OVER () AS need, ROW_NUMBER() OVER (ORDER BY rem DESC, cls) AS ord FROM (
      SELECT cls, n_c, n_train, FLOOR(n_c / n * n_train) AS fl, n_c / n * n_train - FLOOR(n_c / n * n_train) AS rem
      FROM (SELECT cls, n_c, SUM(n_c) OVER () AS n,
                   SUM(n_c) OVER () - CEIL(CAST({TEST_SIZE} AS DOUBLE) * SUM(n_c) OVER ()) AS n_train
            FROM (SELECT {cls} AS cls, COUNT(*) AS n_c FROM base GROUP BY 1) c0) c1) c2) c3),
{name} AS (
  SELECT b.*, CASE WHEN ROW_NUMBER() OVER (PARTITION BY {cls} ORDER BY {h}, b.{R.id_col}) <= q.test_quota
                   THEN 'test' ELSE 'train' END AS split
  FROM base b JOIN {name}_q q ON q.cls = {cls})"""


def prepared_ctes() -> str:
    """CTEs s (split), enc (encoder), e (encoded), sc (scaler moments), p (prepared, unrounded)."""
    enc = _union([
        f"SELECT '{c}' AS column_name, value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS value FROM s WHERE split = 'train' AND {c} IS NOT NULL) d"
        for c in R.categorical])
    joins = " ".join(f"LEFT JOIN enc j_{c} ON j_{c}.column_name = '{c}' AND j_{c}.value = CAST(s.{c} AS VARCHAR)"
                     for c in R.categorical)
    feats = FEATURES
    sel = []
    for f in feats:
        sel.append(f"j_{f}.code AS {f}" if f in R.categorical else f"s.{f}")
    scaled = SCALED
    moments = ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS m_{c}, STDDEV_POP(CAST({c} AS DOUBLE)) AS s_{c}" for c in scaled)
    pcols = []
    for f in feats:
        if f in scaled:
            pcols.append(f"(CAST(e.{f} AS DOUBLE) - sc.m_{f}) / (CASE WHEN sc.s_{f} = 0 OR sc.s_{f} IS NULL "
                         f"THEN 1.0 ELSE sc.s_{f} END) AS {f}")
        else:
            pcols.append(f"e.{f}")
    return f""", {split_cte('s', True)},
enc AS ({enc}),
e AS (SELECT s.{R.id_col}, {', '.join(sel)}, s.{R.target}, s.split FROM s {joins}),
sc AS (SELECT {moments} FROM e WHERE split = 'train'),
p AS (SELECT e.{R.id_col}, {', '.join(pcols)}, e.{R.target}, e.split FROM e CROSS JOIN sc)
"""


def _round_cols(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(f"ROUND({c}, 6) AS {c}" if c in doubles else c for c in cols)


def prep_sql() -> dict[str, str]:
    t = R.target
    idc = R.id_col
    pc = [idc] + FEATURES + [t, "split"]
    prepared = w(prepared_ctes() + f"SELECT {_round_cols(pc, set(SCALED))} FROM p")
    scaler = _union([f"SELECT '{c}' AS column_name, ROUND(m_{c}, 6) AS mean, "
                     f"ROUND(CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END, 6) AS scale FROM sc"
                     for c in SCALED])
    arr = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"
    return {
        "stratified_split": w(", " + split_cte("s", True) + f"\nSELECT {idc}, {t}, split FROM s"),
        "random_split": w(", " + split_cte("s", False) + f"\nSELECT {idc}, {t}, split FROM s"),
        "split_approx": w(f"SELECT {idc}, CASE WHEN {sql_uniform(SEED, idc)} < CAST({TEST_SIZE} AS DOUBLE) "
                          f"THEN 'test' ELSE 'train' END AS split FROM base"),
        "encode_fit": w(prepared_ctes() + "SELECT * FROM enc"),
        "encode_transform": w(prepared_ctes() + f"SELECT {idc}, {', '.join(R.categorical)}, split FROM e"),
        "scale_fit": w(prepared_ctes() + scaler),
        "scale_transform": w(prepared_ctes() + f"SELECT {idc}, {_round_cols(SCALED, set(SCALED))} FROM p"),
        "prepare": prepared,
        "metadata": w(", " + split_cte("s", True) + f"""
SELECT {arr(FEATURES)} AS feature_names, '{t}' AS target_name,
  COUNT(*) FILTER (WHERE split = 'train') AS n_train, COUNT(*) FILTER (WHERE split = 'test') AS n_test,
  {arr(R.categorical)} AS categorical_encoded_columns, {arr(SCALED)} AS scaled_numeric_columns,
  {arr(list(R.drop))} AS dropped_columns FROM s"""),
        "write_prepared": prepared,
        "read_prepared": w(", " + split_cte("s", True) + f"\nSELECT split, {t}, COUNT(*) AS n FROM s GROUP BY ALL"),
        "save_artifacts": w(prepared_ctes() + f"""SELECT 'scaler' AS artifact, column_name AS name, NULL AS value, CAST(NULL AS BIGINT) AS n,
  mean, scale FROM ({scaler}) x
UNION ALL SELECT 'encoder', column_name, value, CAST(code AS BIGINT), NULL, NULL FROM enc
UNION ALL SELECT 'metadata', 'n_train', '{','.join(FEATURES)}', COUNT(*) FILTER (WHERE split = 'train'), NULL, NULL FROM p"""),
        "churn_share_by_split": w(", " + split_cte("s", True) +
                                  f"\nSELECT split, COUNT(*) AS n, ROUND(AVG(CAST({t} AS DOUBLE)), 6) AS rate FROM s GROUP BY split"),
    }


def metric_sql() -> dict[str, str]:
    t = R.target
    sc = SCORERS["rule_activity"]
    scored = f"SELECT {t} AS y, {sc} AS score, CASE WHEN {sc} > {THRESHOLD} THEN 1 ELSE 0 END AS p FROM base"
    conf = (f"SELECT COUNT(*) FILTER (WHERE y = 1 AND p = 1) AS tp, COUNT(*) FILTER (WHERE y = 0 AND p = 1) AS fp, "
            f"COUNT(*) FILTER (WHERE y = 0 AND p = 0) AS tn, COUNT(*) FILTER (WHERE y = 1 AND p = 0) AS fn FROM ({scored}) x")
    d = lambda a, b: f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"
    mets = (f"ROUND({d('tp + tn', 'tp + fp + tn + fn')}, 6) AS accuracy, ROUND({d('tp', 'tp + fp')}, 6) AS precision, "
            f"ROUND({d('tp', 'tp + fn')}, 6) AS recall, ROUND({d('2 * tp', '2 * tp + fp + fn')}, 6) AS f1")
    auc = f"""SELECT ROUND(CASE WHEN COALESCE(SUM(pos), 0) = 0 OR COALESCE(SUM(neg), 0) = 0 THEN 0.5
    ELSE SUM(pos * (below + neg / 2.0)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) END, 6) AS roc_auc
FROM (SELECT s, pos, neg, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT score AS s, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y = 0) AS neg
            FROM ({scored}) x WHERE score IS NOT NULL GROUP BY score) g) r"""
    per_model = _union([
        f"SELECT {i} AS ordinal, '{n}' AS model, {t} AS y, CASE WHEN {e} > {THRESHOLD} THEN 1 ELSE 0 END AS p FROM base"
        for i, (n, e) in enumerate(SCORERS.items())])
    best = f"""SELECT ordinal, model, {mets} FROM (
  SELECT ordinal, model, COUNT(*) FILTER (WHERE y = 1 AND p = 1) AS tp, COUNT(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
    COUNT(*) FILTER (WHERE y = 0 AND p = 0) AS tn, COUNT(*) FILTER (WHERE y = 1 AND p = 0) AS fn
  FROM ({per_model}) x GROUP BY ordinal, model) c
ORDER BY {d('2 * tp', '2 * tp + fp + fn')} DESC, ordinal LIMIT 1"""
    train = ", " + split_cte("s", True)
    return {
        "confusion": w(conf),
        "metrics": w(f"SELECT {mets} FROM ({conf}) c"),
        "roc_auc": w(auc),
        "best_model": w(best),
        "smote_disables_weights": w(train + f"""
SELECT CAST({t} AS INTEGER) AS label, MAX(COUNT(*)) OVER () AS n_c, 1.0::DOUBLE AS weight
FROM s WHERE split = 'train' GROUP BY {t}"""),
        "balanced_weights": w(train + f"""
SELECT {t} AS label, COUNT(*) AS n_c, ROUND(SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*)), 6) AS weight
FROM s WHERE split = 'train' GROUP BY {t}"""),
        "scale_pos_weight": w(train + f"""
SELECT positives, negatives, ROUND(CASE WHEN positives > 0 AND negatives > 0
  THEN CAST(negatives AS DOUBLE) / positives END, 6) AS scale_pos_weight FROM (
  SELECT COUNT(*) FILTER (WHERE {t} = 1) AS positives, COUNT(*) FILTER (WHERE {t} = 0) AS negatives
  FROM s WHERE split = 'train') c"""),
    }


def smote_sql() -> str:
    t, idc = R.target, R.id_col
    feats = FEATURES
    dist = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in feats)
    tr_cols = ", ".join(f"ROUND({f}, 6) AS {f}" if f in SCALED else f for f in feats)
    nn_u = sql_uniform(SEED, "'nn'", f"d.{idc}", "d.smote_draw")
    gap_u = sql_uniform(SEED, "'gap'", f"d.{idc}", "d.smote_draw")
    new_cols = []
    for f in feats:
        v = f"(CAST(d.{f} AS DOUBLE) + {gap_u} * (CAST(nb.{f} AS DOUBLE) - CAST(d.{f} AS DOUBLE)))"
        new_cols.append(f"CAST(TRUNC({v}) AS INTEGER) AS {f}" if f in R.categorical else f"ROUND({v}, 6) AS {f}")
    return w(prepared_ctes() + f""", tr AS (SELECT {idc}, {tr_cols}, {t} FROM p WHERE split = 'train'),
cnt AS (SELECT {t} AS cls, COUNT(*) AS n_c FROM tr GROUP BY {t}),
mx AS (SELECT MAX(n_c) AS n_max, MIN(cls) FILTER (WHERE n_c = (SELECT MAX(n_c) FROM cnt)) AS maj FROM cnt),
mc AS (SELECT cls, n_c, (n_max - n_c) // n_c AS q, (n_max - n_c) % n_c AS r FROM cnt, mx WHERE cls <> maj AND n_c < n_max),
m AS (SELECT tr.*, mc.q, mc.r FROM tr JOIN mc ON tr.{t} = mc.cls),
knn AS (SELECT a, b, nn_rank FROM (
  SELECT a.{idc} AS a, b.{idc} AS b,
    ROW_NUMBER() OVER (PARTITION BY a.{idc} ORDER BY ROUND(SQRT({dist}), 9), b.{idc}) AS nn_rank
  FROM m a JOIN m b ON a.{t} = b.{t} AND a.{idc} <> b.{idc}) z WHERE nn_rank <= {SMOTE_K}),
rk AS (SELECT m.*, ROW_NUMBER() OVER (PARTITION BY {t} ORDER BY {sql_hash(SEED, "'smote'", idc)}, {idc}) AS rnk FROM m),
d AS (SELECT rk.*, UNNEST(generate_series(1, q + CASE WHEN rnk <= r THEN 1 ELSE 0 END)) AS smote_draw
      FROM rk WHERE q + CASE WHEN rnk <= r THEN 1 ELSE 0 END > 0),
syn AS (SELECT CAST(NULL AS BIGINT) AS {idc}, {', '.join(new_cols)}, d.{t}, CAST(d.{idc} AS BIGINT) AS smote_source,
          CAST(d.smote_draw AS INTEGER) AS smote_draw
        FROM d JOIN knn ON knn.a = d.{idc} AND knn.nn_rank = CAST(FLOOR({nn_u} * {SMOTE_K}) + 1 AS BIGINT)
        JOIN m nb ON nb.{idc} = knn.b)
SELECT {idc}, {', '.join(feats)}, {t}, CAST(NULL AS BIGINT) AS smote_source, CAST(NULL AS INTEGER) AS smote_draw FROM tr
UNION ALL SELECT * FROM syn""")


def source_sql() -> dict[str, str]:
    t = R.target
    union = w(UNION_SQL)
    parts = []
    for c, ty in BASE_COLUMNS:
        if c == R.id_col:
            continue
        # the type says what the text must be read as
        kind = {"bigint": "int", "int": "int", "double": "float", "string": "str"}[ty]
        value = f"CAST({c} AS VARCHAR)"
        parts.append(f"""SELECT {R.id_col}, '{c}' AS column_name, CASE WHEN {c} IS NULL THEN 'none' ELSE '{kind}' END AS kind,
  {f'CAST({c} AS BIGINT)' if kind == 'int' else 'CAST(NULL AS BIGINT)'} AS as_long,
  {f'ROUND(CAST({c} AS DOUBLE), 6)' if kind != 'str' else 'CAST(NULL AS DOUBLE)'} AS as_double, CAST(NULL AS BOOLEAN) AS as_bool,
  {value if kind == 'str' else 'CAST(NULL AS VARCHAR)'} AS as_string FROM base""")
    odd = "customer_id % 12"
    parts.append(f"""SELECT {R.id_col}, 'odd' AS column_name,
  CASE {odd} WHEN 1 THEN 'int' WHEN 6 THEN 'int' WHEN 3 THEN 'bool' WHEN 4 THEN 'none' WHEN 5 THEN 'none' WHEN 7 THEN 'float'
    WHEN 8 THEN 'float' WHEN 10 THEN 'float' ELSE 'str' END AS kind,
  CASE {odd} WHEN 1 THEN n_orders * 1000 WHEN 6 THEN n_orders END AS as_long,
  ROUND(CASE {odd} WHEN 1 THEN n_orders * 1000.0 WHEN 6 THEN n_orders WHEN 7 THEN n_orders * 1000.0
    WHEN 8 THEN n_orders / pow(10, length(CAST(n_orders AS VARCHAR))) WHEN 10 THEN -n_orders END, 6) AS as_double,
  CASE {odd} WHEN 3 THEN TRUE END AS as_bool,
  CASE {odd} WHEN 0 THEN '00' || n_orders WHEN 2 THEN segment WHEN 9 THEN 'it''s ' || segment WHEN 11 THEN region END AS as_string
FROM base""")
    flags = ", ".join(f"{f} <> 0 AS {f}" for f in list(R.flags) + [t])
    # the first five words and the null (default true) are yes
    flags += f", customer_id % {len(FLAG_WORDS)} IN (0, 1, 2, 3, 4, 10) AS word, n_orders <> 3 AS number"
    return {
        "scan_csv": w("SELECT * FROM base"),
        "scan_csv_dir": union,
        "union_all": union,
        "coerce_literal": w(_union(parts)),
        "parse_bool": w(f"SELECT {R.id_col}, {flags} FROM base"),
    }


def requests_sql() -> str:
    cols = ", ".join(RAW_FEATURES)
    return w(f"SELECT CAST(FLOOR({R.id_col} / {REQUEST_GROUP}) AS BIGINT) AS request_id, {R.id_col} AS index, {cols} "
             "FROM base")


def model_sql() -> dict[str, str]:
    """What holds of a trained model's output whatever the model is: which rows it scores, and what follows from what."""
    idc, t = R.id_col, R.target
    test = prep_sql()["stratified_split"]
    facts = "TRUE AS is_probability, TRUE AS label_follows, TRUE AS beats_constant"
    on_test = f"SELECT {idc}, {t}, {facts} FROM ({test}) s WHERE split = 'test'"
    long = ", ".join(f"({i}, '{c}')" for i, c in enumerate(STUMP_FEATURES))
    pick = "CASE f.ord " + " ".join(f"WHEN {i} THEN CAST({c} AS DOUBLE)" for i, c in enumerate(STUMP_FEATURES)) + " END"
    stump = w(", " + split_cte("s", True) + f""", tr AS (SELECT * FROM s WHERE split = 'train'),
f(ord, name) AS (VALUES {long}),
pw AS (SELECT CAST(COUNT(*) FILTER ({t} = 0) AS DOUBLE) / COUNT(*) FILTER ({t} = 1) AS w FROM tr),
sums AS (SELECT f.ord, {pick} AS v, SUM(CASE WHEN {t} = 1 THEN -0.5 * pw.w ELSE 0.5 END) AS g,
  SUM(CASE WHEN {t} = 1 THEN 0.25 * pw.w ELSE 0.25 END) AS h FROM tr, f, pw GROUP BY 1, 2),
cum AS (SELECT ord, LEAD(v) OVER w AS cut, SUM(g) OVER w AS lg, SUM(h) OVER w AS lh,
  SUM(g) OVER (PARTITION BY ord) AS g, SUM(h) OVER (PARTITION BY ord) AS h FROM sums WINDOW w AS (PARTITION BY ord ORDER BY v)),
best AS (SELECT ord, cut, -{STUMP.learning_rate} * lg / (lh + {STUMP.reg_lambda}) AS wl,
  -{STUMP.learning_rate} * (g - lg) / (h - lh + {STUMP.reg_lambda}) AS wr FROM cum
  WHERE cut IS NOT NULL AND lh >= {STUMP.min_child_weight} AND h - lh >= {STUMP.min_child_weight}
  ORDER BY ROUND(lg * lg / (lh + {STUMP.reg_lambda}) + (g - lg) * (g - lg) / (h - lh + {STUMP.reg_lambda})
    - g * g / (h + {STUMP.reg_lambda}), 9) DESC, ord, cut LIMIT 1),
p AS (SELECT {idc}, 1 / (1 + EXP(-CASE WHEN {pick.replace("f.ord", "best.ord")} < cut THEN wl ELSE wr END)) AS p
  FROM s, best WHERE split = 'test')
SELECT {idc}, ROUND(p, 9) AS probability, CAST(p > 0.5 AS INTEGER) AS prediction FROM p""")
    on_all = lambda column: w(f"SELECT {idc}, TRUE AS {column} FROM base")
    points = lambda space, m: " * ".join(str(len(v)) for v in space[m].values())
    oof = ", ".join(f"('{m}', CAST({points(OOF_SPACE, m)} AS BIGINT))" for m in OOF_SPACE["model_types"])
    grids = ", ".join(f"('{m}', {points(PROD_SPACE, m)})" for m in PROD_SPACE["model_types"])
    g = f"CAST(FLOOR({idc} / {REQUEST_GROUP}) AS BIGINT)"
    castles = "g % 11 = 7 AND segment = 'BUILDING'"
    return {
        "train_logreg": on_test.replace(facts, facts + ", TRUE AS at_optimum"), "boosted_stump": stump, "train_rf": on_test, "train_gbt": on_test, "predict": on_test,
        "train_stage": f"""WITH s AS ({test}), n AS (SELECT COUNT(*) FILTER (WHERE split = 'train') AS n_train,
  COUNT(*) FILTER (WHERE split = 'test') AS n_test FROM s)
SELECT run_type, model, n_metrics, n_train, n_test, n_test AS n_same_after_load
FROM n, (VALUES ('model', 'xgboost', 5), ('parent', NULL, 4)) v(run_type, model, n_metrics)""",
        "as_pipeline": on_all("same"), "save_model": on_all("same"), "load_model": on_all("same_label"),
        "score_batch": w(f"SELECT {idc}, {facts} FROM base"),
        "score_stream": w(f"SELECT {g} AS request_id, {idc} AS index, TRUE AS same FROM base"),
        "score_requests": w(f"""SELECT g AS request_id,
  CAST(CASE WHEN g % 11 IN (3, 5) THEN 0 ELSE COUNT(*) FILTER (WHERE NOT ({castles})) END AS INTEGER) AS n_predictions,
  CASE WHEN g % 11 IN (3, 5) THEN '' ELSE COALESCE(string_agg(CAST({idc} AS VARCHAR), ',' ORDER BY {idc})
    FILTER (WHERE NOT ({castles})), '') END AS indexes,
  CASE g % 11 WHEN 3 THEN 'all malformed' WHEN 5 THEN 'all missing columns: region' ELSE COALESCE(
    string_agg({idc} || ' unseen categories: segment', ';' ORDER BY {idc}) FILTER (WHERE {castles}), '') END AS rejected
FROM (SELECT *, {g} AS g FROM base) x GROUP BY g"""),
        # a sweep tries its whole grid, or as many points of it as the budget has
        "random_search": w(f"""SELECT model, LEAST(points, 30)::BIGINT AS n_trials, LEAST(points, 30)::BIGINT AS n_ids, TRUE AS score_is_best
FROM (VALUES {grids}) v(model, points) WHERE EXISTS (SELECT 1 FROM base)"""),
        "search_out_of_fold": w(", " + split_cte("s", True) + f""", f AS (
  SELECT CAST('0x' || substr({sql_hash(SEED, "'fold'", idc)}, 1, 8) AS BIGINT) % {OOF_FOLDS} AS fold FROM s WHERE split = 'train')
SELECT model, n_trials, (SELECT COUNT(*) FROM f) AS scored_rows, TRUE AS scores_hold,
  {", ".join(f"(SELECT COUNT(*) FROM f WHERE fold = {i}) AS fold_{i}" for i in range(OOF_FOLDS))}
FROM (VALUES {oof}) v(model, n_trials)"""),
        **tracking.oracle_sql(),
    }


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {"smote": smote_sql(), "score_requests_parse": requests_sql()}
    out.update(source_sql())
    out.update(metric_sql())
    out.update(profile_sql())
    out.update(projection_sql())
    out.update(prep_sql())
    out.update(model_sql())
    return out


__all__ = ["oracle_sql"]
