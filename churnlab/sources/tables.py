"""Input tables and the churn base table derived from them.

The churn table the workflow profiles, prepares and models is derived from
``customer``, ``orders``, ``nation`` and ``region``: features come from orders
before a cutoff date, the label from whether the customer ordered after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.operators.joins import bounded_broadcast

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the stand-in churn definition (must equal the oracle SQL).
CUTOFF = "2000-08-01 00:00:00"
ACTIVE_SINCE = "1999-08-01 00:00:00"
TENURE_YEAR = 2000
URGENT_PRIORITY = "1-URGENT"


@dataclass(frozen=True)
class Roles:
    """Column roles of a churn table (the reference keeps these in YAML)."""

    id_col: str = "customer_id"
    target: str = "churned"
    drop: tuple[str, ...] = ("customer_id", "name")
    categorical: tuple[str, ...] = ("region", "segment")
    flags: tuple[str, ...] = ("has_urgent", "is_active")
    numeric: tuple[str, ...] = ("acct_balance", "n_orders", "n_priorities", "avg_price_cents", "tenure_years")

    @property
    def correlation(self) -> list[str]:
        return list(self.numeric) + list(self.flags) + [self.target]


ROLES = Roles()

BASE_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("region", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("acct_balance", T.DoubleType()), T.StructField("n_orders", T.LongType()),
    T.StructField("n_priorities", T.LongType()), T.StructField("avg_price_cents", T.LongType()),
    T.StructField("tenure_years", T.LongType()), T.StructField("has_urgent", T.IntegerType()),
    T.StructField("is_active", T.IntegerType()), T.StructField("churned", T.IntegerType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(text: str) -> Column:
    # Test tables carry timestamp_ntz; compare against the same type.
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def order_features(orders: DataFrame) -> DataFrame:
    """Per-customer order features and label in ONE scan and ONE aggregation.

    Conditional aggregates replace the separate "future orders" scan and its
    left join: rows before the cutoff feed the features, rows on/after it
    only set ``has_future``. The aggregation is partial (map-side) first, so
    a hot customer key only ships one partial row per map task.
    """
    d = F.col("o_orderdate")
    before = d < _ts(CUTOFF)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return (
        orders.select("o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
        .groupBy("o_custkey")
        .agg(
            F.count_if(before).alias("n_orders"),
            F.count_distinct(F.when(before, F.col("o_orderpriority"))).alias("n_priorities"),
            F.sum(F.when(before, cents)).alias("_cents"),
            F.min(F.when(before, d)).alias("_first_dt"),
            F.max(F.when(before, d)).alias("_last_dt"),
            F.max(
                F.when(before & (F.col("o_orderpriority") == URGENT_PRIORITY), 1).when(before, 0)
            ).alias("has_urgent"),
            F.max(F.when(d >= _ts(CUTOFF), 1).otherwise(0)).alias("_has_future"),
        )
        .where(F.col("n_orders") > 0)
    )


def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn table (one row per customer with pre-cutoff orders)."""
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    feats = order_features(read_table(spark, sf_dir, "orders"))
    joined = customer.join(feats, customer.c_custkey == feats.o_custkey).join(
        bounded_broadcast(geo, 100_000), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acct_balance"),
        F.col("n_orders"),
        F.col("n_priorities"),
        F.floor(F.col("_cents") / F.col("n_orders")).cast("bigint").alias("avg_price_cents"),
        (F.lit(TENURE_YEAR) - F.year("_first_dt")).cast("bigint").alias("tenure_years"),
        F.col("has_urgent").cast("int").alias("has_urgent"),
        F.when(F.col("_last_dt") >= _ts(ACTIVE_SINCE), 1).otherwise(0).alias("is_active"),
        F.when(F.col("_has_future") == 1, 0).otherwise(1).alias("churned"),
    )


# DuckDB form of the same table, used as a CTE by every oracle query.
BASE_CTE = f"""base AS (
WITH o AS (SELECT o_custkey, COUNT(*) AS n_orders, COUNT(DISTINCT o_orderpriority) AS n_priorities,
    CAST(FLOOR(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) / COUNT(*)) AS BIGINT) AS avg_price_cents,
    MIN(o_orderdate) AS first_dt, MAX(o_orderdate) AS last_dt,
    MAX(CASE WHEN o_orderpriority = '{URGENT_PRIORITY}' THEN 1 ELSE 0 END) AS has_urgent
  FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF}' GROUP BY o_custkey),
 f AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}')
SELECT c.c_custkey AS customer_id, c.c_name AS name, r.r_name AS region, c.c_mktsegment AS segment,
  c.c_acctbal AS acct_balance, o.n_orders, o.n_priorities, o.avg_price_cents,
  CAST({TENURE_YEAR} - EXTRACT(YEAR FROM o.first_dt) AS BIGINT) AS tenure_years, o.has_urgent,
  CASE WHEN o.last_dt >= TIMESTAMP '{ACTIVE_SINCE}' THEN 1 ELSE 0 END AS is_active,
  CASE WHEN f.o_custkey IS NULL THEN 1 ELSE 0 END AS churned
FROM customer c JOIN o ON o.o_custkey = c.c_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN f ON f.o_custkey = c.c_custkey)"""
