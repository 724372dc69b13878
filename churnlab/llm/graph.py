"""Connected components of a link table: large-star and small-star (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from churnlab.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): smallest node of the component, for every node of ``edges`` (u, v); loops count as nodes.

    A hub's links are folded with ``min`` before they are joined back, so no
    task gathers a node's neighbours; every round is written to the shared
    folder. The rounds grow with the logarithm of the longest chain.
    """
    nodes = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct()
    now, before = store(edges.where("u <> v").distinct(), "links"), None
    for _ in range(max_rounds):
        seen = Observation()  # counted while it is written, so a round is one job
        now = store(_small_star(_large_star(now)).observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "links")
        mark = seen.get
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return nodes.join(now.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component"))
