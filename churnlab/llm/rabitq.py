"""Approximate nearest neighbours with randomly rotated one-bit codes (RaBitQ, Gao & Long, 2024).

Index: a vector minus the centre, scaled to length one and rotated by a random
orthogonal matrix, keeps the signs of its components as packed bits, with its
distance to the centre and the inner product of code and vector as correction
scalars. Search: the rotated query is quantized to a few bit planes; AND and
bit counts over the packed words estimate the inner product without bias, and
an error bound that holds with high probability gives a lower bound of the
distance. Only vectors whose lower bound does not exceed the k-th best distance
so far are compared in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlab.llm.common import new_folder

EPSILON = 3.0  # width of the error bound in standard deviations
PLANES = 6  # bits of a quantized query component
QUERY_BLOCK = 4096  # queries that one pass over the index answers
ROTATION_SEED = 20240521
INDEX_SCHEMA = "vec_id long, row long, dim int, code binary, radius double, fit double, vector array<double>"

ANSWER_SCHEMA = "query_id long, query_row long, vec_id long, score double"


def rotation(dim: int, seed: int = ROTATION_SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def pack_bits(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words, zero-filled at the end."""
    width = -(-signs.shape[1] // 64) * 64
    padded = np.zeros((len(signs), width), bool)
    padded[:, :signs.shape[1]] = signs
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, dim, vector as doubles) of the vectors that take part: no null, zero or non-finite ones."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"))
            .where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
            .select("vec_id", F.size("vector").alias("dim"), "vector"))


def centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """Mean vector per dimension, over all rows."""
    means = (rows.select("dim", F.posexplode("vector").alias("pos", "x")).groupBy("dim", "pos").agg(F.avg("x").alias("m"))
             .collect())
    out: dict[int, np.ndarray] = {}
    for r in means:
        out.setdefault(r["dim"], np.zeros(r["dim"]))[r["pos"]] = r["m"]
    return out


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed codes, distances to the centre, inner products of code and unit vector)."""
    moved = vectors - centre
    radius = np.linalg.norm(moved, axis=1)
    turned = (moved / np.where(radius > 0, radius, 1)[:, None]) @ turn
    return pack_bits(turned > 0), radius, np.abs(turned).sum(axis=1) / math.sqrt(len(centre))


def build_index(vectors: DataFrame, vector: str = "embedding", folder: str | None = None) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """Codes and vectors of all usable rows, written to the shared folder, and the centres they refer to.

    Vectors of different dimension are coded and searched apart. ``row`` numbers
    the rows of the index, so that repeated vec_ids stay apart.
    """
    rows = usable(vectors, vector)
    middle = centres(rows)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    folder = folder or new_folder(vectors.sparkSession, "rabitq-index")

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                v = np.stack(part["vector"].to_numpy())
                codes, radius, fit = encode(v, middle[dim], rotation(dim))
                yield part[["vec_id", "row", "dim"]].assign(code=[c.tobytes() for c in codes], radius=radius, fit=fit,
                                                     vector=part["vector"])

    rows.mapInPandas(code, INDEX_SCHEMA).write.parquet(folder)
    return vectors.sparkSession.read.schema(INDEX_SCHEMA).parquet(folder), middle


class QueryBlock:
    """Rotated, quantized queries of one dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, centre: np.ndarray):
        self.ids, self.rows, self.vectors, dim = ids, rows, vectors, len(centre)
        self.dim = dim
        moved = vectors - centre
        self.radius = np.linalg.norm(moved, axis=1)
        turned = (moved / np.where(self.radius > 0, self.radius, 1)[:, None]) @ rotation(dim)
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / ((1 << PLANES) - 1), 1e-300)
        # randomized rounding keeps the quantized inner product without bias
        noise = np.random.default_rng(ROTATION_SEED).random(turned.shape)
        levels = np.clip(np.floor((turned - self.low[:, None]) / self.step[:, None] + noise), 0, (1 << PLANES) - 1).astype(np.int64)
        self.planes = np.stack([pack_bits((levels >> j) & 1 == 1) for j in range(PLANES)])  # plane, query, word
        self.total = levels.sum(axis=1)

    def lower_bounds(self, q: int, codes: np.ndarray, ones: np.ndarray, radius: np.ndarray, fit: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances between query ``q`` and the coded vectors."""
        dim = self.dim
        hits = np.zeros(len(codes))
        for j in range(PLANES):
            hits += (1 << j) * np.bitwise_count(codes & self.planes[j, q]).sum(axis=1)
        # inner product of the query with the code's +-1/sqrt(dim) vector
        product = (2 * self.step[q] * hits + 2 * self.low[q] * ones
                   - self.step[q] * self.total[q] - dim * self.low[q]) / math.sqrt(dim)
        safe = np.maximum(fit, 1e-12)
        error = EPSILON * (np.sqrt(np.maximum(1 - safe ** 2, 0) / max(dim - 1, 1)) + self.step[q]) / safe
        inner = np.minimum(product / safe + error, 1.0)
        return radius ** 2 + self.radius[q] ** 2 - 2 * radius * self.radius[q] * inner


def nearest(ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, codes: np.ndarray, radius: np.ndarray, fit: np.ndarray,
            block: QueryBlock, best: list[tuple[np.ndarray, np.ndarray]], k: int) -> None:
    """Bring each query's (distances, ids) in ``best`` up to date with a batch of coded vectors."""
    ones = np.bitwise_count(codes).sum(axis=1).astype(np.float64)
    for q in range(len(block.ids)):
        low = block.lower_bounds(q, codes, ones, radius, fit)
        low[rows == block.rows[q]] = np.inf
        dist, found = best[q]
        # a first few by lower bound give a k-th distance to beat; then all that might beat it
        todo = np.argpartition(low, min(k, len(low) - 1))[:k + 1] if len(dist) < k else np.zeros(0, np.int64)
        for _ in range(2):
            todo = todo[np.isfinite(low[todo])]
            if len(todo):
                d = np.sqrt(((vectors[todo] - block.vectors[q]) ** 2).sum(axis=1))
                dist, found = np.append(dist, d), np.append(found, ids[todo])
                order = np.lexsort((found, dist))[:k]
                dist, found = dist[order], found[order]
                low[todo] = np.inf
            bound = dist[-1] if len(dist) == k else np.inf
            todo = np.flatnonzero(low <= bound * bound * (1 + 1e-9))
            if not len(todo):
                break
        best[q] = dist, found


def _answers(index: DataFrame, blocks: list[QueryBlock], k: int) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast(blocks)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [[(np.zeros(0), np.zeros(0, np.int64)) for _ in b.ids] for b in sent.value]
        for batch in batches:
            for block, found in zip(sent.value, best):
                part = batch[batch["dim"] == block.dim]
                if len(part):
                    codes = np.frombuffer(b"".join(part["code"]), "<u8").reshape(len(part), -1)
                    nearest(part["vec_id"].to_numpy(), part["row"].to_numpy(), np.stack(part["vector"].to_numpy()), codes, part["radius"].to_numpy(),
                            part["fit"].to_numpy(), block, found, k)
        for block, found in zip(sent.value, best):
            sizes = [len(d) for d, _ in found]
            if sum(sizes):
                yield pd.DataFrame({"query_id": np.repeat(block.ids, sizes), "query_row": np.repeat(block.rows, sizes), "vec_id": np.concatenate([f for _, f in found]),
                                    "score": np.concatenate([d for d, _ in found])})

    return index.mapInPandas(search, ANSWER_SCHEMA)


def search_index(index: DataFrame, middle: dict[int, np.ndarray], queries: DataFrame, k: int = 10,
                 query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row of ``queries`` (vec_id, row, dim, vector).

    Queries pass in blocks of about ``query_block``; each block is one map-only
    pass over the index in which every task keeps its ``k`` best per query.
    Equal distances go to the smaller vec_id. ``row`` is the query's own row of
    the index, which takes no part; rows that repeat its vec_id are candidates
    like all others, and every row of ``queries`` gets an answer of its own.
    """
    spark = index.sparkSession
    n = queries.count()
    blocks = -(-n // query_block)
    found = spark.createDataFrame([], ANSWER_SCHEMA)
    for b in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).orderBy("row").toPandas()
        made = [QueryBlock(part["vec_id"].to_numpy(), part["row"].to_numpy(), np.stack(part["vector"].to_numpy()), middle[dim])
                for dim, part in rows.groupby("dim")]
        found = found.unionByName(_answers(index, made, k))
    rank = Window.partitionBy("query_row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")
