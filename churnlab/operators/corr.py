"""Pearson correlations of many columns, pairwise-complete, as one mergeable block per pair of column groups.

A part holds, for every pair of a block, the rows in which both columns are
present, both means over these rows, and the three centred sums of products.
Parts of a batch come from a few matrix products; parts merge exactly (Chan,
Golub & LeVeque, 1983), so tasks fold their batches, groups of tasks fold their
parts, and one row per pair of column groups is left. Masks are multiplied only
where a block has nulls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_COLUMNS = 64
MERGED = 64  # parts that one task folds at a time
PART_SCHEMA = "i int, j int, salt int, part binary"


def _part(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(6, p, q): rows, mean of x, mean of y, centred xx, yy, xy over the rows where both are present."""
    has_x, has_y = ~np.isnan(x), ~np.isnan(y)
    shift_x, shift_y = _middle(x, has_x), _middle(y, has_y)
    x, y = x - shift_x, y - shift_y
    whole = has_x.all() and has_y.all()
    if not whole:
        x, y = np.where(has_x, x, 0.0), np.where(has_y, y, 0.0)
        mx, my = has_x.astype(float), has_y.astype(float)
        n, sx, sy = mx.T @ my, x.T @ my, mx.T @ y
        xx, yy = (x * x).T @ my, mx.T @ (y * y)
    else:
        ones = np.ones((x.shape[1], y.shape[1]))
        n, sx, sy = len(x) * ones, x.sum(axis=0)[:, None] * ones, y.sum(axis=0)[None] * ones
        xx, yy = (x * x).sum(axis=0)[:, None] * ones, (y * y).sum(axis=0)[None] * ones
    safe = np.maximum(n, 1)
    return np.stack([n, sx / safe + shift_x[:, None], sy / safe + shift_y[None], xx - sx * sx / safe, yy - sy * sy / safe,
                     x.T @ y - sx * sy / safe])


def _middle(x: np.ndarray, present: np.ndarray) -> np.ndarray:
    """Per column about its mean, and exactly its value where that never changes; 0 without values."""
    first = np.where(present.any(axis=0), x[present.argmax(axis=0), np.arange(x.shape[1])], 0.0)
    moved = np.where(present, x - first, 0.0)
    return first + moved.sum(axis=0) / np.maximum(present.sum(axis=0), 1)


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    safe = np.maximum(n, 1)
    dx, dy, share = b[1] - a[1], b[2] - a[2], a[0] * b[0] / safe
    # a side without rows for a pair has a mean that says nothing
    mean = lambda k, d: np.where(a[0] == 0, b[k], np.where(b[0] == 0, a[k], a[k] + d * b[0] / safe))
    return np.stack([n, mean(1, dx), mean(2, dy), a[3] + b[3] + dx * dx * share, a[4] + b[4] + dy * dy * share,
                     a[5] + b[5] + dx * dy * share])


def correlations(df: DataFrame, columns: list[str], block: int = BLOCK_COLUMNS) -> DataFrame:
    """(a, b, r): all ordered pairs of ``columns``; null where a pair has no two rows or a constant side."""
    groups = [columns[i:i + block] for i in range(0, len(columns), block)]
    pairs = [(i, j) for i in range(len(groups)) for j in range(i, len(groups))]

    def packed(i: int, j: int, part: np.ndarray, salt: int) -> pd.DataFrame:
        return pd.DataFrame({"i": [i], "j": [j], "salt": [salt], "part": [part.astype("<f8").tobytes()]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = [batch[g].to_numpy(np.float64) for g in groups]
            for i, j in pairs:
                if len(batch):
                    part = _part(x[i], x[j])
                    held[(i, j)] = _merged(held[(i, j)], part) if (i, j) in held else part
        for (i, j), part in held.items():
            yield packed(i, j, part, TaskContext.get().partitionId() // MERGED)

    def fold(salted: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: dict[tuple[int, int, int], np.ndarray] = {}
            for batch in batches:
                for i, j, salt, part in batch.itertuples(index=False):
                    part = np.frombuffer(part, "<f8").reshape(6, len(groups[i]), len(groups[j]))
                    key = (i, j, salt if salted else 0)
                    held[key] = _merged(held[key], part) if key in held else part
            for (i, j, salt), part in held.items():
                yield packed(i, j, part, salt)
        return run

    def ratios(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, j, _, part in batch.itertuples(index=False):
                n, _, _, xx, yy, xy = np.frombuffer(part, "<f8").reshape(6, len(groups[i]), len(groups[j]))
                known = (n > 1) & (xx > 0) & (yy > 0)
                r = np.where(known, xy / np.sqrt(np.where(known, xx * yy, 1.0)), np.nan)
                for s, a in enumerate(groups[i]):
                    yield pd.DataFrame({"a": a, "b": groups[j], "r": r[s]})
                if i != j:
                    for t, b in enumerate(groups[j]):
                        yield pd.DataFrame({"a": b, "b": groups[i], "r": r[:, t]})

    picked = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    parts = picked.mapInPandas(count, PART_SCHEMA)
    folded = parts.repartition("i", "j", "salt").mapInPandas(fold(True), PART_SCHEMA)
    whole = folded.repartition("i", "j").mapInPandas(fold(False), PART_SCHEMA)
    out = whole.mapInPandas(ratios, "a string, b string, r double")
    return out.select("a", "b", F.when(~F.isnan("r"), F.col("r")).alias("r"))
