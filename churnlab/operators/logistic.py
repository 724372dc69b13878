"""L2 logistic regression by a trust-region Newton method, any number of fits in one scan.

A fit minimises C * sum(w * loss) + |b|^2 / 2, with the intercept free or
penalised like a coefficient. Each fit is a generator that asks for a gradient
at a point or for a Hessian-vector product and waits; one pass over the stored
blocks answers all fits that wait, so k fits cost the passes of the slowest one.
Only d + 2 numbers per fit and pass reach the driver (Lin, Weng & Keerthi, 2008).
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.session import checkpoint

BLOCK_ROWS = 4096
BLOCK_SCHEMA = "n int, x binary, y binary"


@dataclass(frozen=True)
class LogisticParams:
    C: float = 1.0
    max_iter: int = 1000
    tol: float = 1e-8  # of the gradient's norm at the start
    fit_intercept: bool = True
    penalise_intercept: bool = False
    class_weights: tuple[float, float] = (1.0, 1.0)


def dense_blocks(rows: DataFrame, vector: Column, label: Column) -> DataFrame:
    """(n, x, y): up to ``BLOCK_ROWS`` rows each, stored in the shared folder."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[a:a + BLOCK_ROWS]
                x = np.stack(part["x"].tolist()).astype("<f8")
                yield pd.DataFrame({"n": [len(part)], "x": [x.tobytes()], "y": [part["y"].to_numpy(np.uint8).tobytes()]})

    picked = rows.select(vector.alias("x"), label.cast("int").alias("y"))
    return checkpoint(picked.mapInPandas(pack, BLOCK_SCHEMA))


class _Answers:
    """What one block adds to the answers: per request loss, then gradient or Hessian-vector product."""

    def __init__(self, requests: list[tuple], params: list[LogisticParams]):
        self.requests, self.params = requests, params

    def __call__(self, row) -> np.ndarray:
        x = np.frombuffer(row["x"], "<f8").reshape(row["n"], -1)
        x = np.hstack([x, np.ones((len(x), 1))])
        y = np.frombuffer(row["y"], np.uint8).astype(np.float64)
        out = np.zeros((len(self.requests), x.shape[1] + 1))
        for i, ((kind, w, v), p) in enumerate(zip(self.requests, self.params)):
            z, weight = x @ w, np.where(y > 0, p.class_weights[1], p.class_weights[0])
            q = 1 / (1 + np.exp(-z))
            if kind == "gradient":
                out[i, 0] = (weight * (np.logaddexp(0, z) - y * z)).sum()
                out[i, 1:] = x.T @ (weight * (q - y))
            else:
                out[i, 1:] = x.T @ (weight * q * (1 - q) * (x @ v))
        return out


def _summed(parts: RDD) -> np.ndarray:
    depth = max(1, int(np.ceil(np.log(max(2, parts.getNumPartitions())) / np.log(64))))
    return parts.treeReduce(np.add, depth)


def _newton(p: LogisticParams, size: int) -> Generator[tuple, np.ndarray, np.ndarray]:
    """Coefficients and intercept; yields ("gradient", w, None) and ("product", w, v) and is sent the sums over all rows."""
    active = np.ones(size)
    active[-1] = 1.0 if p.fit_intercept else 0.0
    penalty = np.ones(size)
    penalty[-1] = 1.0 if p.penalise_intercept else 0.0

    def at(w: np.ndarray):
        sums = yield "gradient", w, None
        return p.C * sums[0] + 0.5 * (penalty * w * w).sum(), active * (p.C * sums[1:] + penalty * w)

    w = np.zeros(size)
    value, g = yield from at(w)
    radius = first = float(np.linalg.norm(g))
    for _ in range(p.max_iter):
        if np.linalg.norm(g) <= p.tol * max(first, 1e-300):
            break
        # conjugate gradients inside the trust region
        step, rest, d = np.zeros(size), -g, -g
        while np.linalg.norm(rest) > 0.05 * np.linalg.norm(g):
            product = active * (p.C * (yield "product", w, d)[1:] + penalty * d)
            curve = d @ product
            length = (rest @ rest) / curve if curve > 0 else np.inf
            if not np.isfinite(length) or np.linalg.norm(step + length * d) > radius:
                # to the edge of the region along d
                a, b, c = d @ d, 2 * step @ d, step @ step - radius ** 2
                step = step + (-b + np.sqrt(max(b * b - 4 * a * c, 0))) / (2 * a) * d
                break
            step = step + length * d
            after = rest - length * product
            d = after + (after @ after) / (rest @ rest) * d
            rest = after
        product = active * (p.C * (yield "product", w, step)[1:] + penalty * step)
        promised = -(g @ step + 0.5 * step @ product)
        new_value, new_g = yield from at(w + step)
        ratio = (value - new_value) / promised if promised > 0 else -1.0
        size_of_step = float(np.linalg.norm(step))
        if ratio < 0.25:
            radius = 0.25 * min(radius, size_of_step) if ratio <= 0 else 0.5 * min(radius, size_of_step)
        elif ratio > 0.75:
            radius = max(radius, 3 * size_of_step)
        if ratio > 1e-4:
            w, value, g = w + step, new_value, new_g
        elif promised <= 1e-14 * max(abs(value), 1.0):
            break  # what is left to gain is rounding
    return w


def fit_logistic(rows: DataFrame, vector: Column, width: int, label: Column, fits: list[LogisticParams]) -> list[np.ndarray]:
    """Per fit its ``width`` coefficients and the intercept; the rows are read once and kept as stored blocks."""
    blocks = dense_blocks(rows, vector, label).rdd.persist(StorageLevel.MEMORY_AND_DISK)
    solved: list[np.ndarray | None] = [None] * len(fits)
    waiting = {}
    for i, p in enumerate(fits):
        solver = _newton(p, width + 1)
        waiting[i] = (solver, next(solver))
    try:
        while waiting:
            order = list(waiting)
            sums = _summed(blocks.map(_Answers([waiting[i][1] for i in order], [fits[i] for i in order])))
            for i, found in zip(order, sums):
                solver = waiting[i][0]
                try:
                    waiting[i] = (solver, solver.send(found))
                except StopIteration as done:
                    solved[i] = done.value
                    del waiting[i]
    finally:
        blocks.unpersist()
    return solved
