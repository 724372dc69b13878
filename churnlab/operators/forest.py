"""Random forests on binned features: all forests of a search in one go, rows scored while the trees grow.

The rows are cut into blocks of bin numbers once, as for boosting. Trees are
dealt to tasks, each of which gets all blocks, so this is for tables of which
a task may hold the bins (``fits_a_task``). The held-out rows go down every tree
with the rows it is grown from; only their probabilities, added up over a
task's trees, leave the task, never a tree: a deep tree has about as many nodes
as rows, and hundreds of them fit no driver.

A tree follows from the seed, its number and the paths of its nodes alone. A
shorter forest is therefore the start of a longer one, a shallower tree the top
of a deeper one, and trees that ask for different numbers of rows on a side are
one until their best splits differ. What forests have in common is done once,
and each gets the scores that it would get alone.

As in Spark's forests: rows are drawn with a Poisson count, every node tries
columns of its own, the split is the one of the largest Gini gain that leaves
``min_instances`` drawn rows on both sides, and a forest's probability is the
mean of its leaves' class shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.operators.boosting import binned_blocks, column_cuts, missing_bin

LEVEL_CELLS = 1 << 18  # sums that are held at once while a level's nodes are split
LEAST_GAIN = 1e-12


@dataclass(frozen=True)
class ForestParams:
    n_estimators: int = 100
    max_depth: int = 10
    min_instances: int = 1
    min_gain: float = 0.0
    columns: int = 1  # that a node tries
    bootstrap: bool = True
    class_weights: tuple[float, float] = (1.0, 1.0)
    seed: int = 0

    @property
    def kin(self) -> tuple:
        """Forests that are equal in this share their nodes."""
        return self.min_gain, self.columns, self.bootstrap, self.class_weights, self.seed


# ---------------------------------------------------------------- one tree

def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number (the finalizer of SplitMix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(kin: tuple, tree: int, block: int, n: int) -> np.ndarray:
    """How often the tree draws each row of the block."""
    _, _, bootstrap, _, seed = kin
    return np.random.default_rng([seed, tree, block]).poisson(1.0, n) if bootstrap else np.ones(n, np.int64)


def root_path(kin: tuple, tree: int) -> np.ndarray:
    return _mixed(_mixed(np.array([kin[4]], np.uint64)) + np.uint64(tree))


def child_paths(path: np.ndarray) -> np.ndarray:
    """The paths of both children of each node, left before right."""
    return _mixed(np.stack([path, path ^ np.uint64(1 << 63)], axis=1)).ravel()


def tried_columns(path: np.ndarray, width: int, take: int) -> np.ndarray:
    """The columns that each node tries, ascending."""
    if take >= width:
        return np.tile(np.arange(width), (len(path), 1))
    keys = _mixed(path[:, None] ^ _mixed(np.arange(width, dtype=np.uint64)))
    return np.sort(np.argsort(keys, axis=1)[:, :take], axis=1)


class _Rows:
    """Rows of one table by the node they lie in: node i has ``rows[start[i]:start[i + 1]]``."""

    def __init__(self, bins: np.ndarray, rows: np.ndarray):
        self.flat, self.width, self.rows = bins.ravel(), bins.shape[1], rows
        self.start = np.array([0, len(rows)])

    def nodes(self) -> np.ndarray:
        """The node of every row."""
        sizes = np.diff(self.start)
        return np.repeat(np.arange(len(sizes)), sizes)

    def keep(self, kept: np.ndarray) -> None:
        sizes = np.diff(self.start)
        self.rows = self.rows[np.repeat(kept, sizes)]
        self.start = np.concatenate([[0], np.cumsum(sizes[kept])])

    def deal(self, node: np.ndarray, column: np.ndarray, at: np.ndarray) -> None:
        """The rows behind the splits (node, column, at), bins up to ``at`` left; a node may have several splits or none."""
        sizes = np.diff(self.start)[node]
        ends = np.cumsum(sizes)
        begins = ends - sizes
        split, place = np.repeat(np.arange(len(node)), sizes), np.arange(sizes.sum())
        rows = self.rows[place + (self.start[node] - begins)[split]]
        right = self.flat.take(rows * self.width + column[split]) > at[split]
        rights = np.concatenate([[0], np.cumsum(right)])
        before = rights[:-1] - rights[begins][split]  # right ones of the same split before the row
        middle = ends - (rights[ends] - rights[begins])
        self.rows = np.empty_like(rows)
        self.rows[np.where(right, middle[split] + before, place - before)] = rows
        self.start = np.concatenate([np.stack([begins, middle], axis=1).ravel(), ends[-1:]])


def tree_scores(bins: np.ndarray, y: np.ndarray, n_bins: int, counts: np.ndarray, held: np.ndarray, kin: tuple, tree: int,
                shapes: list[tuple[int, int]]) -> np.ndarray:
    """P(class 1) of the ``held`` rows by one tree, a line for each shape (rows that a side needs, depth).

    ``bins`` and ``held`` are (rows, columns), ``counts`` says how often each row is drawn.
    """
    min_gain, take, _, weights, _ = kin
    least = np.array(sorted({m for m, _ in shapes}))
    deepest = np.array([max(d for m, d in shapes if m == one) for one in least])
    out, now = np.zeros((len(shapes), len(held))), np.zeros((len(least), len(held)))
    grown, asked = _Rows(bins, np.flatnonzero(counts)), _Rows(held, np.arange(len(held)))
    totals = np.bincount(y, counts, 2)[:, None]  # (class, node)
    path, members, depth = root_path(kin, tree), np.ones((1, len(least)), bool), 0
    while len(path):
        weighted = totals * np.array(weights)[:, None]
        share = weighted[1] / np.maximum(weighted.sum(axis=0), 1e-300)
        place = asked.nodes()
        for j in range(len(least)):
            inside = members[place, j]
            now[j, asked.rows[inside]] = share[place[inside]]
        for s, (m, d) in enumerate(shapes):
            if d == depth:
                out[s] = now[np.searchsorted(least, m)]
        members = members & (depth < deepest) & (totals.sum(axis=0)[:, None] >= 2 * least) & (totals.min(axis=0) > 0)[:, None]
        open_nodes = members.any(axis=1)
        for rows in (grown, asked):
            rows.keep(open_nodes)
        totals, path, members = totals[:, open_nodes], path[open_nodes], members[open_nodes]
        if not len(path):
            break
        node, column, at, left, members = _splits(grown, y, counts, n_bins, totals, tried_columns(path, grown.width, take),
                                                  members, least, weights, min_gain)
        totals = np.stack([left, totals[:, node] - left], axis=2).reshape(2, -1)
        path = child_paths(path[node])
        members = np.repeat(members, 2, axis=0)
        for rows in (grown, asked):
            rows.deal(node, column, at)
        depth += 1
    for s, (m, d) in enumerate(shapes):
        if d >= depth:
            out[s] = now[np.searchsorted(least, m)]
    return out


def _splits(grown: _Rows, y: np.ndarray, counts: np.ndarray, n_bins: int, totals: np.ndarray, tried: np.ndarray,
            members: np.ndarray, least: np.ndarray, weights: tuple[float, float], min_gain: float) -> tuple[np.ndarray, ...]:
    """The different best splits of a level: (node, column, bin, drawn rows left by class, which of ``least`` take it)."""
    take = tried.shape[1]
    step = max(1, LEVEL_CELLS // (2 * take * n_bins))
    parts = []
    for a in range(0, len(tried), step):
        b = min(a + step, len(tried))
        rows, size = grown.rows[grown.start[a]:grown.start[b]], (b - a) * take * n_bins
        place = np.repeat(np.arange(b - a), np.diff(grown.start[a:b + 1]))
        cells = grown.flat.take((rows * grown.width)[:, None] + tried[a:b][place])
        cells = cells + ((place * take * n_bins + y[rows] * size)[:, None] + np.arange(take) * n_bins)
        sums = np.bincount(cells.ravel(), np.repeat(counts[rows], take), 2 * size).reshape(2, b - a, take * n_bins)
        left = np.cumsum(sums.reshape(2, b - a, take, n_bins), axis=-1)[..., :-1].reshape(2, b - a, -1)
        found = _best(left, totals[:, a:b], members[a:b], least, weights, min_gain)
        node, js = np.nonzero(found >= 0)
        key, which = np.unique(node * left.shape[2] + found[node, js], return_inverse=True)
        node, split = np.divmod(key, left.shape[2])
        taken = np.zeros((len(key), len(least)), bool)
        taken[which, js] = True
        parts.append((node + a, tried[node + a, split // (n_bins - 1)], split % (n_bins - 1), left[:, node, split], taken))
    node, column, at, sums, taken = zip(*parts)
    return np.concatenate(node), np.concatenate(column), np.concatenate(at), np.concatenate(sums, axis=1), np.concatenate(taken)


def _best(left: np.ndarray, totals: np.ndarray, members: np.ndarray, least: np.ndarray, weights: tuple[float, float],
          min_gain: float) -> np.ndarray:
    """(node, least): the number of the split of the largest gain, the first among equals; -1 where there is none."""
    smaller = left.sum(axis=0)
    smaller = np.minimum(smaller, totals.sum(axis=0)[:, None] - smaller)
    weigh = np.array(weights)[:, None]
    all_0, all_1 = totals * weigh
    left_0, left_1 = left * weigh[..., None]
    right_0, right_1 = all_0[:, None] - left_0, all_1[:, None] - left_1
    # the Gini impurity of both sides, by their weights, is twice this over the node's weight
    mixed = left_0 * left_1 / np.maximum(left_0 + left_1, 1e-300) + right_0 * right_1 / np.maximum(right_0 + right_1, 1e-300)
    weight = all_0 + all_1
    # what differs by rounding only counts as equal
    mixed, whole = np.round(mixed, 9), np.round(all_0 * all_1 / weight, 9)
    out = np.full(members.shape, -1)
    last, ended = np.full(len(members), -1), np.zeros(len(members), bool)
    for j, m in enumerate(least):
        want = members[:, j] & ~ended
        # the best split for fewer rows on a side is the best one here too, if it has enough
        same = want & (last >= 0)
        same[same] = smaller[same, last[same]] >= m
        out[same, j] = last[same]
        new = np.flatnonzero(want & ~same)
        if len(new):
            options = np.where(smaller[new] >= m, mixed[new], np.inf)
            first = options.argmin(axis=1)
            gain = 2 * (whole[new] - options[np.arange(len(new)), first]) / weight[new]
            good = gain >= max(min_gain, LEAST_GAIN)
            last[new[good]] = out[new[good], j] = first[good]
            ended[new[~good]] = True
    return out


# ---------------------------------------------------------------- all trees

class _Dealt:
    """A stored block for every task."""

    def __init__(self, tasks: int, held: bool):
        self.tasks, self.held = tasks, held

    def __call__(self, row) -> list[tuple]:
        block = (self.held, row["block"], row["n"], bytes(row["bins"]), bytes(row["y"]))
        return [(task, block) for task in range(self.tasks)]


class _Grown:
    """The trees of one task: per held block the fits' probabilities, added up over those trees."""

    def __init__(self, fits: list[ForestParams], width: int, n_bins: int, tasks: int):
        self.fits, self.width, self.n_bins, self.tasks = fits, width, n_bins, tasks

    def __call__(self, group: tuple) -> Iterator[tuple]:
        task, blocks = group
        blocks = sorted(blocks, key=lambda b: b[:2])
        table = [np.concatenate([np.zeros((0, self.width), np.uint8), *[
            np.frombuffer(b[3], np.uint8).reshape(self.width, b[2]).T for b in blocks if b[0] == held]]) for held in (False, True)]
        bins, held = (np.ascontiguousarray(t) for t in table)
        y = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(b[4], np.uint8).astype(np.int64) for b in blocks if not b[0]]])
        sums = np.zeros((len(self.fits), len(held)))
        for kin in dict.fromkeys(p.kin for p in self.fits):
            for tree in range(task, max(p.n_estimators for p in self.fits if p.kin == kin), self.tasks):
                of = [(f, (p.min_instances, p.max_depth)) for f, p in enumerate(self.fits) if p.kin == kin and tree < p.n_estimators]
                shapes = sorted({shape for _, shape in of})
                counts = np.concatenate([drawn(kin, tree, b[1], b[2]) for b in blocks if not b[0]]).astype(np.float64)
                found = tree_scores(bins, y, self.n_bins, counts, held, kin, tree, shapes)
                for f, shape in of:
                    sums[f] += found[shapes.index(shape)]
        start = 0
        for _, block, n, _, labels in (b for b in blocks if b[0]):
            yield block, (task, labels, sums[:, start:start + n].tobytes())
            start += n


class _Mean:
    """The forests' probabilities of one held block, a row per fit."""

    def __init__(self, fits: dict[int, ForestParams]):
        self.fits = fits

    def __call__(self, group: tuple) -> Iterator[tuple]:
        parts = sorted(group[1])  # in the order of the tasks, so that the sums are always the same
        labels = parts[0][1]
        p = sum(np.frombuffer(part[2], np.float64).reshape(len(self.fits), len(labels)) for part in parts)
        for (fit, params), line in zip(self.fits.items(), p):
            yield fit, labels, (line / params.n_estimators).tobytes()


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for fit, labels, p in batch.itertuples(index=False):
            p = np.frombuffer(p, np.float64)
            yield pd.DataFrame({"fit": np.int32(fit), "label": np.frombuffer(labels, np.uint8).astype(np.int32), "p1": p,
                                "prediction": (p > 0.5).astype(np.int32)})


def forest_scores(rows: DataFrame, held: DataFrame, vector: Column, width: int, label: Column, fits: dict[int, ForestParams],
                  max_bins: int = 32) -> DataFrame:
    """(fit, label, p1, prediction) of every ``held`` row by every forest, grown on ``rows``.

    ``vector`` is an array of ``width`` doubles without missing values.
    """
    if not 2 <= max_bins <= 254:
        raise ValueError(f"max_bins must lie between 2 and 254, not {max_bins}")
    if min(p.n_estimators for p in fits.values()) < 1:
        raise ValueError("a forest has one tree at least")
    spark = rows.sparkSession
    cuts, n = column_cuts(rows, vector, width, max_bins)
    blocks = binned_blocks(rows, vector, label, F.lit(1.0), cuts, n)
    asked = binned_blocks(held, vector, label, F.lit(1.0), cuts, held.count())
    # two for each core, so that tasks which start late do not leave the others waiting
    tasks = min(max(p.n_estimators for p in fits.values()), 2 * spark.sparkContext.defaultParallelism)
    sent = blocks.rdd.flatMap(_Dealt(tasks, False)).union(asked.rdd.flatMap(_Dealt(tasks, True)))
    grown = sent.groupByKey(tasks).flatMap(_Grown(list(fits.values()), width, max(2, missing_bin(cuts)), tasks))
    means = grown.groupByKey(max(1, min(tasks, asked.count()))).flatMap(_Mean(fits))
    return spark.createDataFrame(means, "fit int, y binary, p binary").mapInPandas(_unpacked, "fit int, label int, p1 double, prediction int")
