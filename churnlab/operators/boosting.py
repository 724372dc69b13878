"""Second-order gradient boosting on binned features, any number of fits in one scan.

The rows are cut into blocks of bin numbers once and stored. A pass over the
blocks sums gradients and hessians of the logistic loss per (fit, node, column,
bin); the sums of all blocks are added up on the way and the driver, which sees
histograms only, chooses the splits of one level of one tree of every fit. So k
fits cost the passes of the longest one. A row's margin is kept next to its
block and moves on by one tree at a time; every ``CHECKPOINT_TREES`` trees the
blocks are written to the shared checkpoint folder, so a lost executor costs a
few trees' recomputation. Where all bins together are small (``TASK_CELLS``,
up to ``TASK_FITS`` times that for as many fits), the passes would cost only
their start: every fit then gets the blocks into a task of its own and goes
through the same rounds there.

Leaf weight -T(G) / (H + lambda), split gain T(G_l)^2 / (H_l + lambda) + T(G_r)^2 /
(H_r + lambda) - T(G)^2 / (H + lambda), where T takes ``reg_alpha`` off the
absolute value (Chen & Guestrin, 2016). Missing values (null, NaN) have a bin of
their own, and a split sends them to the side where the gain is larger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.session import checkpoint, ensure_checkpoint_dir

BLOCK_ROWS = 4096
CHECKPOINT_TREES = 20
HISTOGRAM_BYTES = 64_000_000  # histograms of one pass; more nodes are asked for in several passes
TASK_CELLS = 1 << 20  # bins (rows x columns, a byte each) that one task may hold to grow a fit alone
TASK_FITS = 16  # and so many times as many where there are as many fits: tasks with a fit each then keep the cores busy
LEAST_GAIN = 1e-6
BLOCK_SCHEMA = "block long, n int, bins binary, y binary, w binary"


@dataclass(frozen=True)
class BoostParams:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    pos_weight: float = 1.0
    seed: int = 0


@dataclass
class Tree:
    """Nodes by number; ``feature`` -1 marks a leaf. Rows with bin <= ``bin`` go left, missing ones where ``missing_left`` says."""

    feature: list[int]
    bin: list[int]
    missing_left: list[bool]
    left: list[int]
    right: list[int]
    value: list[float]

    @classmethod
    def root(cls) -> Tree:
        return cls([-1], [0], [False], [-1], [-1], [0.0])

    def split(self, node: int, feature: int, at: int, missing_left: bool) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.bin[node], self.missing_left[node] = feature, at, missing_left
        self.left[node], self.right[node] = left, left + 1
        for _ in range(2):
            for column, start in zip((self.feature, self.bin, self.missing_left, self.left, self.right, self.value),
                                     (-1, 0, False, -1, -1, 0.0)):
                column.append(start)
        return left, left + 1

    def leaves(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The leaf of every row of ``bins`` (columns, rows)."""
        feature, at, left, right = (np.asarray(x, np.int32) for x in (self.feature, self.bin, self.left, self.right))
        missing_left = np.asarray(self.missing_left, bool)
        node = np.zeros(bins.shape[1], np.int32)
        rows = np.arange(bins.shape[1])
        while len(rows := rows[feature[node[rows]] >= 0]):
            here = node[rows]
            b = bins[feature[here], rows]
            goes_left = np.where(b == missing, missing_left[here], b <= at[here])
            node[rows] = np.where(goes_left, left[here], right[here])
        return node


# ---------------------------------------------------------------- binned blocks

def column_cuts(rows: DataFrame, vector: Column, width: int, max_bins: int) -> tuple[list[np.ndarray], int]:
    """Per column the ascending cuts between bins, and the row count.

    A column of at most ``max_bins`` distinct values has a bin for each, others
    are cut at as many quantiles. A cut is the smallest value of its bin.
    """
    shares = F.array(*[F.lit(i / max_bins) for i in range(max_bins + 1)])
    values = [F.when(~F.isnan(vector[i]), vector[i]) for i in range(width)]
    found = rows.agg(F.count("*"), *[F.approx_count_distinct(v) for v in values],
                     *[F.percentile_approx(v, shares, 10_000) for v in values]).first()
    n, distinct, quantiles = found[0], found[1:width + 1], found[width + 1:]
    # the estimate of a small count is nearly exact; values of the columns that may have few are listed, then counted
    few = [i for i in range(width) if distinct[i] <= 1.2 * max_bins]
    listed: dict[int, list[float]] = {i: [] for i in few}
    if few:
        each = F.inline(F.array(*[F.struct(F.lit(i).alias("column"), values[i].alias("value")) for i in few]))
        for r in rows.select(each).where("value is not null").distinct().collect():
            listed[r["column"]].append(r["value"])
    bins = [listed[i] if len(listed.get(i, ())) <= max_bins and i in listed else quantiles[i] for i in range(width)]
    return [np.unique(np.asarray(q if q is not None else [], np.float64))[1:] for q in bins], n


def binned_blocks(rows: DataFrame, vector: Column, label: Column, weight: Column, cuts: list[np.ndarray],
                  n: int) -> DataFrame:
    """(block, n, bins, y, w): up to ``BLOCK_ROWS`` rows each, column by column, stored in the shared folder."""
    missing = missing_bin(cuts)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made, held = TaskContext.get().partitionId(), 0, []

        def block(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> pd.DataFrame:
            bins = np.empty((len(cuts), len(x)), np.uint8)
            for i, c in enumerate(cuts):
                bins[i] = np.where(np.isnan(x[:, i]), missing, np.searchsorted(c, x[:, i], "right"))
            return pd.DataFrame({"block": [(part << 32) + made], "n": [len(x)], "bins": [bins.tobytes()],
                                 "y": [y.astype(np.uint8).tobytes()], "w": [w.astype("<f8").tobytes()]})

        for batch in batches:
            if not len(batch):
                continue
            held.append((np.stack(batch["x"].tolist()).astype(np.float64), batch["y"].to_numpy(), batch["w"].to_numpy(np.float64)))
            if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                x, y, w = (np.concatenate(c) for c in zip(*held))
                cut = len(y) - len(y) % BLOCK_ROWS
                for a in range(0, cut, BLOCK_ROWS):
                    yield block(x[a:a + BLOCK_ROWS], y[a:a + BLOCK_ROWS], w[a:a + BLOCK_ROWS])
                    made += 1
                held = [(x[cut:], y[cut:], w[cut:])]
        if held and sum(len(h[1]) for h in held):
            yield block(*(np.concatenate(c) for c in zip(*held)))

    picked = rows.select(vector.alias("x"), label.cast("int").alias("y"), weight.cast("double").alias("w"))
    return checkpoint(picked.coalesce(max(1, -(-n // BLOCK_ROWS))).mapInPandas(pack, BLOCK_SCHEMA))


def fits_a_task(rows: int, width: int, fits: int) -> bool:
    """Whether each of so many fits is grown by a task that holds the bins of all rows; a few fits of many rows are shared out by rows."""
    return 0 < rows * width <= TASK_CELLS * min(fits, TASK_FITS)


def missing_bin(cuts: list[np.ndarray]) -> int:
    return max((len(c) for c in cuts), default=0) + 1


# ---------------------------------------------------------------- what runs on a block

class _Open:
    """A stored row as arrays, with a margin of 0 for every fit."""

    def __init__(self, columns: int, fits: int):
        self.columns, self.fits = columns, fits

    def __call__(self, row) -> tuple:
        bins = np.frombuffer(row["bins"], np.uint8).reshape(self.columns, row["n"])
        return (row["block"], bins, np.frombuffer(row["y"], np.uint8).astype(np.float64), np.frombuffer(row["w"], "<f8"),
                np.zeros((self.fits, row["n"])))


class _Advance:
    """The block with the margins moved on by each fit's newest tree."""

    def __init__(self, trees: dict[int, Tree], missing: int):
        self.trees, self.missing = trees, missing

    def __call__(self, state: tuple) -> tuple:
        block, bins, y, w, margins = state
        margins = margins.copy()
        for f, tree in self.trees.items():
            margins[f] += np.asarray(tree.value)[tree.leaves(bins, self.missing)]
        return block, bins, y, w, margins


class _Histograms:
    """Sums of gradients and hessians of one block: per fit (2, asked nodes, columns, bins)."""

    def __init__(self, fits: dict[int, BoostParams], round_no: int, trees: dict[int, Tree], asked: dict[int, list[int]],
                 columns: dict[int, np.ndarray], missing: int):
        self.fits, self.round_no, self.trees, self.asked = fits, round_no, trees, asked
        self.columns, self.missing = columns, missing

    def __call__(self, state: tuple) -> dict[int, np.ndarray]:
        block, bins, y, w, margins = state
        width, out = self.missing + 1, {}
        for f, nodes in self.asked.items():
            p, tree, columns = self.fits[f], self.trees[f], self.columns[f]
            place = np.full(len(tree.feature), -1, np.int64)
            place[nodes] = np.arange(len(nodes))
            at = place[tree.leaves(bins, self.missing)]
            chosen = at >= 0
            if p.subsample < 1:
                chosen &= np.random.default_rng([p.seed, self.round_no, block]).random(len(y)) < p.subsample
            rows = np.flatnonzero(chosen)
            q = 1 / (1 + np.exp(-margins[f, rows]))
            weight = w[rows] * np.where(y[rows] > 0, p.pos_weight, 1.0)
            cells = (at[rows] * len(columns) + np.arange(len(columns))[:, None]) * width + bins[columns][:, rows]
            size = len(nodes) * len(columns) * width
            sums = [np.bincount(cells.ravel(), np.broadcast_to(x, cells.shape).ravel(), size)
                    for x in (weight * (q - y[rows]), weight * q * (1 - q))]
            out[f] = np.stack(sums).reshape(2, len(nodes), len(columns), width)
        return out


def _add(a: dict[int, np.ndarray], b: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    return {f: a[f] + b[f] for f in a}


def _summed(parts: RDD) -> dict[int, np.ndarray]:
    """All blocks' histograms added up, no task and not the driver merging more than about 64 at once."""
    depth = max(1, int(np.ceil(np.log(max(2, parts.getNumPartitions())) / np.log(64))))
    return parts.treeReduce(_add, depth)


# ---------------------------------------------------------------- splits

def _taken(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0) if alpha else g


def best_splits(hist: np.ndarray, p: BoostParams) -> list[tuple | None]:
    """Per node of ``hist`` (2, nodes, columns, bins; the last bin holds the missing) the best split or None.

    A split is (column, bin, missing goes left, gain, (G, H) left, (G, H) right).
    Among equal gains the first column wins, then the smallest bin, then missing
    to the right.
    """
    g, h = hist
    both_g, both_h = g[:, 0].sum(axis=-1), h[:, 0].sum(axis=-1)
    score = lambda a, b: _taken(a, p.reg_alpha) ** 2 / np.maximum(b + p.reg_lambda, 1e-16)
    options = []
    for missing_left in (False, True):
        lg, lh = np.cumsum(g[..., :-1], axis=-1), np.cumsum(h[..., :-1], axis=-1)
        if missing_left:
            lg, lh = lg + g[..., -1:], lh + h[..., -1:]
        rg, rh = both_g[:, None, None] - lg, both_h[:, None, None] - lh
        gain = score(lg, lh) + score(rg, rh) - score(both_g, both_h)[:, None, None]
        least = max(p.min_child_weight, 1e-12)
        options.append((np.where((lh >= least) & (rh >= least), gain, -np.inf), lg, lh))
    gains = np.stack([o[0] for o in options], axis=-1)  # nodes, columns, bins, side of the missing
    out: list[tuple | None] = []
    for node in range(gains.shape[0]):
        # sums that differ by rounding only count as equal
        flat = np.round(gains[node], 9).ravel()
        best = int(np.argmax(flat)) if flat.size else -1
        if best < 0 or not flat[best] > max(LEAST_GAIN, 0) or flat[best] < p.gamma:
            out.append(None)
            continue
        column, at, side = np.unravel_index(best, gains[node].shape)
        left = (float(options[side][1][node, column, at]), float(options[side][2][node, column, at]))
        right = (float(both_g[node]) - left[0], float(both_h[node]) - left[1])
        out.append((int(column), int(at), bool(side), float(flat[best]), left, right))
    return out


def leaf_weight(sums: tuple[float, float], p: BoostParams) -> float:
    g, h = sums
    return -p.learning_rate * float(_taken(np.float64(g), p.reg_alpha)) / max(h + p.reg_lambda, 1e-16)


# ---------------------------------------------------------------- fitting

def fit_boosted(rows: DataFrame, vector: Column, width: int, label: Column, weight: Column, fits: list[BoostParams],
                max_bins: int = 64) -> list[tuple[list[Tree], list[np.ndarray]]]:
    """(trees, cuts per column) of every fit; ``rows`` are read twice, for the cuts and for the blocks.

    ``vector`` is an array of ``width`` doubles, null and NaN are missing values.
    ``max_bins`` is at most 254. Of fits that differ in their number of trees
    only, the shorter ones are the start of the longest.
    """
    if not 2 <= max_bins <= 254:
        raise ValueError(f"max_bins must lie between 2 and 254, not {max_bins}")
    ensure_checkpoint_dir(rows.sparkSession)
    longest: dict[BoostParams, BoostParams] = {}
    for p in sorted(fits, key=lambda p: p.n_estimators):
        longest[replace(p, n_estimators=0)] = p
    found = dict(zip(longest, _fitted(rows, vector, width, label, weight, list(longest.values()), max_bins)))
    return [(trees[:p.n_estimators], cuts) for p in fits for trees, cuts in [found[replace(p, n_estimators=0)]]]


def _fitted(rows: DataFrame, vector: Column, width: int, label: Column, weight: Column, fits: list[BoostParams],
            max_bins: int) -> list[tuple[list[Tree], list[np.ndarray]]]:
    cuts, n = column_cuts(rows, vector, width, max_bins)
    missing = missing_bin(cuts)
    blocks = binned_blocks(rows, vector, label, weight, cuts, n)
    if fits_a_task(n, width, len(fits)):
        return [(trees, cuts) for trees in _grown_apart(blocks, fits, width, missing)]
    state = blocks.rdd.map(_Open(width, len(fits))).persist(StorageLevel.MEMORY_AND_DISK)
    forests: list[list[Tree]] = [[] for _ in fits]
    try:
        for round_no in range(max((p.n_estimators for p in fits), default=0)):
            live = {f: p for f, p in enumerate(fits) if round_no < p.n_estimators}
            old = None
            if round_no:
                old, state = state, state.map(_Advance({f: forests[f][-1] for f in live}, missing)).persist(
                    StorageLevel.MEMORY_AND_DISK)
                if round_no % CHECKPOINT_TREES == 0:
                    state.checkpoint()
            trees = _grow(lambda made: _summed(state.map(made)), live, round_no, width, missing)
            for f, tree in trees.items():
                forests[f].append(tree)
            if old is not None:
                old.unpersist()
    finally:
        state.unpersist()
    return [(trees, cuts) for trees in forests]


class _Table:
    """All blocks of one fit in a task: a row's node is kept while a tree grows, so a level costs one step a row."""

    def __init__(self, rows: list, width: int, missing: int, p: BoostParams):
        opened = [_Open(width, 0)(row) for row in sorted(rows, key=lambda row: row["block"])]
        self.p, self.missing = p, missing
        self.blocks = [(block, len(y)) for block, _, y, _, _ in opened]
        self.bins = np.concatenate([b for _, b, _, _, _ in opened], axis=1)
        self.y, self.w = (np.concatenate([o[i] for o in opened]) for i in (2, 3))
        self.gaps = bool((self.bins == missing).any())
        self.margins = np.zeros(len(self.y))

    def begin(self, round_no: int) -> None:
        p = self.p
        q = 1 / (1 + np.exp(-self.margins))
        weight = self.w * np.where(self.y > 0, p.pos_weight, 1.0)
        self.g, self.h = weight * (q - self.y), weight * q * (1 - q)
        self.drawn = None
        if p.subsample < 1:
            self.drawn = np.concatenate([np.random.default_rng([p.seed, round_no, block]).random(n) < p.subsample for block, n in self.blocks])
        self.node = np.zeros(len(self.y), np.int32)

    def descend(self, tree: Tree) -> None:
        """Every row to the leaf that it has reached so far."""
        feature, left = np.asarray(tree.feature, np.int64), np.asarray(tree.left, np.int32)
        at, missing_left, flat = np.asarray(tree.bin, np.uint8), np.asarray(tree.missing_left, bool), self.bins.ravel()
        inner, begins = feature >= 0, feature * len(self.node)
        rows = np.flatnonzero(inner[self.node])
        while len(rows):
            here = self.node[rows]
            b = flat.take(begins[here] + rows)
            right = b > at[here]
            if self.gaps:
                right = np.where(b == self.missing, ~missing_left[here], right)
            self.node[rows] = reached = left[here] + right  # the right child is the one after the left
            rows = rows[inner[reached]]

    def sums(self, made: _Histograms) -> dict[int, np.ndarray]:
        """What ``made`` gives for all blocks, added up."""
        tree, nodes, columns, width = made.trees[0], made.asked[0], made.columns[0], self.missing + 1
        self.descend(tree)
        place = np.full(len(tree.feature), -1, np.int64)
        place[nodes] = np.arange(len(nodes))
        at = place[self.node]
        rows = np.flatnonzero(at >= 0 if self.drawn is None else (at >= 0) & self.drawn)
        at, g, h = at[rows] * width, self.g[rows], self.h[rows]
        out = np.empty((2, len(nodes), len(columns), width))
        for i, column in enumerate(columns):
            cells = at + self.bins[column].take(rows)
            for side, x in enumerate((g, h)):
                out[side, :, i] = np.bincount(cells, x, len(nodes) * width).reshape(len(nodes), width)
        return {0: out}

    def end(self, tree: Tree) -> None:
        self.descend(tree)
        self.margins += np.asarray(tree.value)[self.node]


class _Apart:
    """All rounds of one fit over all blocks, in a task."""

    def __init__(self, fits: list[BoostParams], width: int, missing: int):
        self.fits, self.width, self.missing = fits, width, missing

    def __call__(self, group: tuple) -> tuple[int, list[Tree]]:
        f, rows = group
        p, trees = self.fits[f], []
        table = _Table(list(rows), self.width, self.missing, p)
        for round_no in range(p.n_estimators):
            table.begin(round_no)
            trees.append(_grow(table.sums, {0: p}, round_no, self.width, self.missing)[0])
            table.end(trees[-1])
        return f, trees


def _grown_apart(blocks: DataFrame, fits: list[BoostParams], width: int, missing: int) -> list[list[Tree]]:
    """The trees of every fit, each grown by a task of its own; the longest start first."""
    order = sorted(range(len(fits)), key=lambda f: -fits[f].n_estimators * fits[f].max_depth)
    sent = blocks.rdd.flatMap(lambda row: [(place, row) for place in range(len(order))])
    grown = dict(sent.groupByKey(max(1, len(order))).map(_Apart([fits[f] for f in order], width, missing)).collect())
    return [grown[order.index(f)] for f in range(len(fits))]


def _grow(sums: Callable[[_Histograms], dict[int, np.ndarray]], live: dict[int, BoostParams], round_no: int, width: int,
          missing: int) -> dict[int, Tree]:
    """The next tree of every fit, level by level; ``sums`` adds up what its argument makes of each block."""
    trees = {f: Tree.root() for f in live}
    columns = {f: _columns(p, round_no, width) for f, p in live.items()}
    # nodes to be split on this level: number, parent's histogram and sibling for those that are a difference
    level: dict[int, list[tuple[int, int | None]]] = {f: [(0, None)] for f, p in live.items() if p.max_depth > 0}
    hists: dict[int, dict[int, np.ndarray]] = {f: {} for f in live}
    depth = 0
    while level:
        asked = {f: [node for node, sibling in nodes if sibling is None] for f, nodes in level.items()}
        for f, found in _ask(sums, live, round_no, trees, asked, columns, missing).items():
            hists[f].update(zip(asked[f], found.transpose(1, 0, 2, 3)))
        following: dict[int, list[tuple[int, int | None]]] = {}
        for f, nodes in level.items():
            p, tree = live[f], trees[f]
            for node, sibling in nodes:
                if sibling is not None:  # the parent's sums are still under the sibling's number with a minus
                    hists[f][node] = hists[f].pop(-1 - sibling) - hists[f][sibling]
            stack = np.stack([hists[f][node] for node, _ in nodes], axis=1)
            if depth == 0:
                tree.value[0] = leaf_weight(tuple(stack[:, 0, 0].sum(axis=-1)), p)
            for (node, _), found in zip(nodes, best_splits(stack, p)):
                hist = hists[f].pop(node)
                if found is None:
                    continue
                column, at, missing_left, _, left, right = found
                sides = tree.split(node, int(columns[f][column]), at, missing_left)
                for side, of_side in zip(sides, (left, right)):
                    tree.value[side] = leaf_weight(of_side, p)
                if depth + 1 < p.max_depth:
                    # the lighter child is counted, the other is the difference
                    light, heavy = sides if left[1] <= right[1] else sides[::-1]
                    hists[f][-1 - light] = hist
                    following.setdefault(f, []).extend([(light, None), (heavy, light)])
        level, depth = following, depth + 1
    return trees


def _columns(p: BoostParams, round_no: int, width: int) -> np.ndarray:
    take = max(1, int(p.colsample_bytree * width)) if p.colsample_bytree < 1 else width
    return np.sort(np.random.default_rng([p.seed, round_no]).permutation(width)[:take])


def _ask(sums: Callable[[_Histograms], dict[int, np.ndarray]], live: dict[int, BoostParams], round_no: int,
         trees: dict[int, Tree], asked: dict[int, list[int]], columns: dict[int, np.ndarray], missing: int) -> dict[int, np.ndarray]:
    """Histograms (2, nodes, columns, bins) of the asked nodes per fit, in as many passes as their size calls for."""
    out: dict[int, list[np.ndarray]] = {f: [] for f in asked}
    batch: dict[int, list[int]] = {}
    size = 0

    def run() -> None:
        fits = {f: live[f] for f in batch}
        made = _Histograms(fits, round_no, {f: trees[f] for f in batch}, dict(batch), columns, missing)
        for f, found in sums(made).items():
            out[f].append(found)

    for f, nodes in asked.items():
        for node in nodes:
            bytes_of = 16 * len(columns[f]) * (missing + 1)
            if batch and size + bytes_of > HISTOGRAM_BYTES:
                run()
                batch, size = {}, 0
            batch.setdefault(f, []).append(node)
            size += bytes_of
    if batch:
        run()
    return {f: np.concatenate(parts, axis=1) for f, parts in out.items() if parts}


# ---------------------------------------------------------------- prediction

class Forest:
    """Trees with cut values in place of bin numbers, all walked at once."""

    def __init__(self, trees: list[Tree], cuts: list[np.ndarray]):
        starts = np.cumsum([0] + [len(t.feature) for t in trees])
        self.roots = starts[:-1]
        join = lambda name, shift=False: np.concatenate([
            np.asarray(getattr(t, name)) + (s if shift else 0) for t, s in zip(trees, starts)] or [np.zeros(0)])
        self.feature = join("feature").astype(np.int32)
        self.missing_left = join("missing_left").astype(bool)
        self.left, self.right = (join(side, True).astype(np.int32) for side in ("left", "right"))
        self.value = join("value").astype(np.float64)
        at = join("bin").astype(np.int32)
        # behind a column's last cut only missing values are left
        self.cut = np.asarray([0.0 if f < 0 else cuts[f][b] if b < len(cuts[f]) else np.inf for f, b in zip(self.feature, at)], np.float64)

    def to_dict(self) -> dict[str, list]:
        return {name: getattr(self, name).tolist() for name in ("roots", "feature", "cut", "missing_left", "left", "right", "value")}

    @classmethod
    def from_dict(cls, parts: dict[str, list]) -> Forest:
        made = cls.__new__(cls)
        kinds = {"roots": np.int64, "feature": np.int32, "cut": np.float64, "missing_left": bool, "left": np.int32,
                 "right": np.int32, "value": np.float64}
        for name, kind in kinds.items():
            setattr(made, name, np.asarray(parts[name], kind))
        return made

    def margins(self, x: np.ndarray, rows_at_once: int = 4096) -> np.ndarray:
        """Sum of leaf weights of every row of ``x`` (rows, columns); NaN is missing. A row's sum is taken tree by tree."""
        out, inner = np.zeros(len(x)), self.feature >= 0
        # a leaf leads to itself, an inner node to its right child or to the left one before it
        right, cut = np.where(inner, self.right, np.arange(len(inner))), np.where(inner, self.cut, -np.inf)
        depth, level = 0, self.roots
        while len(level := level[inner[level]]):
            depth, level = depth + 1, np.concatenate([self.left[level], self.right[level]])
        for a in range(0, len(x), rows_at_once):
            flat = np.ascontiguousarray(x[a:a + rows_at_once].T).ravel()
            n = min(rows_at_once, len(x) - a)
            begins, gaps, row = np.where(inner, self.feature, 0).astype(np.int64) * n, np.isnan(flat).any(), np.arange(n)
            trees = max(1, 16_384 // n)  # at once
            for t in range(0, len(self.roots), trees):
                node = np.repeat(self.roots[t:t + trees, None], n, axis=1)
                for _ in range(depth):
                    value = flat.take(begins[node] + row)
                    left = value < cut[node]
                    if gaps:
                        left |= np.isnan(value) & self.missing_left[node] & inner[node]
                    node = right[node] - left
                for weights in self.value[node]:
                    out[a:a + n] += weights
        return out
