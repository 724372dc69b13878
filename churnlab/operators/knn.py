"""Exact k-nearest neighbours within a class, pivot-blocked and tiled.

A self join of the class would emit every pair. Instead:

1. Pivots: ``n_pivots`` rows chosen by a seeded hash rank (a sampling
   step; their coordinates are a bounded parameter, pivots x dims).
2. Every point goes to its nearest pivot's cluster (NumPy inside
   ``mapInPandas``); cluster radius R_j = max distance of a member to p_j.
3. Phase 1: each point's k nearest inside its own cluster give an upper
   bound r_a on its k-th neighbour distance.
   (Phase 1 also searches the next nearest clusters to tighten r.)
4. Phase 2: by the triangle inequality a point b of cluster j satisfies
   d(a, b) >= d(a, p_j) - R_j, so only clusters with d(a, p_j) - R_j <= r_a
   can hold a closer neighbour; those are searched as well.
   Inside a searched cluster only members with |d(a, p_j) - d(b, p_j)| <= r_a
   are measured (members sorted by d(b, p_j), one binary search per probe).
5. Every (probes of j) x (members of j) search is cut into tiles of at most
   ``tile`` probes x ``tile`` members (hash tiles), each evaluated with NumPy
   in a cogrouped ``applyInPandas`` that returns only its top k per probe --
   a dense cluster (one third of all rows) becomes many bounded tasks, and
   no pair is ever materialised as a row.
6. top k per point over all tiles: ``row_number`` over (point) by (distance
   rounded to 9 places, neighbour id).

The answer is exact (equal to brute force with the same tie rule).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlab.session import checkpoint

from churnlab.functions.hashing import seeded_hash
from churnlab.operators.joins import bounded_broadcast

KNN_SCHEMA = "a long, b long, dist double"


BLOCK_CELLS = 131_072  # a block of distances is about 1 MB, whatever the number of pivots or of members
PROBES_AT_ONCE = 10_000  # rows that one batch of the second search's probes has about


def _row_chunk(n_columns: int, cells: int = BLOCK_CELLS) -> int:
    """Rows per block so that a rows x columns block has ``cells`` cells at most (one row at least)."""
    return max(1, cells // max(1, n_columns))


def _pivot_dist(v: np.ndarray, pivots: np.ndarray, chunk: int | None = None) -> np.ndarray:
    """Distances rows x pivots, accumulated per dimension in row chunks (bounded memory)."""
    chunk = chunk or _row_chunk(len(pivots))
    out = np.empty((len(v), len(pivots)))
    for s in range(0, len(v), chunk):
        blk = v[s:s + chunk]
        d2 = np.zeros((len(blk), len(pivots)))
        for j in range(v.shape[1]):
            diff = blk[:, j][:, None] - pivots[:, j][None, :]
            d2 += diff * diff
        out[s:s + chunk] = np.sqrt(d2)
    return out


def _empty_pairs() -> pd.DataFrame:
    return pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="int64"),
                         "dist": pd.Series([], dtype="float64")})


def _sq_dist(p: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Squared distances, summed left to right over the dimensions (like a SQL sum of squares)."""
    d2 = np.zeros((len(p), len(m)))
    for j in range(p.shape[1]):
        diff = p[:, j][:, None] - m[:, j][None, :]
        d2 = d2 + diff * diff
    return d2


def _tile_topk(k: int, dims: int):
    """Top k members per probe within one tile.

    With ring data (probe: distance ``dp`` to the cluster's pivot and bound
    ``r``; member: distance ``d0`` to the same pivot), members are sorted by
    d0 and each probe only measures the slice |dp - d0| <= r: by the triangle
    inequality no other member can be within r.
    """
    def fn(probes: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if probes.empty or members.empty:
            return _empty_pairs()
        pa = np.stack(probes["vec"].to_numpy()).reshape(len(probes), dims)
        mb = np.stack(members["vec"].to_numpy()).reshape(len(members), dims)
        aid = probes["pid"].to_numpy()
        bid = members["pid"].to_numpy()
        r = probes["r"].to_numpy(dtype="float64")
        ring = np.isfinite(r).any()
        if ring:
            order = np.argsort(members["d0"].to_numpy(), kind="stable")
            d0, mb, bid = members["d0"].to_numpy()[order], mb[order], bid[order]
            dp = probes["dp"].to_numpy(dtype="float64")
            lo = np.searchsorted(d0, dp - r - 1e-9, side="left")
            hi = np.searchsorted(d0, dp + r + 1e-9, side="right")
            # Per-probe slices pay off only when the ring prunes most pairs; otherwise one
            # vectorised matrix is cheaper (extra candidates never change an exact top k).
            ring = (hi - lo).sum() < 0.25 * len(pa) * len(mb)
        step = _row_chunk(len(mb))
        out_a, out_b, out_d = [], [], []
        for i in range(len(probes)):
            if not ring and i % step == 0:
                full = np.round(np.sqrt(_sq_dist(pa[i:i + step], mb)), 9)
            if ring:
                if hi[i] <= lo[i]:
                    continue
                ids = bid[lo[i]:hi[i]]
                dist = np.round(np.sqrt(_sq_dist(pa[i:i + 1], mb[lo[i]:hi[i]])[0]), 9)
            else:
                ids, dist = bid, full[i % step]
            dist[ids == aid[i]] = np.inf
            sel = np.lexsort((ids, dist))[:k]
            sel = sel[np.isfinite(dist[sel])]
            out_a.append(np.full(len(sel), aid[i]))
            out_b.append(ids[sel])
            out_d.append(dist[sel])
        if not out_a:
            return _empty_pairs()
        return pd.DataFrame({"a": np.concatenate(out_a).astype("int64"), "b": np.concatenate(out_b).astype("int64"),
                             "dist": np.concatenate(out_d).astype("float64")})
    return fn


def _search(probes: DataFrame, members: DataFrame, k: int, dims: int, tile: int, seed: int) -> DataFrame:
    """probes(pid, vec, cl, dp, r) x members(pid, vec, cl, d0) within equal ``cl``, tiled; top k per probe and tile."""
    # Fresh attribute ids: probes and members may come from the same frame.
    probes = probes.select(*[F.col(c).alias(c) for c in ("pid", "vec", "cl", "dp", "r")])
    members = members.select(*[F.col(c).alias(c) for c in ("pid", "vec", "cl", "d0")])
    msize = members.groupBy("cl").agg(F.count("*").alias("_m"))
    psize = probes.groupBy("cl").agg(F.count("*").alias("_p"))
    sizes = msize.join(psize, "cl").select(
        "cl", F.ceil(F.col("_m") / tile).cast("int").alias("_S"), F.ceil(F.col("_p") / tile).cast("int").alias("_Q"))
    sizes = bounded_broadcast(sizes, 1_000_000)
    tile_of = lambda n: F.pmod(F.conv(F.substring(seeded_hash(seed, "tile", F.col("pid")), 1, 8), 16, 10)
                               .cast("bigint"), F.col(n)).cast("int")
    m = (members.join(sizes, "cl").withColumn("tm", tile_of("_S"))
         .withColumn("tp", F.explode(F.sequence(F.lit(0), F.col("_Q") - 1)))
         .withColumn("tp", F.col("tp").cast("int"))
         .select("cl", "tm", "tp", "pid", "vec", "d0"))
    p = (probes.join(sizes, "cl").withColumn("tp", tile_of("_Q"))
         .withColumn("tm", F.explode(F.sequence(F.lit(0), F.col("_S") - 1)))
         .withColumn("tm", F.col("tm").cast("int"))
         .select("cl", "tm", "tp", "pid", "vec", "dp", "r"))
    return (p.groupBy("cl", "tm", "tp").cogroup(m.groupBy("cl", "tm", "tp"))
            .applyInPandas(_tile_topk(k, dims), KNN_SCHEMA))


def _top_k(cands: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("a").orderBy("dist", "b")
    # each pair is met in one tile only, and the second phase leaves out the clusters of the first
    return cands.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)


def exact_knn(points: DataFrame, id_col: str, features: list[str], k: int = 5, seed: int = 42,
              n_pivots: int | None = None, tile: int = 1024, max_pivots: int = 65_536,
              first_clusters: int = 4, min_cluster: int = 256) -> DataFrame:
    """(a, b, dist, nn_rank): the k nearest other points of every point (Euclidean).

    Phase 1 searches each point's ``first_clusters`` nearest clusters (own
    included) so that the bound r is tight; phase 2 then only visits the
    clusters the triangle inequality cannot exclude.
    """
    dims = len(features)
    pts = points.select(F.col(id_col).cast("long").alias("pid"),
                        F.array(*[F.col(c).cast("double") for c in features]).alias("vec"))
    pts = checkpoint(pts)
    n = pts.count()
    if n <= k:
        raise ValueError(f"Expected n_neighbors <= n_samples: {k + 1} > {n}")
    # ~2 sqrt(n) pivots balance assignment (n x P) against search (n x cluster size), but clusters
    # are kept at >= min_cluster points so small inputs do not pay per-task overhead for pruning.
    n_piv = n_pivots or int(min(max_pivots, max(1, min(round(4 * np.sqrt(n)), n // min_cluster))))
    # Pivot choice: the n_piv smallest seeded hashes (a sampling step).
    # A bounded top-n (TakeOrderedAndProject keeps n_piv rows per task), not a global sort.
    piv_rows = (pts.withColumn("_h", seeded_hash(seed, "pivot", F.col("pid")))
                .orderBy("_h", "pid").limit(n_piv).select("vec").collect())
    # pivots x dims doubles (<= 65,536 x dims): shipped once per executor as a broadcast.
    pivots_bc = pts.sparkSession.sparkContext.broadcast(
        np.array([r["vec"] for r in piv_rows], dtype="float64").reshape(-1, dims))
    n_piv_real = len(piv_rows)

    def assign(it):
        piv = pivots_bc.value
        step, c = _row_chunk(len(piv)), min(first_clusters, len(piv))
        for batch in it:
            if batch.empty:
                continue
            v = np.stack(batch["vec"].to_numpy()).reshape(len(batch), dims)
            near, d0 = np.empty((len(batch), c), "int32"), np.empty(len(batch))
            for s in range(0, len(batch), step):
                d = _pivot_dist(v[s:s + step], piv)
                near[s:s + step] = np.argsort(d, axis=1, kind="stable")[:, :c]
                d0[s:s + step] = d[np.arange(len(d)), near[s:s + step, 0]]
            yield pd.DataFrame({"pid": batch["pid"].to_numpy(), "vec": batch["vec"].to_numpy(),
                                "cl": near[:, 0], "d0": d0, "near": list(near)})

    assigned = checkpoint(pts.mapInPandas(
        assign, "pid long, vec array<double>, cl int, d0 double, near array<int>"))
    radius = {r["cl"]: r["R"] for r in assigned.groupBy("cl").agg(F.max("d0").alias("R")).collect()}
    rad_bc = pts.sparkSession.sparkContext.broadcast(np.array([radius.get(j, -np.inf) for j in range(n_piv_real)]))

    # Phase 1: the point's nearest clusters (its own first).
    own = assigned.select("pid", "vec", "cl", "d0")
    probe1 = assigned.select("pid", "vec", F.explode("near").alias("cl"), F.lit(0.0).alias("dp"),
                             F.lit(float("inf")).alias("r"))
    first = checkpoint(_top_k(_search(probe1, own, k, dims, tile, seed), k))
    bound = first.groupBy("a").agg(F.count("*").alias("_c"), F.max("dist").alias("_r"))
    bound = bound.select(F.col("a").alias("pid"),
                         F.when(F.col("_c") >= k, F.col("_r")).otherwise(F.lit(float("inf"))).alias("r_a"))

    def candidates(it):
        piv, rad = pivots_bc.value, rad_bc.value
        step = _row_chunk(len(piv))
        for batch in it:
            if batch.empty:
                continue
            pid, vec, r = batch["pid"].to_numpy(), batch["vec"].to_numpy(), batch["r_a"].fillna(np.inf).to_numpy()
            v, near = np.stack(vec).reshape(len(batch), dims), np.stack(batch["near"].to_numpy())

            def probes(found):
                rows, cls, dp = (np.concatenate(x) for x in zip(*found))
                return pd.DataFrame({"pid": pid[rows], "vec": vec[rows], "cl": cls, "dp": dp, "r": r[rows]})

            found, n = [], 0
            for s in range(0, len(batch), step):
                dpiv = _pivot_dist(v[s:s + step], piv)
                ok = dpiv - rad[None, :] <= r[s:s + step, None] + 1e-9
                ok[np.arange(len(dpiv))[:, None], near[s:s + step]] = False  # already searched in phase 1
                rows, cls = np.nonzero(ok)
                for a in range(0, len(rows), PROBES_AT_ONCE):
                    part = slice(a, a + PROBES_AT_ONCE)
                    found.append((rows[part] + s, cls[part].astype("int32"), dpiv[rows[part], cls[part]]))
                    n += len(found[-1][0])
                    if n >= PROBES_AT_ONCE:
                        yield probes(found)
                        found, n = [], 0
            if n:
                yield probes(found)

    probe2 = assigned.join(bound, "pid", "left").mapInPandas(
        candidates, "pid long, vec array<double>, cl int, dp double, r double")
    second = _search(probe2, own, k, dims, tile, seed)
    both = first.select("a", "b", "dist").unionByName(second)
    return _top_k(both, k)
