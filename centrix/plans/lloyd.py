"""Lloyd training (K1, K2, K3, K5).

Driver loop over a persisted point table.  Each iteration is ONE Spark job:
assign + per-cluster (count, vector sum, cost) in a partition kernel, whose
partial sums are merged by Spark and come to the driver as k x d numbers.  The
next plan is built from those numbers, so the lineage doesn't grow with the
iteration count.

Sums are exact integers in limbs (``operators.exact``) and rounded once, so a
run gives the same bits however the points are dealt to partitions, blocks and
tasks, fractional coordinates included.

Most distances of late iterations are skipped, exactly: beside a block lie the
nearest centroid of each point and a bound below which no other one lay, as of
an earlier model; a point whose own centroid is nearer than that bound less
what the others have moved since, or nearer than half its distance to any other
centroid, needs that one distance only.  Bounds are made
anew when the searches they didn't save have cost as much as that.

Contract (SURVEY D2-D7): squared distances; lowest cluster_id wins a tie;
``max_iter`` assignments and ``max_iter - 1`` updates; returned centroids are
the ones the final labels were computed with; an empty cluster keeps its
previous centroid with n = 0 (``empty='drop'`` removes it); the cost of
iteration i is the sum of distances to the centroids *before* update i.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centrix.operators import kernels
from centrix.operators.assign import assign, distinct_points
from centrix.operators.blocks import iter_rows, to_blocks
from centrix.operators.exact import LIMB_SCHEMA, ExactSums, collect_sums, limb_batch, merge_limbs
from centrix.operators.model import Model, collect_model
from centrix.session import scratch_path, ship_package

# Partial sums are merged by Spark until at most so many tables of them are
# left, which the driver adds up (they are integers: any order, same bits).
FAN_IN = 32
# What making bounds costs, in features of distances: a point's block is written
# and cached once more, and a task does about so much work in its other costs.
BOUND_COST = 32
TASK_COST = 100_000_000


def _block_stats(blocks: DataFrame, model: Model, drift: tuple | None, exact: bool) -> DataFrame:
    """Limb rows of (vector sum, count, cost, points searched) per cluster and
    task.  ``drift``: how far the others have moved since the blocks' bounds, and
    half the gaps between centroids.
    The model goes with the function, which Spark broadcasts if it is large."""
    ship_package(blocks.sparkSession)
    k, d, C = model.k, model.d, model.C

    def fn(batches):
        tree, CT = kernels.Tree(C), np.ascontiguousarray(C.T)
        sums = ExactSums(k, d + 3)
        for row in iter_rows(batches, d):
            X, w = row["x"], row.get("w")
            bounded, plain = drift is not None and "label" in row, row["plain"] and w is None
            S, n, searched = np.zeros((k, d)), np.zeros(k), 0
            dist = np.empty(len(X))
            idx = np.empty(len(X), np.int64)
            for rows in kernels.chunks(len(X), tree):
                XT = kernels.columns_of(X[rows])
                if bounded:
                    i, dist[rows], full = kernels.bounded_nearest(XT, tree, CT, row["label"][rows], row["far"][rows], *drift)
                else:
                    i, dist[rows] = tree.nearest(XT) if exact else kernels.nearest_fast(X[rows].astype(np.float64), C)
                    full = len(i)
                idx[rows] = i
                searched += full
                n += np.bincount(i, weights=None if w is None else w[rows], minlength=k)
                if plain:
                    S += kernels.column_sums(i, XT, k)
                else:
                    sums.add_columns(i, XT, weight=None if w is None else w[rows])
            if plain:
                sums.add(S)
            sums.add(n[:, None], d)
            sums.add_columns(idx, dist[None, :], d + 1, w)
            sums.add(np.concatenate([[searched], np.zeros(k - 1)])[:, None], d + 2)
        yield limb_batch(sums)

    return blocks.mapInArrow(fn, LIMB_SCHEMA)


def _pass_columns(blocks: DataFrame) -> DataFrame:
    """The columns that a pass reads, chosen once for all passes over ``blocks``."""
    there = blocks.columns
    return blocks.select(*[c for c in ("x", "kind", "plain", "w", "label", "far") if c in there])


def _point_stats(points: DataFrame, model: Model) -> DataFrame:
    """The same from points that Spark SQL assigns."""
    ship_package(points.sparkSession)
    k, d, ids = model.k, model.d, model.ids

    def fn(batches):
        sums = ExactSums(k, d + 3)
        for b in batches:
            idx = np.searchsorted(ids, b.column(0).to_numpy(zero_copy_only=False))
            sums.add_columns(idx, np.ascontiguousarray(kernels.coords(b, d).T))
            sums.add(np.bincount(idx, minlength=k).astype(np.float64)[:, None], d)
            sums.add_columns(idx, b.column(2).to_numpy(zero_copy_only=False)[None, :], d + 1)
        yield limb_batch(sums)

    assigned = assign(points, model, method="sql", keep_coord=True)
    return assigned.select("cluster_id", "coord", "dist").mapInArrow(fn, LIMB_SCHEMA)


def lloyd_step(points: DataFrame, model: Model, n_partitions: int | None = None, drift: tuple | None = None, exact: bool = True,
               blocked: bool = True):
    """One assignment pass over blocks (the columns of a pass) or points: arrays (n[k], S[k, d], cost[k])
    in model order, and the number of points whose nearest centroid was searched."""
    part = _block_stats(points, model, drift, exact) if blocked else _point_stats(points, model)
    if n_partitions is None or n_partitions > FAN_IN:
        part = merge_limbs(part)
    got = collect_sums(part, (model.k, model.d + 3))
    n = np.rint(got[:, model.d]).astype(np.int64)
    return n, got[:, :model.d], got[:, model.d + 1], int(got[0, model.d + 2])


def with_bounds(blocks: DataFrame, model: Model) -> DataFrame:
    """Blocks with, beside them, each point's nearest centroid and the distance
    below which no other lies (map-only)."""
    ship_package(blocks.sparkSession)
    bc = blocks.sparkSession.sparkContext.broadcast(model.C)
    d = model.d
    kept = [f for f in blocks.schema.fields if f.name not in ("label", "far")]

    def fn(batches):
        tree = kernels.Tree(bc.value)
        for b in batches:
            names = [f.name for f in kept]
            columns = [b.column(b.schema.get_field_index(name)) for name in names]
            made = [kernels.bounds(row["x"], tree) for row in iter_rows([b], d)]
            columns += [pa.array([m[i].tobytes() for m in made], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "label", "far"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return blocks.mapInArrow(fn, f"{schema}, label BINARY, far BINARY")


def spread_for_iterations(pts: DataFrame, persist: bool = True) -> DataFrame:
    """Input that will be scanned once per iteration: give it at least one
    partition per core (a one-time round-robin shuffle, only when the input
    has fewer partitions than the cluster has task slots), and persist it."""
    slots = pts.sparkSession.sparkContext.defaultParallelism
    if pts.rdd.getNumPartitions() < slots:
        pts = pts.repartition(slots)
    if persist:
        pts = pts.persist(StorageLevel.MEMORY_AND_DISK)
    return pts


def labels_from_blocks(blocks: DataFrame, model: Model) -> DataFrame:
    """``(point_id, cluster_id, dist)`` for every point of a block table."""
    ship_package(blocks.sparkSession)
    bc = blocks.sparkSession.sparkContext.broadcast((model.ids, model.C))
    d = model.d

    def fn(batches):
        ids_c, C = bc.value
        tree = kernels.Tree(C)
        for row in iter_rows(batches, d):
            idx, dist = kernels.nearest(row["x"], tree)
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"]), pa.array(ids_c[idx]), pa.array(dist)],
                                             names=["point_id", "cluster_id", "dist"])

    return blocks.select("ids", "x", "kind").mapInArrow(fn, "point_id BIGINT, cluster_id INT, dist DOUBLE")


# Distance work (n * k * d) per task below which one more scan task costs more in
# scheduling than it saves; small inputs are scanned by fewer tasks
# (coalesce, no shuffle), large inputs by whole waves of tasks.
MIN_TASK_WORK = 5_000_000


def size_scan(blocks: DataFrame, k: int, d: int) -> tuple[DataFrame, int, int]:
    """Materialise the persisted blocks (one pass that also counts points) and
    coalesce them to a number of tasks that is worth the work and leaves no
    last wave of a few.  Returns the blocks, the tasks and the points."""
    n, last = blocks.select("n", F.spark_partition_id().alias("p")).agg(F.sum("n"), F.max("p")).first()
    n, parts, slots = int(n or 0), (last or 0) + 1, blocks.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(parts, -(-n * k * d // MIN_TASK_WORK)))
    if tasks > slots:
        tasks -= tasks % slots
    return (blocks.coalesce(tasks) if tasks < parts else blocks), tasks, n


# Centroid history kept in driver memory up to this many bytes in total; past
# it, each superseded model is appended to a Parquet table in the shared
# checkpoint folder and only the table is kept.
MAX_HISTORY_BYTES = 64 << 20


@dataclass
class LloydResult:
    points: DataFrame
    history: list = field(default_factory=list)   # (iter, Model | None, n, cost)
    blocks: DataFrame | None = None
    history_path: str | None = None                # spilled models, when any
    blocks_cover_points: bool = True               # False when blocks hold distinct points

    def _spill(self) -> None:
        """Write the second-to-last model to the history table and drop it
        from memory (the last one is still needed)."""
        if len(self.history) < 2 or self.history[-2][1] is None:
            return
        it, model, n, cost = self.history[-2]
        if self.history_path is None:
            self.history_path = scratch_path(self.spark, "centroid-history")
        model.to_df(self.spark, n).select(F.lit(it).cast("int").alias("iter"), "*") \
            .write.mode("append").parquet(self.history_path)
        self.history[-2] = (it, None, n, cost)

    def model_at(self, it: int) -> Model:
        for i, model, _, _ in self.history:
            if i == it:
                if model is not None:
                    return model
                rows = self.spark.read.parquet(self.history_path).filter(F.col("iter") == it)
                return collect_model(rows.select("cluster_id", "coord"), self.spark)
        raise ValueError("no such iteration")

    @property
    def spark(self):
        return self.points.sparkSession

    @property
    def final(self) -> Model:
        return self.history[-1][1]

    def centroids(self) -> DataFrame:
        """Final centroids ``(cluster_id, n, coord)``; n = members under the final labels."""
        _, model, n, _ = self.history[-1]
        return model.to_df(self.spark, n)

    def centroid_history(self) -> DataFrame:
        """K2: ``(iter, cluster_id, n, coord)`` for every iteration."""
        rows = [(it, int(i), int(m), [float(v) for v in c])
                for it, model, n, _ in self.history if model is not None
                for i, c, m in zip(model.ids, model.C, n)]
        df = self.spark.createDataFrame(rows, "iter INT, cluster_id INT, n BIGINT, coord ARRAY<DOUBLE>")
        if self.history_path is not None:
            df = self.spark.read.parquet(self.history_path).select("iter", "cluster_id", "n", "coord").unionByName(df)
        return df

    def costs(self) -> DataFrame:
        """K3: ``(iter, cost)`` cost curve (double; see cost.total_cost for exact decimals)."""
        rows = [(it, float(np.sum(c))) for it, _, _, c in self.history]
        return self.spark.createDataFrame(rows, "iter INT, cost DOUBLE")

    def labels(self, method: str = "arrow") -> DataFrame:
        """``(point_id, cluster_id, dist)`` under the final centroids (lazy, distributed)."""
        if method == "arrow" and self.blocks is not None and self.blocks_cover_points:
            return labels_from_blocks(self.blocks, self.final)
        return assign(self.points, self.final, method=method)

    def labels_at(self, iters, method: str = "arrow") -> DataFrame:
        """K2: ``(iter, point_id, cluster_id, dist)`` for the asked-for iterations."""
        out = None
        for it, _, _, _ in self.history:
            if it in set(iters):
                model = self.model_at(it)
                use_blocks = method == "arrow" and self.blocks is not None and self.blocks_cover_points
                lab = labels_from_blocks(self.blocks, model) if use_blocks \
                    else assign(self.points, model, method=method)
                df = lab.select(F.lit(it).alias("iter"), "*")
                out = df if out is None else out.unionByName(df)
        if out is None:
            raise ValueError("no such iteration")
        return out

    def unpersist(self) -> None:
        self.points.unpersist()
        if self.blocks is not None:
            self.blocks.unpersist()


def fit(points: DataFrame, start, max_iter: int = 100, empty: str = "keep",
        tol: float | None = None, method: str = "arrow", persist: bool = True,
        exact: bool = True, collapse_duplicates: bool = False) -> LloydResult:
    """K1: Lloyd k-means from given start centroids, for a fixed number of
    iterations (optional ``tol``: stop once no centroid moves more than tol,
    squared).  ``exact=False`` picks nearest centroids with BLAS products
    (wide vectors); distances stay exact, ties within rounding may differ.
    ``collapse_duplicates=True`` trains on distinct coordinates weighted by
    their multiplicity (the same bits; far fewer rows when copies dominate);
    labels still cover every point."""
    if max_iter < 1:
        raise ValueError("max_iter must be >= 1")
    if empty not in ("keep", "drop"):
        raise ValueError("empty must be 'keep' or 'drop'")
    if method not in ("arrow", "sql"):
        raise ValueError("method must be 'sql' or 'arrow'")
    spark = points.sparkSession
    model = collect_model(start, spark)
    own = points.select("point_id", "coord")
    blocked = method == "arrow"
    n_points, bounds_of, spent, saved, patience = 0, None, 0, 0, 1
    if blocked:
        # points are packed once into dense blocks; every pass scans the blocks
        if collapse_duplicates:
            blocks = to_blocks(spread_for_iterations(distinct_points(own), persist=False), model.d, weight="w")
        else:
            blocks = to_blocks(spread_for_iterations(own, persist=False), model.d)
        if persist:
            blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
            whole, tasks, n_points = size_scan(blocks, model.k, model.d)
        else:
            whole, tasks = blocks, None
        scan = _pass_columns(whole)
        result = LloydResult(own, blocks=blocks, blocks_cover_points=not collapse_duplicates)
    else:
        scan, tasks = spread_for_iterations(own, persist), None
        result = LloydResult(scan)
    spill = model.nbytes * max_iter > MAX_HISTORY_BYTES
    bounding = blocked and persist and exact
    it = 0
    while True:
        it += 1
        price = n_points * model.d * (model.k + BOUND_COST) + (tasks or 0) * TASK_COST
        if bounding and it < max_iter and n_points and spent >= price * patience:
            # this pass makes the bounds and uses them
            patience = patience * 4 if bounds_of is not None and saved < price else 1
            whole = with_bounds(whole, model).persist(StorageLevel.MEMORY_AND_DISK)
            old, result.blocks, scan, bounds_of, spent, saved = result.blocks, whole, _pass_columns(whole), model, 0, 0
        else:
            old = None
        drift = None
        if bounds_of is not None and bounds_of.k == model.k:
            # gaps are worth their k * k distances where a task has many more points than that
            gap = kernels.half_gaps(model.C) if 4 * model.k * tasks <= n_points else np.zeros(model.k)
            drift = kernels.drifts(model.C, bounds_of.C), gap
        n, S, cost, searched = lloyd_step(scan, model, tasks, drift, exact, blocked)
        if old is not None:
            old.unpersist()
        spent += searched * model.k * model.d
        saved += (n_points - searched) * (model.k - 1) * model.d
        result.history.append((it, model, n, cost))
        if spill:
            result._spill()
        if it >= max_iter:
            break
        keep = n > 0
        C = model.C.copy()
        C[keep] = S[keep] / n[keep, None]
        new = Model(model.ids[keep], C[keep]) if empty == "drop" else Model(model.ids.copy(), C)
        if tol is not None and new.k == model.k and float(np.max(np.sum((new.C - model.C) ** 2, axis=1))) <= tol:
            max_iter = it + 1   # one more pass, for the counts and the cost of the last update
        model = new
    return result


def smoke(points: DataFrame, start) -> DataFrame:
    """K5: a two-iteration run; returns the final centroids (shown, not stored)."""
    res = fit(points, start, max_iter=2, persist=False)
    return res.centroids()
