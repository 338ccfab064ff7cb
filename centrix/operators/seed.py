"""Greedy k-means++ seeding and its parts.

Contract: the first centre is a uniform pick; each later centre is the best
of ``n_trials = 2 + floor(ln k)`` candidates, each drawn with probability
proportional to the current squared distance to the nearest chosen centre;
"best" = lowest potential sum(min(d_near, d_candidate)), first trial on a tie.

Draws use the counter-based uniforms of ``centrix.functions.hashrand`` keyed
by (seed, step, trial, point_id), so a re-run task, another partitioning or
the DuckDB oracle all draw the same points.  A weighted draw is an
exponential race: the point with the lowest ``-ln(u) / w`` wins, which has
exactly the distribution of inverse-CDF sampling but needs one pass and no
sort.  The inverse-CDF form (running sum) is :func:`weighted_pick_cdf`.

Driver work per step: O(n_trials^2) rows.  Points are never collected.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centrix.functions.hashrand import hash_uniform_sql, np_hash_uniform, stream
from centrix.functions.numeric import n_local_trials
from centrix.operators import kernels
from centrix.operators.blocks import iter_rows, to_blocks
from centrix.operators.exact import ExactSums, to_doubles
from centrix.operators.prefix import prefix_sum, range_sums
from centrix.session import ship_package

RACE_SCHEMA = "t INT, s INT, limb INT, v BIGINT, key DOUBLE, point_id BIGINT, coord ARRAY<DOUBLE>"

# Of up to so many tasks the driver merges the findings, of more Spark does first.
FAN_IN = 32


def uniform_pick(points: DataFrame, seed: int, step: int = 0, trial: int = 0) -> DataFrame:
    """T4: one row chosen uniformly: the lowest ``(u, point_id)``."""
    u = F.expr(hash_uniform_sql(str(stream(seed, step, trial)), "point_id"))
    best = points.agg(F.min(F.struct(u.alias("u"), F.col("point_id"), F.col("coord"))).alias("b"))
    return best.select("b.point_id", "b.coord")


def weighted_pick_race(df: DataFrame, weight: str, seed: int, step: int, trials: int) -> DataFrame:
    """T5 (one pass): per trial, the row with the lowest ``-ln(u)/w`` among
    rows with w > 0.  Returns ``(trial, point_id)``; a trial is missing when
    every weight is 0."""
    rows = []
    for t in range(1, trials + 1):
        u = hash_uniform_sql(str(stream(seed, step, t)), "point_id")
        key = F.when(F.col(weight) > 0, -F.expr(f"ln({u})") / F.col(weight))
        rows.append(F.min(F.when(key.isNotNull(), F.struct(key.alias("k"), F.col("point_id")))).alias(f"t{t}"))
    best = df.agg(*rows)
    return best.select(F.explode(F.array(*[F.struct(F.lit(t).alias("trial"), F.col(f"t{t}.point_id").alias("point_id"))
                                           for t in range(1, trials + 1)])).alias("x")) \
        .select("x.trial", "x.point_id").filter(F.col("point_id").isNotNull())


def running_cdf(df: DataFrame, weight: str, order: str = "point_id", buckets: int | None = None) -> DataFrame:
    """Running sum of ``weight`` in ``order`` (rows unbounded preceding).

    Two levels instead of one window over all rows in one task, see
    ``operators.prefix``; ``buckets`` sets the number of ranges."""
    return prefix_sum(df, weight, order, "cdf", buckets)


def weighted_pick_cdf(df: DataFrame, weight: str, u: float, order: str = "point_id") -> DataFrame:
    """T5 (inverse CDF): first row whose running sum reaches ``u * total``;
    the last row if rounding leaves none.

    The range where that happens is found from the ranges' sums; only its rows
    are looked at again."""
    rows, totals = range_sums(df, weight, order)
    goal = totals.agg((F.lit(float(u)) * F.sum("_tot")).alias("g"))
    hit = (totals.withColumn("g", goal.scalar()).where(F.col("_off") + F.col("_tot") >= F.col("g"))
           .agg(F.min(F.struct("_range", "_off", "g")).alias("m")).select("m.*"))
    found = rows.join(F.broadcast(hit), "_range")   # one row
    first = found.filter(F.col("_off") + F.col("_in") >= F.col("g")).agg(F.min(order).alias(order))
    last = rows.agg(F.max(order).alias("_last"))
    return first.select(F.coalesce(F.col(order), last.scalar()).alias(order))


def potential(df: DataFrame, d_near: str, candidates, dist_sql) -> DataFrame:
    """Per candidate, sum(least(d_near, dist(x, candidate)))."""
    aggs = [F.sum(F.least(F.col(d_near), F.expr(dist_sql(c)))).alias(f"pot{t}")
            for t, c in enumerate(candidates, start=1)]
    return df.agg(*aggs)


def best_candidate(pots: list[float]) -> int:
    """0-based index of the lowest potential, the first on a tie."""
    return int(np.argmin(np.asarray(pots, dtype=np.float64)))


def _race_pass(state: DataFrame, pending: np.ndarray, cands: np.ndarray | None,
               seed: int, next_step: int | None, trials: int, d: int) -> DataFrame:
    """One pass: fold pending centres into d_near, potentials of the current
    candidates (limbs of exact sums, ``s = -1``), and the next step's races under
    each candidate."""
    ship_package(state.sparkSession)
    strm = [stream(seed, next_step, s) for s in range(1, trials + 1)] if next_step else []
    pend, cnd = pending, cands

    def fn(batches):
        T = 1 if cnd is None else cnd.shape[0]
        pots, won = ExactSums(1, T), {}
        for ids, X, dn in _state_blocks(batches, d):
            if len(pend):
                dn = np.minimum(dn, kernels.nearest(X, pend)[1])
            near = dn[None, :] if cnd is None else np.minimum(dn[None, :], kernels.all_sq_dists(X, cnd))
            pots.add_columns(np.zeros(len(ids), np.int64), near)
            logs = [-np.log(np_hash_uniform(s, ids)) for s in strm]
            for t, dt in enumerate(near):
                with np.errstate(divide="ignore", invalid="ignore"):
                    keys = [np.where(dt > 0, log / dt, np.inf) for log in logs]
                for s, key in enumerate(keys):
                    low = key.min(initial=np.inf)
                    if low < np.inf:
                        tied = np.flatnonzero(key == low)
                        i = tied[np.argmin(ids[tied])]
                        won[t, s] = min(won.get((t, s), (np.inf,)), (float(low), int(ids[i]), X[i].tolist()))
        _, t, limb, v = pots.rows()
        rows = [(int(a), -1, int(b), int(c), None, None, None) for a, b, c in zip(t, limb, v, strict=True)]
        rows += [(t, s, 0, 0, *best) for (t, s), best in won.items()]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)],
                                         names=["t", "s", "limb", "v", "key", "point_id", "coord"])

    return state.select("ids", "x", "kind", "dn").mapInArrow(fn, RACE_SCHEMA)


def _reduce_races(part: DataFrame, tasks: int, T: int) -> tuple[list[float], dict]:
    """Potentials of the candidates, and per race the lowest (key, point_id).

    A task sends at most trials * (trials + 1) rows and their limbs; of more than
    a few tasks Spark merges them first."""
    if tasks > FAN_IN:
        best = F.min(F.when(F.col("point_id").isNotNull(), F.struct("key", "point_id", "coord")))
        part = part.groupBy("t", "s", "limb").agg(F.sum("v").alias("v"), best.alias("w")).select("t", "s", "limb", "v", "w.*")
    limbs, races = {}, {}
    for r in part.collect():
        if r["s"] < 0:
            limbs[r["t"], r["limb"]] = limbs.get((r["t"], r["limb"]), 0) + r["v"]
        else:
            races[r["t"], r["s"]] = min(races.get((r["t"], r["s"]), (math.inf,)), (r["key"], r["point_id"], r["coord"]))
    at = np.array(list(limbs), np.int64).reshape(-1, 2)
    pots = to_doubles((1, T), np.zeros(len(at), np.int64), at[:, 0], at[:, 1], np.array(list(limbs.values()), np.int64))
    return pots[0].tolist(), races


def _state_blocks(batches, d: int):
    """``(ids, X, dn)`` per block row; a NULL ``dn`` means +inf (no centre yet)."""
    for row in iter_rows(batches, d):
        yield row["ids"], row["x"], row.get("dn", np.full(len(row["ids"]), np.inf))


def _fold(state: DataFrame, pending: np.ndarray, d: int) -> DataFrame:
    """New state blocks with the pending centres folded into ``dn`` (map-only)."""
    spark = state.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(pending)

    def fn(batches):
        for b in batches:
            near = [np.minimum(dn, kernels.nearest(X, bc.value)[1]).tobytes() for _, X, dn in _state_blocks([b], d)]
            yield b.set_column(b.schema.get_field_index("dn"), "dn", pa.array(near, pa.binary()))

    return state.mapInArrow(fn, state.schema)


def kmeanspp(points: DataFrame, k: int, seed: int = 0, n_trials: int | None = None,
             checkpoint_every: int = 8) -> DataFrame:
    """Greedy k-means++ start centroids ``(cluster_id, point_id, coord)``.

    One pass over the points per centre.  The points are packed once into
    dense blocks (see ``operators.blocks``) and the nearest-distance state is a
    BINARY column beside each block; every ``checkpoint_every`` centres the
    state is folded forward with the pending centres, which bounds the pending
    centres each pass folds in.  Nothing is written: a lost executor's blocks
    are rebuilt from the scan and the chosen centres.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    trials = n_trials or n_local_trials(k)
    from centrix.plans.lloyd import spread_for_iterations
    base = points.select("point_id", "coord")
    pts = spread_for_iterations(base, persist=False)
    d = int(base.select(F.size("coord")).first()[0])
    first = uniform_pick(base, seed).first()
    if first is None:
        raise ValueError("no points")
    chosen = [(int(first["point_id"]), [float(v) for v in first["coord"]])]
    from centrix.plans.lloyd import size_scan
    state = to_blocks(pts, d).withColumn("dn", F.lit(None).cast("binary")).persist(StorageLevel.MEMORY_AND_DISK)
    # per pass: pending centres + candidates (distances) and trials^2 races per point
    state, tasks, _ = size_scan(state, checkpoint_every + trials * (trials + 1), d)
    pending, cands, old = [chosen[0][1]], None, None

    def matrix(rows: list) -> np.ndarray:
        return np.asarray(rows, dtype=np.float64).reshape(-1, d)

    while len(chosen) < k:
        # the step whose candidates this pass draws; the last pass only chooses
        step = len(chosen) + (1 if cands is None else 2)
        part = _race_pass(state, matrix(pending), None if cands is None else matrix([c[1] for c in cands]),
                              seed, step if step <= k else None, trials, d)
        pots, races = _reduce_races(part, tasks, 1 if cands is None else len(cands))
        if old is not None:   # the pass has made the folded state
            old.unpersist()
            old = None
        best = 0
        if cands is not None:
            best = best_candidate(pots)
            chosen.append(cands[best])
            pending.append(cands[best][1])
            if len(chosen) >= k:
                break
        drawn = [races.get((best, s)) for s in range(trials)]
        if any(w is None for w in drawn):
            # every remaining point sits on a chosen centre: lowest unused id
            used = [c[0] for c in chosen]
            row = base.filter(~F.col("point_id").isin(used)).agg(F.min(F.struct("point_id", "coord")).alias("m")).first()
            if row is None or row["m"] is None:
                raise ValueError(f"k={k} exceeds the number of points")
            cands = [(int(row["m"]["point_id"]), [float(v) for v in row["m"]["coord"]])]
        else:
            cands = [(int(w[1]), [float(v) for v in w[2]]) for w in drawn]
        if len(pending) >= checkpoint_every:
            old, state = state, _fold(state, matrix(pending), d).persist(StorageLevel.MEMORY_AND_DISK)
            pending = []
    state.unpersist()
    spark = points.sparkSession
    return spark.createDataFrame([(i + 1, pid, c) for i, (pid, c) in enumerate(chosen)],
                                 "cluster_id INT, point_id BIGINT, coord ARRAY<DOUBLE>")
