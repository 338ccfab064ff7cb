"""Exact sums: the same bits in any order; skipped distances change nothing."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from centrix.operators import kernels
from centrix.operators.exact import ExactSums, is_plain, to_doubles
from centrix.plans import lloyd as L
from tests.conftest import cents

RNG = np.random.default_rng(0)
CASES = {
    "integers": RNG.integers(-10**6, 10**6, (1500, 3)).astype(float),
    "fractions": RNG.normal(size=(1500, 3)),
    "wide": RNG.normal(size=(1500, 2)) * 10.0 ** RNG.integers(-200, 200, (1500, 2)),
    "smallest": RNG.normal(size=(500, 2)) * 5e-320,
    "cancelling": np.concatenate([x := RNG.normal(size=(800, 2)) * 1e10, -x, RNG.normal(size=(10, 2)) * 1e-10]),
    "zeros": np.zeros((10, 2)),
}


def _dealt(X, idx, k, weight, cuts):
    held = {}
    for rows in np.array_split(RNG.permutation(len(X)), cuts):
        sums = ExactSums(k, X.shape[1])
        sums.add_columns(idx[rows], np.ascontiguousarray(X[rows].T), weight=None if weight is None else weight[rows])
        for g, c, at, v in zip(*(x.tolist() for x in sums.rows())):
            held[g, c, at] = held.get((g, c, at), 0) + v
    keys = np.array(list(held), np.int64).reshape(-1, 3)
    return to_doubles((k, X.shape[1]), *keys.T, np.array(list(held.values()), np.int64))


@pytest.mark.parametrize("weights", [None, 300, 2**40])
@pytest.mark.parametrize("name", sorted(CASES))
def test_sums_are_rounded_once_whatever_the_order(name, weights):
    X, k = CASES[name], 4
    idx = RNG.integers(0, k, len(X))
    weight = None if weights is None else RNG.integers(1, weights, len(X)).astype(float)
    got = [_dealt(X, idx, k, weight, cuts) for cuts in (1, 7, 64)]
    whole = np.ones(len(X), int) if weight is None else weight.astype(int)
    want = [[float(sum((Fraction(float(v)) * int(w) for v, w in zip(X[idx == g, c], whole[idx == g])), Fraction(0)))
             for c in range(X.shape[1])] for g in range(k)]
    for sums in got:
        assert (sums == np.array(want)).all()


def test_integers_beyond_doubles():
    X, idx = RNG.integers(-2**62, 2**62, (2000, 2)), RNG.integers(0, 300, 2000)
    sums = ExactSums(300, 2)
    sums.add_integers(idx, X.T)
    total = {}
    for g, c, limb, v in zip(*(x.tolist() for x in sums.rows())):
        total[g, c] = total.get((g, c), 0) + (v << 32 * limb)
    assert all(total.get((g, c), 0) == sum(X[idx == g, c].tolist()) for g in range(300) for c in range(2))


def test_plain_means_any_order_is_exact():
    assert is_plain(np.arange(1000.0).reshape(-1, 2)) and is_plain(np.full((10, 2), 0.125)) and is_plain(np.zeros((0, 3)))
    assert not is_plain(np.array([[0.1], [1.0]])) and not is_plain(np.array([[2.0**53 - 1]] * 4)) and not is_plain(np.array([[1e300], [1e-300]]))
    with pytest.raises(ValueError, match="finite"):
        is_plain(np.array([[np.nan]]))


def _runs(spark, X, start, **params):
    out = []
    for parts in (1, 7, 64):
        rows = [(i + 1, [float(v) for v in x]) for i, x in enumerate(X)]
        points = spark.createDataFrame(rows, "point_id BIGINT, coord ARRAY<DOUBLE>").repartition(parts)
        res = L.fit(points, cents(spark, start), **params)
        out.append(([(it, m.C.tobytes(), n.tolist(), cost.tobytes()) for it, m, n, cost in res.history],
                    sorted(map(tuple, res.labels().collect()))))
        res.unpersist()
    return out


@pytest.mark.parametrize("params", [{}, {"method": "sql"}, {"collapse_duplicates": True}], ids=["blocks", "sql", "collapsed"])
def test_fractional_training_has_equal_bits_over_any_partitions(spark, params):
    X = np.concatenate([RNG.normal(c, 1.3, (150, 3)) * [1, 1e-3, 1e5] for c in (0, 3, 7)])
    X = np.concatenate([X, X[:40]])
    one, *others = _runs(spark, X, X[[0, 200, 400, 10]], max_iter=5 if params else 8, **params)
    for other in others:
        assert other == one
    plain = _runs(spark, X, X[[0, 200, 400, 10]], max_iter=5 if params else 8)[0]
    assert plain == one


def test_bounds_change_nothing(spark, monkeypatch):
    X = np.concatenate([RNG.integers(0, 60, (400, 2)).astype(float), RNG.normal(30, 5, (300, 2))])
    start = X[RNG.choice(len(X), 12, replace=False)]
    made = []
    real = L.with_bounds
    monkeypatch.setattr(L, "with_bounds", lambda *a: made.append(1) or real(*a))
    monkeypatch.setattr(L, "BOUND_COST", 1 << 40)
    want = _runs(spark, X, start, max_iter=12)[0]
    assert not made
    monkeypatch.setattr(L, "TASK_COST", 0)
    for cost in (-12, 0):  # bounds at every pass; as often as searches pay
        monkeypatch.setattr(L, "BOUND_COST", cost)
        assert _runs(spark, X, start, max_iter=12)[0] == want
    assert len(made) > 6


def test_a_point_is_searched_unless_its_bound_holds():
    X, C = RNG.normal(size=(4000, 5)), RNG.normal(size=(30, 5))
    label, far = kernels.bounds(X, kernels.Tree(C))
    for moved in (0.0, 1e-9, 0.02, 0.3, 3.0):
        new = C + RNG.normal(size=C.shape) * moved
        tree, XT = kernels.Tree(new), np.ascontiguousarray(X.T)
        D = kernels.sq_dists(X, new)
        for gap in (kernels.half_gaps(new), np.zeros(30)):
            idx, dist, searched = kernels.bounded_nearest(XT, tree, np.ascontiguousarray(new.T), label, far, kernels.drifts(new, C), gap)
            assert (idx == D.argmin(axis=1)).all() and (dist == D.min(axis=1)).all()
        assert searched < 10 if moved < 1e-6 else searched <= len(X)


@pytest.mark.parametrize("n, k, d", [(500, 5, 2), (800, 300, 2), (800, 900, 3), (200, 200, 40), (100, 70, 1)])
def test_tree_finds_what_all_distances_find(n, k, d):
    for draw in (lambda s: RNG.integers(0, 12, s).astype(float), lambda s: RNG.normal(size=s)):
        X, C = draw((n, d)), draw((k, d))
        D = kernels.sq_dists(X, C)
        tree = kernels.Tree(C)
        idx, dist, other = tree.nearest(np.ascontiguousarray(X.T), second=True)
        assert (idx == D.argmin(axis=1)).all() and (dist == D.min(axis=1)).all()
        assert (other == (np.sort(D, axis=1)[:, 1] if k > 1 else np.inf)).all()
        again = kernels.nearest(X, C)
        assert (again[0] == idx).all() and (again[1] == dist).all()


def test_non_finite_points_fail(spark):
    p = spark.range(1, 9).select(F.col("id").alias("point_id"), F.array(F.col("id").cast("double"), F.lit(float("nan"))).alias("coord"))
    for method in ("arrow", "sql"):
        with pytest.raises(Exception, match="finite"):
            L.fit(p, cents(spark, [[0.0, 0.0], [1.0, 1.0]]), max_iter=2, method=method)
