"""Lloyd training: hand-made cases (one per defect/rule) and properties."""

import numpy as np
import pytest

from centrix.operators.assign import assign, distinct_points, nearest_all_ties
from centrix.operators.update import update_centroids
from centrix.plans.lloyd import fit
from centrix.sources import testdata as td
from tests.conftest import SF, cents, pts


@pytest.mark.parametrize("method", ["arrow", "sql"])
def test_split_true_argmin(spark, method):
    p = pts(spark, [(0, 0), (0, 2), (10, 0), (10, 2)])
    c = cents(spark, [(0, 0), (10, 0)])
    lab = {r.point_id: r.cluster_id for r in assign(p, c, method=method).collect()}
    assert lab == {1: 1, 2: 1, 3: 2, 4: 2}
    res = fit(p, c, max_iter=2, method=method)
    got = sorted((r.cluster_id, tuple(r.coord)) for r in res.centroids().collect())
    assert got == [(1, (0.0, 1.0)), (2, (10.0, 1.0))]


def test_third_feature_is_used(spark):
    p = pts(spark, [(0, 0, 0), (0, 0, 10)])
    c = cents(spark, [(0, 0, 0), (0, 0, 9)])
    assert sorted(r.cluster_id for r in assign(p, c, method="arrow").collect()) == [1, 2]


@pytest.mark.parametrize("method", ["arrow", "sql"])
def test_tie_lowest_id_and_ties_kept(spark, method):
    p = pts(spark, [(5, 0)])
    c = cents(spark, [(0, 0), (10, 0)])
    assert [r.cluster_id for r in assign(p, c, method=method).collect()] == [1]
    assert sorted(r.cluster_id for r in nearest_all_ties(p, c).collect()) == [1, 2]


def test_empty_cluster_kept_or_dropped(spark):
    p = pts(spark, [(0, 0), (1, 0)])
    c = cents(spark, [(0, 0), (1, 0), (99, 99)])
    res = fit(p, c, max_iter=3)
    rows = {r.cluster_id: (r.n, tuple(r.coord)) for r in res.centroids().collect()}
    assert rows[3] == (0, (99.0, 99.0)) and len(rows) == 3
    a = assign(p, c, keep_coord=True)
    kept = {r.cluster_id: r.n for r in update_centroids(a, c).collect()}
    dropped = {r.cluster_id for r in update_centroids(a, c, empty="drop").collect()}
    assert kept == {1: 1, 2: 1, 3: 0} and dropped == {1, 2}


def test_duplicates_count_and_distinct_mode(spark):
    p = pts(spark, [(0, 0), (0, 0), (0, 0), (4, 0)])
    c = cents(spark, [(0, 0)])
    res = fit(p, c, max_iter=2)
    assert [tuple(r.coord) for r in res.centroids().collect()] == [(1.0, 0.0)]
    d = {tuple(r.coord): (r.w, r.point_id) for r in distinct_points(p).collect()}
    assert d == {(0, 0): (3, 1), (4, 0): (1, 4)}


def test_one_iteration_returns_start(spark):
    p = pts(spark, [(0, 0), (3, 4), (9, 9)])
    c = cents(spark, [(1, 1), (8, 8)])
    res = fit(p, c, max_iter=1)
    assert sorted(tuple(r.coord) for r in res.centroids().collect()) == [(1.0, 1.0), (8.0, 8.0)]


def test_properties_on_fixture(spark):
    p, s = td.points64(spark, SF), td.start64(spark, SF)
    start_before = sorted((r.cluster_id, tuple(r.coord)) for r in s.collect())
    res = fit(p, s, max_iter=6)
    costs = [c for _, _, _, c in res.history]
    totals = [float(np.sum(c)) for c in costs]
    assert all(b <= a + 1e-6 for a, b in zip(totals, totals[1:]))          # cost never rises
    n = p.count()
    assert all(int(np.sum(m)) == n for _, _, m, _ in res.history)         # every point counted once
    assert all(model.k == 10 for _, model, _, _ in res.history)           # k rows always
    assert sorted((r.cluster_id, tuple(r.coord)) for r in s.collect()) == start_before  # inputs unchanged
    # labels are the argmin of their own centroids, both physical forms agree
    a = sorted(tuple(r) for r in res.labels("arrow").collect())
    b = sorted(tuple(r) for r in res.labels("sql").collect())
    assert a == b
    # same result whatever the partitioning
    res2 = fit(p.repartition(7), s, max_iter=6)
    assert sorted((r.cluster_id, tuple(r.coord)) for r in res2.centroids().collect()) == \
        sorted((r.cluster_id, tuple(r.coord)) for r in res.centroids().collect())


def test_centroid_is_mean_after_update(spark):
    p, s = td.points2(spark, SF), td.start2(spark, SF)
    res = fit(p, s, max_iter=2)
    first = res.history[0]
    labels = {r.point_id: r.cluster_id for r in assign(p, first[1]).collect()}
    coords = {r.point_id: r.coord for r in p.collect()}
    for cid, c in zip(res.final.ids, res.final.C):
        members = [coords[i] for i, l in labels.items() if l == cid]
        if members:
            assert np.allclose(np.mean(np.array(members, dtype=float), axis=0), c, rtol=0, atol=1e-9)


def test_tol_stops_early(spark):
    p = pts(spark, [(0, 0), (0, 2), (10, 0), (10, 2)])
    c = cents(spark, [(0, 0), (10, 0)])
    res = fit(p, c, max_iter=50, tol=0.0)
    assert len(res.history) <= 3


def test_fast_path_matches_exact_on_fixture(spark):
    p, s = td.points64(spark, SF), td.start64(spark, SF)
    a = fit(p, s, max_iter=4)
    b = fit(p, s, max_iter=4, exact=False)
    assert sorted((r.cluster_id, tuple(r.coord)) for r in a.centroids().collect()) == \
        sorted((r.cluster_id, tuple(r.coord)) for r in b.centroids().collect())


def test_history_spills_past_the_bound(spark, monkeypatch):
    import centrix.plans.lloyd as L
    p, s = td.points2(spark, SF), td.start2(spark, SF)
    whole = L.fit(p, s, max_iter=4)
    monkeypatch.setattr(L, "MAX_HISTORY_BYTES", 1)
    spilled = L.fit(p, s, max_iter=4)
    assert spilled.history_path is not None and spilled.history[0][1] is None
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(spilled.centroid_history()) == key(whole.centroid_history())
    assert key(spilled.labels_at([1, 4])) == key(whole.labels_at([1, 4]))


def test_history_is_per_iteration_not_final_copies(spark):
    p = pts(spark, [(0, 0), (0, 2), (10, 0), (10, 2)])
    c = cents(spark, [(0, 0), (10, 0)])
    res = fit(p, c, max_iter=3)
    hist = {(r.iter, r.cluster_id): tuple(r.coord) for r in res.centroid_history().collect()}
    assert hist[(1, 1)] == (0.0, 0.0) and hist[(2, 1)] == (0.0, 1.0) and hist[(3, 1)] == (0.0, 1.0)
    costs = [r.cost for r in res.costs().orderBy("iter").collect()]
    assert costs == [8.0, 4.0, 4.0]


def test_collapsed_duplicates_give_the_same_model(spark):
    p = pts(spark, [(0, 0)] * 30 + [(0, 2)] * 5 + [(10, 0), (10, 2), (10, 2), (9, 1)])
    c = cents(spark, [(0, 0), (10, 0)])
    a = fit(p, c, max_iter=3)
    b = fit(p, c, max_iter=3, collapse_duplicates=True)
    key = lambda r: sorted((x.cluster_id, x.n, tuple(x.coord)) for x in r.centroids().collect())
    assert key(a) == key(b)
    # double costs: dist * w vs w separate additions, equal up to rounding
    assert np.allclose(np.sum([h[3] for h in a.history], axis=1),
                       np.sum([h[3] for h in b.history], axis=1), rtol=1e-12, atol=0)
    assert sorted(tuple(r) for r in b.labels().collect()) == sorted(tuple(r) for r in a.labels().collect())
    f = td.points2(spark, SF)
    s = td.start2(spark, SF)
    assert sorted((r.cluster_id, r.n, tuple(r.coord)) for r in fit(f, s, 4).centroids().collect()) == \
        sorted((r.cluster_id, r.n, tuple(r.coord)) for r in fit(f, s, 4, collapse_duplicates=True).centroids().collect())
