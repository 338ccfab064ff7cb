"""Lloyd training against a brute-force reading of the contract on random
small fixtures (ties, duplicates and empty clusters included)."""

import numpy as np
import pytest

from centrix.plans.lloyd import fit
from tests.conftest import cents, pts


def brute_lloyd(P, C, max_iter):
    """Plain-Python Lloyd: squared distance summed left to right, lowest id
    on a tie, empty cluster keeps its centroid, max_iter - 1 updates."""
    C = [list(map(float, c)) for c in C]
    for it in range(1, max_iter + 1):
        labels = []
        for p in P:
            best = None
            for i, c in enumerate(C):
                d = 0.0
                for x, y in zip(p, c):
                    d = d + (float(x) - y) * (float(x) - y)
                if best is None or d < best[0]:
                    best = (d, i)
            labels.append(best)
        counts = [sum(1 for _, i in labels if i == j) for j in range(len(C))]
        if it == max_iter:
            return C, counts, labels
        for j in range(len(C)):
            members = [P[m] for m, (_, i) in enumerate(labels) if i == j]
            if members:
                C[j] = [sum(int(m[f]) for m in members) / len(members) for f in range(len(P[0]))]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_fit_matches_brute_force(spark, seed):
    rng = np.random.RandomState(seed)
    n, d, k = rng.randint(5, 40), rng.randint(1, 4), rng.randint(1, 5)
    P = [tuple(int(v) for v in row) for row in rng.randint(-3, 4, size=(n, d))]   # small range: ties, copies
    C = [tuple(int(v) for v in row) for row in rng.randint(-6, 7, size=(k, d))]
    want_c, want_n, want_labels = brute_lloyd(P, C, 4)
    for method in ("arrow", "sql"):
        res = fit(pts(spark, P), cents(spark, C), max_iter=4, method=method)
        got = sorted((r.cluster_id, r.n, tuple(r.coord)) for r in res.centroids().collect())
        assert got == [(j + 1, want_n[j], tuple(want_c[j])) for j in range(k)]
        labels = sorted((r.point_id, r.cluster_id, r.dist) for r in res.labels().collect())
        assert labels == [(m + 1, i + 1, dist) for m, (dist, i) in enumerate(want_labels)]


def brute_kmeanspp(P, k, seed, trials):
    """Greedy k-means++ with the same counter-based draws, in plain Python."""
    import math

    from centrix.functions.hashrand import np_hash_uniform, stream
    ids = np.arange(1, len(P) + 1)
    X = np.array(P, dtype=float)

    def dist(a, b):
        s = 0.0
        for x, y in zip(a, b):
            s = s + (x - y) * (x - y)
        return s

    u0 = np_hash_uniform(stream(seed, 0, 0), ids)
    first = min(range(len(P)), key=lambda i: (u0[i], ids[i]))
    chosen = [first]
    dn = [dist(X[i], X[first]) for i in range(len(P))]
    for c in range(2, k + 1):
        cands = []
        for t in range(1, trials + 1):
            u = np_hash_uniform(stream(seed, c, t), ids)
            keys = [(-math.log(u[i]) / dn[i], ids[i], i) for i in range(len(P)) if dn[i] > 0]
            cands.append(min(keys)[2])
        pots = [sum(min(dn[i], dist(X[i], X[j])) for i in range(len(P))) for j in cands]
        best = cands[int(np.argmin(pots))]
        chosen.append(best)
        dn = [min(dn[i], dist(X[i], X[best])) for i in range(len(P))]
    return [int(ids[i]) for i in chosen]


@pytest.mark.parametrize("seed,every", [(5, 1), (6, 2), (7, 8)])
def test_kmeanspp_matches_brute_force(spark, seed, every):
    from centrix.functions.numeric import n_local_trials
    from centrix.operators.seed import kmeanspp
    rng = np.random.RandomState(seed)
    n, d, k = rng.randint(20, 60), rng.randint(1, 4), rng.randint(2, 7)
    P = [tuple(int(v) for v in row) for row in rng.randint(-20, 21, size=(n, d))]
    want = brute_kmeanspp(P, k, seed, n_local_trials(k))
    got = [r.point_id for r in kmeanspp(pts(spark, P), k, seed=seed, checkpoint_every=every).orderBy("cluster_id").collect()]
    assert got == want


def _nmi_python(a, b):
    import math
    from collections import Counter
    n = len(a)
    ca, cb, cab = Counter(a), Counter(b), Counter(zip(a, b))
    if len(ca) == 1 and len(cb) == 1:
        return 1.0
    mi = sum(v / n * math.log(n * v / (ca[x] * cb[y])) for (x, y), v in cab.items())
    if mi <= 0:
        return 0.0
    ha = -sum(v / n * math.log(v / n) for v in ca.values())
    hb = -sum(v / n * math.log(v / n) for v in cb.values())
    return mi / ((ha + hb) / 2)


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_nmi_matches_formula(spark, seed):
    from centrix.operators.metrics import nmi
    rng = np.random.RandomState(seed)
    n = rng.randint(10, 300)
    a = rng.randint(1, rng.randint(2, 8), size=n).tolist()
    b = [x if rng.rand() < 0.7 else int(rng.randint(1, 6)) for x in a]
    df = spark.createDataFrame([(i, int(x), int(y)) for i, (x, y) in enumerate(zip(a, b))],
                               "point_id BIGINT, label INT, cluster_id INT")
    assert abs(nmi(df).first().nmi - _nmi_python(a, b)) < 1e-12


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_running_cdf_matches_cumsum(spark, buckets):
    from pyspark.sql import functions as F

    from centrix.operators.seed import running_cdf
    rng = np.random.RandomState(buckets)
    ids = rng.permutation(5000)[:1200] + 1
    w = rng.randint(0, 50, size=ids.shape[0]).astype(float)
    df = spark.createDataFrame([(int(i), float(x)) for i, x in zip(ids, w)], "point_id BIGINT, w DOUBLE")
    got = {r.point_id: r.cdf for r in running_cdf(df.repartition(5), "w", buckets=buckets).collect()}
    order = np.argsort(ids)
    want = dict(zip(ids[order].tolist(), np.cumsum(w[order]).tolist()))
    assert got == want
