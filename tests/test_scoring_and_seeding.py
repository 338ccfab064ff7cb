"""NMI, cost reduction, seeding and expansion."""

import math

from pyspark.sql import functions as F

from centrix.operators import expand as X
from centrix.operators.metrics import cost_reduction, dataset_info, nmi
from centrix.operators.seed import kmeanspp, running_cdf, weighted_pick_cdf
from centrix.sources import testdata as td
from tests.conftest import SF, cents, pts


def _nmi(spark, a, b):
    df = spark.createDataFrame(list(zip(range(len(a)), a, b)), "point_id BIGINT, label INT, cluster_id INT")
    return nmi(df).first().nmi


def test_nmi_cases(spark):
    assert math.isclose(_nmi(spark, [1, 1, 2, 2], [2, 2, 1, 1]), 1.0)
    assert _nmi(spark, [1, 1, 2, 2], [1, 2, 1, 2]) == 0.0
    assert _nmi(spark, [1, 1, 1], [5, 5, 5]) == 1.0
    a, b = [1, 1, 2, 2, 3, 3], [1, 1, 1, 2, 2, 2]
    assert math.isclose(_nmi(spark, a, b), _nmi(spark, b, a))


def test_cost_reduction(spark):
    df = spark.createDataFrame([(1, 200.0), (2, 100.0), (3, 75.0)], "iter INT, cost DOUBLE")
    assert float(cost_reduction(df).first()[0]) == 25.0


def test_profile(spark):
    row = dataset_info(td.points64(spark, SF), labels=td.partition64(spark, SF)).first()
    assert (row.n_features, row.n_clusters) == (64, 10) and row.n_samples == 500


def test_seeding_distinct_repeatable(spark):
    p = td.points2(spark, SF)
    a = [(r.cluster_id, r.point_id) for r in kmeanspp(p, 6, seed=7, checkpoint_every=2).collect()]
    b = [(r.cluster_id, r.point_id) for r in kmeanspp(p, 6, seed=7).collect()]
    assert a == b and len({pid for _, pid in a}) == 6
    ids = {r.point_id for r in p.collect()}
    assert all(pid in ids for _, pid in a)


def test_seeding_all_duplicates_falls_back(spark):
    p = pts(spark, [(1, 1), (1, 1), (1, 1)])
    got = [r.point_id for r in kmeanspp(p, 2, seed=1).collect()]
    assert len(set(got)) == 2


def test_running_cdf_and_pick(spark):
    df = spark.range(1, 101).select(F.col("id").alias("point_id"), F.col("id").cast("double").alias("w"))
    rows = {r.point_id: r.cdf for r in running_cdf(df, "w", buckets=4).collect()}
    assert rows[100] == 5050.0 and rows[10] == 55.0
    assert weighted_pick_cdf(df, "w", 0.5).first().point_id == 71


def test_expand_counts(spark):
    p = pts(spark, [(0, 0)] * 4 + [(10, 10)] * 4)
    lab = spark.createDataFrame([(i + 1, 1 if i < 4 else 2) for i in range(8)], "point_id BIGINT, label INT")
    tc = spark.createDataFrame([(1, [0, 0]), (2, [10, 10]), (3, [50, 50])], "cluster_id INT, coord ARRAY<BIGINT>")
    out, out_lab = X.expand(p, lab, tc, 20, seed=3)
    assert out.count() == 8 + 3 * 4 and out_lab.count() == 20
    counts = {r.label: r["count"] for r in out_lab.groupBy("label").count().collect()}
    assert counts == {1: 8, 2: 8, 3: 4}
    again, _ = X.expand(p, lab, tc, 20, seed=3)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_expand_kernel_equals_sql(spark):
    p, lab = td.points64(spark, SF), td.partition64(spark, SF)
    tc = X.true_centroids_from_labels(p, lab)
    a, al = X.expand(p, lab, tc, 1500, seed=5, method="arrow")
    b, bl = X.expand(p, lab, tc, 1500, seed=5, method="sql")
    assert sorted((r.point_id, tuple(r.coord)) for r in a.collect()) == \
        sorted((r.point_id, tuple(r.coord)) for r in b.collect())
    assert sorted(map(tuple, al.collect())) == sorted(map(tuple, bl.collect()))
