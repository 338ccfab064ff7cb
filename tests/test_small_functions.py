"""F8-F11 helpers and P8 iteration selection."""

from pyspark.sql import functions as F

from centrix.functions import dataset_name, millis, n_local_trials, per_cluster_rows, trunc_to_long
from centrix.operators.report import last_iteration, select_iterations


def test_numeric_helpers(spark):
    row = spark.createDataFrame([(1.2345678, -2.7, "a3")], "s DOUBLE, x DOUBLE, b STRING").select(
        millis("s").alias("ms"), trunc_to_long("x").alias("t"), dataset_name("b", "e2").alias("n")).first()
    assert (row.ms, row.t, row.n) == (1234.568, -2, "a3e2")
    assert n_local_trials(50) == 5 and n_local_trials(16) == 4 and n_local_trials(1) == 2
    assert per_cluster_rows(20, 8, 3) == 4


def test_iteration_selection(spark):
    hist = spark.range(0, 100).select(F.col("id").cast("int").alias("iter"), (F.col("id") * 2.0).alias("cost"))
    assert sorted(r.iter for r in select_iterations(hist, [0, 30, 60, 99]).collect()) == [0, 30, 60, 99]
    assert last_iteration(hist, "cost").first().cost == 198.0


def test_vector_helpers_and_potential(spark):
    from centrix.functions import vec_add, vec_div, vec_least
    from centrix.operators.seed import best_candidate, potential
    df = spark.createDataFrame([([1, 2], [4, 0])], "a ARRAY<BIGINT>, b ARRAY<BIGINT>")
    row = df.select(vec_add("a", "b").alias("s"), vec_div("a", 2).alias("h"), vec_least("a", "b").alias("m")).first()
    assert (row.s, row.h, row.m) == ([5, 2], [0.5, 1.0], [1, 0])
    pts = spark.createDataFrame([(1, [0.0, 0.0], 4.0), (2, [3.0, 0.0], 1.0)],
                                "point_id BIGINT, coord ARRAY<DOUBLE>, dn DOUBLE")
    dist = lambda c: f"aggregate(zip_with(coord, array({c[0]}D, {c[1]}D), (x, y) -> (x - y) * (x - y)), 0D, (s, t) -> s + t)"
    pots = potential(pts, "dn", [(0.0, 0.0), (3.0, 0.0)], dist).first()
    assert (pots.pot1, pots.pot2) == (1.0, 4.0)
    assert best_candidate([pots.pot1, pots.pot2]) == 0 and best_candidate([2.0, 2.0]) == 0
