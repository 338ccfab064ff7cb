"""Running sums, places and vector means over rows dealt in any way."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from centrix.functions.tables import register_table_functions
from centrix.operators.expand import shuffle_rows, shuffled_places
from centrix.operators.prefix import prefix_sum, range_sums
from centrix.operators.seed import weighted_pick_cdf
from centrix.operators.update import cluster_sums


def test_a_value_that_most_rows_share_is_summed_in_many_ranges(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("key"), F.lit(1).alias("w"), "id")
    rows, totals = range_sums(df, "w", "key", 12)
    assert rows.where("key = 7").select("_range").distinct().count() > 4
    assert sorted(r["_tot"] for r in totals.collect())[-1] < 1500
    got = [r["run"] for r in prefix_sum(df, "w", "key", "run", 12).orderBy("run").collect()]
    assert got == list(range(1, 3001))
    before = {r["id"]: r["b"] for r in prefix_sum(df, "w", ["key", "id"], "b", 5, before=True).collect()}
    assert [before[i] for i in range(3000)] == list(range(3000))


def test_sums_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, 2.5), (3, None), (4, -1.0)], "k INT, w DOUBLE")
    assert [r["s"] for r in prefix_sum(df, "w", "k", "s").orderBy("k").collect()] == [0.0, 2.5, 2.5, 1.5]
    assert prefix_sum(df.where("k > 9"), "w", "k", "s").count() == 0
    assert weighted_pick_cdf(df.na.fill(0.0).where("k < 4"), "w", 0.9, "k").first()[0] == 2


def test_plans_hold_no_bounds(spark):
    sizes = set()
    for ranges in (2, 60):
        df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("w")).repartition(ranges)
        sizes.add(len(prefix_sum(df, "w", "k", "s", ranges)._jdf.queryExecution().logical().toString().split("\n")))
    assert len(sizes) == 1


def test_places_are_those_of_the_shuffled_order(spark):
    df = spark.range(1, 2001).select(F.col("id").alias("point_id"), (F.col("id") % 3).alias("x")).repartition(7)
    order = [r["point_id"] for r in shuffle_rows(df, 5).collect()]
    for buckets in (1, 3, 200):
        rows = shuffled_places(df, 5, buckets).orderBy("place").collect()
        assert [r["place"] for r in rows] == list(range(1, 2001)) and [r["point_id"] for r in rows] == order
        assert set(rows[0].asDict()) == {"point_id", "x", "shuffle_key", "place"}


def test_cluster_sums_have_equal_bits_over_any_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(int(c) if c < 4 else None, [float(v) for v in x]) for c, x in zip(rng.integers(0, 5, 900), rng.normal(size=(900, 5)) * [1, 1e9, 1e-9, 1, 3])]
    df = spark.createDataFrame(rows, "cluster_id INT, coord ARRAY<DOUBLE>")
    got = [sorted(map(str, cluster_sums(df.repartition(p), 5).collect())) for p in (1, 7, 64)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 5
    big = spark.createDataFrame([(1, [2**61, -1]), (1, [2**61 - 1, 5]), (2, [2**63 - 1, 0])], "cluster_id INT, coord ARRAY<BIGINT>")
    assert sorted((r.cluster_id, r.n, r.sums) for r in cluster_sums(big, 2).collect()) == [(1, 2, [2**62 - 1, 4]), (2, 1, [2**63 - 1, 0])]
    with pytest.raises(Exception):  # noqa: B017  more than a BIGINT holds
        cluster_sums(big.withColumn("cluster_id", F.lit(1)), 2).collect()


MEAN = ("SELECT cluster_id, n, mean FROM vector_mean(TABLE(SELECT cluster_id, col, limb, sum(v) AS v "
        "FROM vector_sums(TABLE(SELECT cluster_id, coord FROM vectors)) GROUP BY cluster_id, col, limb) PARTITION BY cluster_id)")


def test_vector_mean_in_sql(spark):
    register_table_functions(spark)
    rng = np.random.default_rng(8)
    for d in (1, 3, 200):
        X, c = rng.normal(size=(600, d)), rng.integers(0, 4, 600)
        df = spark.createDataFrame([(int(k), [float(v) for v in x]) for k, x in zip(c, X)], "cluster_id INT, coord ARRAY<DOUBLE>")
        seen = []
        for parts in (1, 9):
            df.repartition(parts).createOrReplaceTempView("vectors")
            seen.append({r.cluster_id: (r.n, r.mean) for r in spark.sql(MEAN).collect()})
        assert seen[0] == seen[1]
        for k in range(4):
            assert seen[0][k][0] == (c == k).sum() and np.allclose(seen[0][k][1], X[c == k].mean(axis=0), rtol=1e-13, atol=1e-15)


@pytest.mark.parametrize("bad", [[1.0], [1.0, None], None, [1.0, 2.0, 3.0]])
def test_vector_mean_refuses_bad_vectors(spark, bad):
    register_table_functions(spark)
    rows = [(1, [1.0, 2.0]), (1, [2.0, 3.0]), (1, bad)]
    for parts in (1, 3):
        spark.createDataFrame(rows, "cluster_id INT, coord ARRAY<DOUBLE>").repartition(parts).createOrReplaceTempView("vectors")
        with pytest.raises(Exception):  # noqa: B017
            spark.sql(MEAN).collect()
