"""Bad input is an error everywhere, and results don't depend on size limits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from centrix.functions.hashrand import P, hash_uniform, np_hash_uniform, stream
from centrix.operators import assign as A
from centrix.operators.blocks import to_blocks
from centrix.operators.expand import expand
from centrix.operators.metrics import cost_reduction, dataset_info
from centrix.operators.seed import running_cdf, weighted_pick_cdf
from centrix.operators.update import cluster_sums
from centrix.plans.lloyd import fit
from centrix.plans.runs import local_record, score_output, train_many, write_dataset
from centrix.sources.csv import LOCAL_SCHEMA
from centrix.sources.dataset import list_datasets, load_dataset
from centrix.sources.text import load_output, load_points, with_row_id, write_output
from tests.conftest import cents, pts

BAD = {"null": [1, None], "short": [1], "long": [1, 2, 3]}


def _points(spark, kind):
    return pts(spark, [[0, 0], [1, 1], BAD[kind], [9, 9]])


ENTRY = {
    "arrow": lambda p, c: A.assign(p, c, method="arrow").collect(),
    "sql": lambda p, c: A.assign(p, c, method="sql").collect(),
    "blocked": lambda p, c: A.assign_blocked(p, c, block_rows=1).collect(),
    "min_dist": lambda p, c: A.min_dist(p, c).collect(),
    "ties": lambda p, c: A.nearest_all_ties(p, c).collect(),
    "pairs": lambda p, c: A.pair_distances(p, c).collect(),
    "blocks": lambda p, c: to_blocks(p, 2).collect(),
    "fit": lambda p, c: fit(p, c, max_iter=2),
    "fit sql": lambda p, c: fit(p, c, max_iter=2, method="sql"),
    "fit collapsed": lambda p, c: fit(p, c, max_iter=2, collapse_duplicates=True),
    "sums": lambda p, c: cluster_sums(p.withColumn("cluster_id", F.lit(1)), 2).collect(),
    "profile": lambda p, c: dataset_info(p).collect(),
}


@pytest.mark.parametrize("kind", sorted(BAD))
@pytest.mark.parametrize("entry", sorted(ENTRY))
def test_bad_points_fail(spark, entry, kind):
    with pytest.raises(Exception):  # noqa: B017  the job's own error type varies by form
        ENTRY[entry](_points(spark, kind), cents(spark, [[0, 0], [9, 9]]))


def test_draws_have_no_period_and_agree(spark):
    ids = np.array([7, 7 + P, 7 + 2 * P, 7 + (1 << 30), -7, 2**62 + 7, 7 + 2**61], dtype=np.int64)
    for s in (0, stream(3, 1, 2)):
        u = np_hash_uniform(s, ids)
        assert len(set(u.tolist())) == len(ids) and (0 < u).all() and (u < 1).all()
        df = spark.createDataFrame([(int(i),) for i in ids], "point_id BIGINT").select("point_id", hash_uniform(s, "point_id").alias("u"))
        got = {r.point_id: r.u for r in df.collect()}
        assert [got[int(i)] for i in ids] == u.tolist()


def test_draws_look_uniform():
    u = np_hash_uniform(stream(1, 2), np.arange(200_000))
    counts = np.histogram(u, bins=50, range=(0, 1))[0]
    assert abs(u.mean() - 0.5) < 0.005 and counts.min() > 3700 and counts.max() < 4300
    assert len(np.unique(u)) == 200_000


def test_new_rows_carry_their_cluster_id(spark):
    p = pts(spark, [[0, 0], [100, 100]])
    lab = spark.createDataFrame([(1, 1), (2, 7)], "point_id BIGINT, label INT")
    true = spark.createDataFrame([(1, [0.0, 0.0]), (7, [100.0, 100.0])], "cluster_id INT, coord ARRAY<DOUBLE>")
    for method in ("arrow", "sql"):
        out, out_lab = expand(p, lab, true, 10, seed=5, method=method)
        rows = out.join(out_lab, "point_id").collect()
        assert len(rows) == 10 and {r.label for r in rows} == {1, 7}
        assert all((r.coord[0] > 50) == (r.label == 7) for r in rows)


def test_part_files_order_by_number(spark):
    names = ["part-99999-x-c000.txt", "part-100000-x-c000.txt", "part-100001-x-c000.txt"]
    rows = [(f"{k}", f"file:/d/{n}", 0) for k, n in enumerate(names)]
    lines = spark.createDataFrame(rows, "value STRING, _path STRING, _block BIGINT").coalesce(1)
    assert [r.value for r in with_row_id(lines).orderBy("point_id").collect()] == ["0", "1", "2"]


def test_data_sets_written_here_are_listed_and_keep_fractions(spark, tmp_path):
    root = str(tmp_path / "sets")
    write_dataset(root, "a3", pts(spark, [[1, 2], [3, 4]]), start=cents(spark, [[0.75, -3.9]]))
    assert [r.dataset for r in list_datasets(spark, root).collect()] == ["a3"]
    assert load_dataset(spark, root, "a3").start_centroids.first().coord == [0.75, -3.9]
    assert load_points(spark, root + "/a3.txt").count() == 2


def test_saved_text_is_read_back(spark, tmp_path):
    path = str(tmp_path / "out")
    labels = spark.createDataFrame([(1, 1, 0.5), (2, 2, 0.25)], "point_id BIGINT, cluster_id INT, dist DOUBLE")
    cen = spark.createDataFrame([(1, 3, [0.1, 2.0])], "cluster_id INT, n BIGINT, coord ARRAY<DOUBLE>")
    costs = spark.createDataFrame([(1, 10.0), (2, 7.5)], "iter INT, cost DOUBLE")
    write_output(path, labels=labels, centroids=cen, costs=costs, fmt="text")
    back = load_output(spark, path, fmt="text")
    assert set(back) == {"label", "centroid", "cost"}
    assert back["centroid"].collect() == cen.collect() and sorted(back["label"].collect()) == sorted(labels.collect())
    truth = spark.createDataFrame([(1, 5), (2, 6)], "point_id BIGINT, label INT")
    row = score_output(spark, path, truth, fmt="text").first()
    assert row.nmi == 1.0 and float(row.cost_reduction_pct) == 25.0


def test_cost_drop_from_zero_is_null(spark):
    costs = spark.createDataFrame([(1, 5.0), (2, 0.0), (3, 0.0)], "iter INT, cost DOUBLE")
    assert cost_reduction(costs).first()[0] is None


def test_history_is_appended(spark, tmp_path):
    root, hist = str(tmp_path / "s"), str(tmp_path / "h")
    for name in ("a", "b"):
        write_dataset(root, name, pts(spark, [[0, 0], [9, 9]]), start=cents(spark, [[0, 0], [9, 9]]))
    train_many(spark, root, ["a"], hist, max_iter=2)
    first = {r.dataset: r.time for r in spark.read.csv(hist, header=True).collect()}
    out = {r.dataset: r.time for r in train_many(spark, root, ["a", "b"], hist, max_iter=2).collect()}
    assert set(out) == {"a", "b"} and float(first["a"]) == out["a"]


def test_local_record_columns(spark):
    score = spark.createDataFrame([("a", 2, 2, 2, 1.5, 0.5)], "dataset STRING, n_samples BIGINT, n_features INT, n_clusters INT, training_time_ms DOUBLE, nmi DOUBLE")
    assert local_record(score).schema.simpleString() == spark.createDataFrame([], LOCAL_SCHEMA).schema.simpleString()


def test_running_sum_in_many_ranges(spark):
    df = spark.range(1000).select(F.col("id").alias("point_id"), (F.col("id") % 7).cast("double").alias("w"))
    want = np.cumsum(np.arange(1000) % 7)
    for buckets in (1, 3, 50, 400):
        got = [r.cdf for r in running_cdf(df, "w", buckets=buckets).orderBy("point_id").collect()]
        assert got == want.tolist()
    assert weighted_pick_cdf(df, "w", 0.5).first()[0] == int(np.argmax(want >= 0.5 * want[-1]))
