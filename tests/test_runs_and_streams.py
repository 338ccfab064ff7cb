"""Outputs, named tables, resumable training of many data sets, stream scoring."""

import numpy as np
from pyspark.sql import functions as F

from centrix.operators.assign import assign, assign_blocked
from centrix.operators.update import gather_model
from centrix.plans.lloyd import fit
from centrix.plans.runs import score_record, train_many
from centrix.session import scratch_path
from centrix.sources.csv import TIME_SCHEMA, read_history
from centrix.sources.tables import clear_table, replace_table
from centrix.sources.text import load_output, write_output
from centrix.sources import testdata as td
from centrix.streaming.score import score_stream
from tests.conftest import SF, cents, pts


def test_outputs_round_trip(spark):
    res = fit(td.points2(spark, SF), td.start2(spark, SF), max_iter=3)
    path = scratch_path(spark, "out")
    written = write_output(path, labels=res.labels(), centroids=res.centroids(), costs=None)
    assert len(written) == 2
    back = load_output(spark, path)
    assert set(back) == {"label", "centroid"}
    assert back["label"].count() == 1000 and back["centroid"].count() == 5


def test_gather_sorted_by_id(spark):
    c = cents(spark, [(3, 3), (1, 1), (2, 2)])
    row = gather_model(c.orderBy(F.desc("cluster_id"))).first()
    assert [e.cluster_id for e in row.centroids] == [1, 2, 3]


def test_blocked_equals_whole(spark):
    p, s = td.points64(spark, SF), td.start64(spark, SF)
    a = sorted(tuple(r) for r in assign(p, s).collect())
    b = sorted(tuple(r) for r in assign_blocked(p, s, block_rows=4).collect())
    assert a == b


def test_named_tables(spark):
    df = pts(spark, [(1, 2)])
    replace_table(df, "centrix_tmp_points")
    assert spark.table("centrix_tmp_points").count() == 1
    clear_table(spark, "centrix_tmp_points")
    assert not spark.catalog.tableExists("centrix_tmp_points")


def test_train_many_resumes(spark, tmp_path):
    root = tmp_path / "sets"
    root.mkdir()
    for name in ("s1", "s2"):
        (root / f"{name}.txt").write_text("0 0\n0 2\n10 0\n10 2\n")
        (root / f"{name}-ic.txt").write_text("0 0\n10 0\n")
    hist = str(tmp_path / "history")
    h1 = train_many(spark, str(root), ["s1"], hist, max_iter=2)
    assert [r.dataset for r in h1.collect()] == ["s1"]
    h2 = train_many(spark, str(root), ["s1", "s2"], hist, max_iter=2)
    assert sorted(r.dataset for r in h2.collect()) == ["s1", "s2"]
    assert read_history(spark, hist, TIME_SCHEMA).count() == 2


def test_score_record(spark):
    p, lab = td.points64(spark, SF), td.partition64(spark, SF)
    res = fit(p, td.start64(spark, SF), max_iter=3)
    row = score_record("emb", p, lab, res.labels(), 12.5).first()
    assert row.n_samples == 500 and row.n_features == 64 and row.n_clusters == 10
    assert 0.0 < row.nmi <= 1.0 and row.training_time_ms == 12.5


def test_score_stream(spark):
    src = scratch_path(spark, "stream-src")
    td.points2(spark, SF).write.parquet(src)
    stream = spark.readStream.schema("point_id BIGINT, coord ARRAY<BIGINT>").parquet(src)
    q = (score_stream(stream, td.start2(spark, SF)).writeStream.format("memory")
         .queryName("centrix_scored").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.table("centrix_scored").collect())
    want = sorted(tuple(r) for r in assign(td.points2(spark, SF), td.start2(spark, SF)).collect())
    assert got == want


def test_models_past_the_bound_are_searched_by_leaves(spark):
    p, s = td.points64(spark, SF), td.start64(spark, SF)
    whole = sorted(tuple(r) for r in assign(p, s, method="sql").collect())
    spark.conf.set("centrix.maxModelBytes", str(8 * 64 * 9))   # ten centroids are one too many
    try:
        for method in ("sql", "arrow"):
            assert sorted(tuple(r) for r in assign(p, s, method=method).collect()) == whole
    finally:
        spark.conf.unset("centrix.maxModelBytes")


def test_leaves_find_the_nearest_of_many(spark):
    rng = np.random.default_rng(4)
    for draw in (lambda size: rng.integers(0, 40, size).astype(float), lambda size: rng.normal(size=size)):
        C, X = draw((700, 3)), draw((900, 3))
        C[350:420] = C[:70]     # ties between ids
        X[100:700] = X[0]       # most points go to one leaf
        p = pts(spark, X.tolist(), "double").unionByName(pts(spark, X[:3].tolist(), "double")).repartition(5)   # repeated ids
        got = sorted(tuple(r)[:3] for r in assign_blocked(p, cents(spark, C.tolist()), block_rows=20, keep_coord=True).collect())
        assert got == sorted(tuple(r) for r in assign(p, cents(spark, C.tolist())).collect())


def test_text_outputs_and_local_history_csv(spark, tmp_path):
    import glob

    from centrix.sources.csv import LOCAL_SCHEMA
    res = fit(pts(spark, [(0, 0), (0, 2), (10, 0)]), cents(spark, [(0, 0), (10, 0)]), max_iter=2)
    path = str(tmp_path / "txt")
    write_output(path, centroids=res.centroids(), costs=res.costs(), fmt="text")
    lines = sorted(open(f).read().strip() for f in glob.glob(f"{path}/centroid/part-*") if open(f).read().strip())
    assert "1 2 0.0 1.0" in "\n".join(lines)
    csv = tmp_path / "hist.csv"
    csv.write_text("dataset,n_samples,n_features,n_clusters,training_time (ms),NMI score\n"
                   "a3,7500,2,50,3300.002,0.9798693480364158\n")
    row = read_history(spark, str(csv), LOCAL_SCHEMA).first()
    assert row["dataset"] == "a3" and row["n_clusters"] == 50 and row["training_time (ms)"] == 3300.002


def test_assign_routes_beyond_broadcast_bound(spark):
    p, s = td.points64(spark, SF), td.start64(spark, SF)
    whole = sorted(tuple(r) for r in assign(p, s, method="arrow").collect())
    spark.conf.set("centrix.maxModelBytes", "1000")   # 10 x 64 x 8 bytes no longer fit
    try:
        routed = sorted(tuple(r) for r in assign(p, s, method="arrow").collect())
    finally:
        spark.conf.unset("centrix.maxModelBytes")
    assert routed == whole
