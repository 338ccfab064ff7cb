"""Text sources, vector functions, random draws."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from centrix.functions import np_hash_uniform, register_sql_functions, sq_dist, stream
from centrix.functions.hashrand import hash_uniform_sql
from centrix.session import scratch_path
from centrix.sources.text import check_dims, load_points, write_points, clean_text
from centrix.sources.dataset import list_datasets, load_dataset


def _write(path, lines):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.txt", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_text_parse_and_ids(spark, tmp_path):
    _write(str(tmp_path / "a"), [" 1   2 3", "4 5 6"])
    rows = sorted((r.point_id, r.coord) for r in load_points(spark, str(tmp_path / "a")).collect())
    assert rows == [(1, [1, 2, 3]), (2, [4, 5, 6])]


def test_malformed_raises_or_nulls(spark, tmp_path):
    _write(str(tmp_path / "b"), ["1 x"])
    with pytest.raises(Exception):
        load_points(spark, str(tmp_path / "b")).collect()
    got = load_points(spark, str(tmp_path / "b"), on_error="null").collect()
    assert got[0].coord == [1, None]


def test_ragged_is_an_error(spark, tmp_path):
    _write(str(tmp_path / "c"), ["1 2", "1 2 3"])
    with pytest.raises(ValueError):
        check_dims(load_points(spark, str(tmp_path / "c")))


def test_round_trip_many_files(spark):
    df = spark.range(1, 2001).select((F.col("id")).alias("point_id"),
                                     F.array(F.col("id") * 3, F.col("id") % 7).alias("coord")).repartition(5)
    path = scratch_path(spark, "rt")
    write_points(df, path)
    back = sorted((r.point_id, tuple(r.coord)) for r in load_points(spark, path).collect())
    assert back == [(i, (3 * i, i % 7)) for i in range(1, 2001)]
    clean = scratch_path(spark, "clean")
    clean_text(spark, path, clean)
    assert load_points(spark, clean).count() == 2000


def test_dataset_files(spark, tmp_path):
    root = tmp_path / "ds"
    root.mkdir()
    (root / "s1.txt").write_text("0 0\n0 2\n10 0\n")
    (root / "s1-pa.txt").write_text("1\n1\n2\n")
    (root / "s1-c.txt").write_text("0 1\n10 0\n")
    (root / "s1-ic.txt").write_text("0 0\n10 0\n")
    ds = load_dataset(spark, str(root), "s1")
    assert ds.points.count() == 3 and ds.start_centroids.count() == 2
    assert [r.dataset for r in list_datasets(spark, str(root)).collect()] == ["s1"]


def test_sq_dist_sql_function(spark):
    register_sql_functions(spark)
    v = spark.sql("SELECT sq_dist(array(1D, 2D), array(4D, 6D)) AS d").first().d
    assert v == 25.0
    df = spark.createDataFrame([([1, 2], [4.0, 6.0])], "a ARRAY<BIGINT>, b ARRAY<DOUBLE>")
    assert df.select(sq_dist("a", "b")).first()[0] == 25.0


def test_hash_uniform_same_in_spark_and_numpy(spark):
    s = stream(222, 4, 2)
    df = spark.range(0, 5000).select("id", F.expr(hash_uniform_sql(str(s), "id")).alias("u"))
    rows = df.orderBy("id").collect()
    u_np = np_hash_uniform(s, np.arange(5000))
    assert [r.u for r in rows] == u_np.tolist()
    assert 0.0 < u_np.min() and u_np.max() < 1.0 and abs(u_np.mean() - 0.5) < 0.02
