"""Dense blocks and file-order ids across many splits of one file."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from centrix.operators.blocks import narrow, to_blocks
from centrix.sources.text import load_points
from tests.conftest import pts


def test_blocks_keep_ids_and_values(spark):
    df = spark.range(1, 5001).select(F.col("id").alias("point_id"),
                                     F.array(F.col("id"), F.col("id") * 2, -F.col("id")).alias("coord")).repartition(3)
    blocks = to_blocks(df, 3, block_bytes=8 * 3 * 700).collect()
    assert all(b.n <= 700 for b in blocks) and sum(b.n for b in blocks) == 5000
    got = {}
    for b in blocks:
        ids = np.frombuffer(b.ids, dtype=np.int64)
        X = np.frombuffer(b.x, dtype=b.kind).reshape(-1, 3)
        assert b.kind == "i2" and b.plain
        got.update({int(i): tuple(x) for i, x in zip(ids, X)})
    assert got == {i: (float(i), 2.0 * i, -float(i)) for i in range(1, 5001)}


@pytest.mark.parametrize("values, kind", [([1, -128.5], "f4"), ([1, -127], "i1"), ([128, -1], "i2"), ([2**30 + 1, -5], "i4"), ([2**31, 3], "f4"),
                                          ([2**31 + 1, 3], "f8"), ([0.1, 1], "f8"), ([-0.0, 1], "f4"), ([1e300, 1], "f8"), ([np.inf, 1], "f4")])
def test_matrices_are_kept_narrow_and_whole(values, kind):
    X = np.array([values, values[::-1]], dtype=np.float64)
    raw, got = narrow(X)
    assert got == kind and np.frombuffer(raw, kind).astype(np.float64).tobytes() == X.tobytes()


def test_blocks_reject_ragged(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [1, 2, 3])], "point_id BIGINT, coord ARRAY<BIGINT>")
    with pytest.raises(Exception):
        to_blocks(df, 2).collect()


def test_ids_follow_lines_across_splits(spark, tmp_path):
    path = tmp_path / "big"
    path.mkdir()
    with open(path / "part-0.txt", "w") as f:
        for i in range(1, 3001):
            f.write(f"{i} {i % 13}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = load_points(spark, str(path))
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 5
        rows = sorted((r.point_id, r.coord[0]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rows == [(i, i) for i in range(1, 3001)]
