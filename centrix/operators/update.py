"""Centroid update from an assignment.

``assigned`` is ``(point_id, coord, cluster_id[, dist])``.  Sums are made batch by
batch in the tasks and merged by a partial (map-side) + final aggregate, so a
task sends one row per cluster, feature and limb whatever the skew between clusters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centrix.functions.vector import checked
from centrix.operators import kernels
from centrix.operators.exact import ExactSums, merge_limbs, to_doubles
from centrix.operators.model import check_model, collect_model
from centrix.session import ship_package


def _dim(df: DataFrame) -> int:
    row = df.select(F.size("coord").alias("d")).first()
    if row is None:
        raise ValueError("empty input")
    return int(row["d"])


WHOLE = ("tinyint", "smallint", "int", "bigint")


def partial_sums(keys: pa.Array, coord: pa.Array, d: int) -> pa.Table:
    """Exact sums of the vectors of each key, as rows ``(key, col, limb, v)``;
    column ``d`` counts them.  A null key is a key."""
    coded = keys.dictionary_encode(null_encoding="encode")
    sums = ExactSums(len(coded.dictionary), d + 1)
    idx = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if pa.types.is_integer(coord.type.value_type):
        sums.add_integers(idx, kernels.matrix(coord, d, np.int64).T)
    else:
        sums.add_columns(idx, np.ascontiguousarray(kernels.matrix(coord, d).T))
    sums.add(np.bincount(idx, minlength=len(coded.dictionary)).astype(np.float64)[:, None], d)
    group, column, limb, value = sums.rows()
    return pa.table({"key": coded.dictionary.take(pa.array(group)), "col": pa.array(column.astype(np.int32)), "limb": pa.array(limb.astype(np.int32)), "v": pa.array(value)})


def whole_sums(column: np.ndarray, limb: np.ndarray, value: np.ndarray, d: int, integers: bool) -> tuple[int, list]:
    """The count and the sums that one key's merged limbs stand for."""
    zero = np.zeros(len(value), np.int64)
    n = int(to_doubles((1, d + 1), zero, column, limb, value)[0, d])
    if not integers:
        return n, to_doubles((1, d + 1), zero, column, limb, value)[0, :d].tolist()
    total = [0] * (d + 1)
    for c, at, v in zip(column.tolist(), limb.tolist(), value.tolist(), strict=True):
        total[c] += v << 32 * at
    return n, total[:d]


def cluster_sums(assigned: DataFrame, d: int | None = None) -> DataFrame:
    """A3: ``(cluster_id, n, sums ARRAY)`` — vector sum and count per cluster.

    Sums are exact, so they don't depend on the order of the rows: BIGINT for
    integer features, otherwise doubles rounded once.  Each batch is summed in a
    kernel and only its sums cross the shuffle, at any width; a vector of another
    length, or with a null, fails the job, and so does a BIGINT that overflows."""
    d = d or _dim(assigned)
    spark = assigned.sparkSession
    ship_package(spark)
    key = assigned.schema["cluster_id"].dataType.simpleString()
    integers = assigned.schema["coord"].dataType.elementType.simpleString() in WHOLE
    kind = "BIGINT" if integers else "DOUBLE"

    def part(batches):
        for b in batches:
            yield from partial_sums(b.column(0), b.column(1), d).rename_columns(["cluster_id", "col", "limb", "v"]).to_batches()

    def whole(key: tuple, group: pa.Table) -> pa.Table:
        column, limb, value = (group.column(c).to_numpy().astype(np.int64) for c in ("col", "limb", "v"))
        n, sums = whole_sums(column, limb, value, d, integers)
        return pa.table({"cluster_id": pa.array([key[0].as_py()], group.schema.field("cluster_id").type), "n": pa.array([n], pa.int64()),
                         "sums": pa.array([sums], pa.list_(pa.int64() if integers else pa.float64()))})

    coord = checked("coord", d) if integers else F.transform(checked("coord", d), lambda x: x.cast("double"))
    rows = assigned.select("cluster_id", coord.cast(f"array<{kind}>").alias("coord"))
    limbs = merge_limbs(rows.mapInArrow(part, f"cluster_id {key}, col INT, limb INT, v BIGINT"))
    return limbs.groupBy("cluster_id").applyInArrow(whole, f"cluster_id {key}, n BIGINT, sums ARRAY<{kind}>")


def update_centroids(assigned: DataFrame, old, empty: str = "keep") -> DataFrame:
    """A4: new centroid = mean of its members, ``(cluster_id, n, coord)``.

    ``empty='keep'`` keeps an empty cluster's previous centroid with n = 0
    (k rows always); ``'drop'`` removes it.  ``old`` is size-checked before
    it is broadcast.
    """
    if empty not in ("keep", "drop"):
        raise ValueError("empty must be 'keep' or 'drop'")
    spark = assigned.sparkSession
    model = collect_model(old, spark)
    sums = cluster_sums(assigned, model.d)
    means = sums.select("cluster_id", "n", F.transform("sums", lambda s: s.cast("double") / F.col("n")).alias("mean"))
    if empty == "drop":
        return means.select(F.col("cluster_id").cast("int"), "n", F.col("mean").alias("coord"))
    prev = F.broadcast(model.to_df(spark))
    joined = prev.join(means, "cluster_id", "left")
    return joined.select(F.col("cluster_id").cast("int"),
                         F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                         F.coalesce("mean", "coord").alias("coord"))


def cluster_counts(assigned: DataFrame) -> DataFrame:
    """A5: members per cluster."""
    return assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


def gather_model(centroids: DataFrame) -> DataFrame:
    """The centroid table as one row holding an array sorted by id
    (bounded by the model size check)."""
    check_model(centroids)
    return centroids.agg(F.array_sort(F.collect_list(F.struct(
        F.col("cluster_id").cast("int").alias("cluster_id"), "coord"))).alias("centroids"))
