"""The centroid model: k rows of (cluster_id, coord), held on the driver.

This is the only data that moves through the driver during training (k x d
numbers).  Its size is checked before it is collected and before it is
shipped to tasks; see MAX_MODEL_BYTES.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound on k * d * 8 bytes for a model that is collected to the driver
# and broadcast to every task.  Override with the session setting
# ``centrix.maxModelBytes``.
MAX_MODEL_BYTES = 256 << 20


def max_model_bytes(spark: SparkSession | None) -> int:
    if spark is None:
        return MAX_MODEL_BYTES
    return int(spark.conf.get("centrix.maxModelBytes", str(MAX_MODEL_BYTES)))


class ModelTooLarge(ValueError):
    pass


@dataclass
class Model:
    ids: np.ndarray   # int32, ascending
    C: np.ndarray     # (k, d) float64

    @property
    def k(self) -> int:
        return int(self.ids.shape[0])

    @property
    def d(self) -> int:
        return int(self.C.shape[1])

    @property
    def nbytes(self) -> int:
        return int(self.C.size * 8)

    @staticmethod
    def from_rows(rows) -> "Model":
        rows = sorted(((int(cid), [float(v) for v in c]) for cid, c in rows), key=lambda r: r[0])
        if not rows:
            raise ValueError("no centroids")
        d = len(rows[0][1])
        if any(len(c) != d for _, c in rows):
            raise ValueError("centroids have different lengths")
        ids = np.array([r[0] for r in rows], dtype=np.int32)
        if len(set(ids.tolist())) != len(ids):
            raise ValueError("duplicate cluster_id")
        return Model(ids, np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), d))

    def rows(self) -> list[tuple[int, list[float]]]:
        return [(int(i), [float(v) for v in c]) for i, c in zip(self.ids, self.C)]

    def to_df(self, spark: SparkSession, n=None) -> DataFrame:
        if n is None:
            return spark.createDataFrame(self.rows(), "cluster_id INT, coord ARRAY<DOUBLE>")
        return spark.createDataFrame([(i, int(m), c) for (i, c), m in zip(self.rows(), n)],
                                     "cluster_id INT, n BIGINT, coord ARRAY<DOUBLE>")

    def check(self, spark: SparkSession | None) -> "Model":
        if self.nbytes > max_model_bytes(spark):
            raise ModelTooLarge(f"model of {self.nbytes} bytes exceeds centrix.maxModelBytes")
        return self


def collect_model(centroids, spark: SparkSession | None = None) -> Model:
    """Model from a DataFrame ``(cluster_id, coord)``, a list of rows, or a Model.

    A DataFrame is collected only after a bounded ``limit`` shows it fits the
    size bound, so an oversized centroid table never lands on the driver.
    """
    if isinstance(centroids, Model):
        return centroids.check(spark)
    if isinstance(centroids, DataFrame):
        spark = spark or centroids.sparkSession
        first = centroids.select(F.size("coord").alias("d")).first()
        if first is None:
            raise ValueError("no centroids")
        d = max(1, int(first["d"]))
        max_rows = max(1, max_model_bytes(spark) // (8 * d))
        rows = (centroids.select(F.col("cluster_id").cast("int"), F.col("coord").cast("array<double>"))
                .limit(max_rows + 1).collect())
        if len(rows) > max_rows:
            raise ModelTooLarge("centroid table exceeds centrix.maxModelBytes; use assign_blocked")
        return Model.from_rows((r[0], r[1]) for r in rows)
    return Model.from_rows(centroids).check(spark)


def check_model(centroids: DataFrame) -> None:
    """Raises unless a centroid table is within the size bound; counts at most
    as many rows as the bound allows, and collects none of them."""
    sizes = centroids.select(F.size("coord").alias("d"))
    first = sizes.first()
    if first is None:
        raise ValueError("no centroids")
    most = max(1, max_model_bytes(centroids.sparkSession) // (8 * max(1, int(first["d"]))))
    if sizes.limit(most + 1).count() > most:
        raise ModelTooLarge("centroid table exceeds centrix.maxModelBytes")


def model_value(spark: SparkSession, model: Model) -> Column:
    """The model as one value, ``ARRAY<STRUCT<cluster_id, coord>>`` sorted by
    cluster_id: a scalar subquery over a table of one row, which Spark
    evaluates once and ships with the tasks."""
    kind = "model ARRAY<STRUCT<cluster_id: INT, coord: ARRAY<DOUBLE>>>"
    return spark.createDataFrame([(model.rows(),)], kind).scalar()
