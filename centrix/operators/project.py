"""Projections and filters on point / assignment tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_length(points: DataFrame) -> DataFrame:
    """Number of features of one row (the reference reads one row)."""
    return points.select(F.size("coord").alias("d")).limit(1)


def feature(points: DataFrame, j: int, name: str | None = None) -> DataFrame:
    """One feature (0-based ``j``) next to the id."""
    return points.select("point_id", F.element_at("coord", j + 1).alias(name or f"x_{j}"))


def prefix(points: DataFrame, m: int) -> DataFrame:
    """The first ``m`` features as an array."""
    return points.select("point_id", F.slice("coord", 1, m).alias("coord"))


def members(assigned: DataFrame, cluster_id: int) -> DataFrame:
    """The rows assigned to one cluster (filter pushed to the scan when
    the assignment is stored)."""
    return assigned.filter(F.col("cluster_id") == cluster_id)


def spread(df: DataFrame, d: int, array_col: str = "coord", id_col: str = "point_id",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """``x_0 .. x_{d-1}`` columns beside the id, the array dropped."""
    return df.select(id_col, *keep, *[F.col(array_col)[j].alias(f"x_{j}") for j in range(d)])


def flatten_assignment(assigned: DataFrame, d: int) -> DataFrame:
    """P10: ``(x_0 .. x_{d-1}, cluster_id)`` — coordinates, then the label."""
    return assigned.select(*[F.col("coord")[j].alias(f"x_{j}") for j in range(d)], "cluster_id")
