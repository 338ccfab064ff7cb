"""Clustering cost (A6): sum of squared distances to the assigned centroid.

Costs are summed as DECIMAL(38, 6) of each distance, so the total does not
depend on the order rows arrive in (exact across partitionings and engines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COST_TYPE = "decimal(38,6)"


def cluster_cost(assigned: DataFrame) -> DataFrame:
    """``(cluster_id, n, cost)`` per cluster."""
    return assigned.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("dist").cast(COST_TYPE)).alias("cost"))


def total_cost(assigned: DataFrame) -> DataFrame:
    """One row: ``(cost)`` over all points."""
    return assigned.agg(F.sum(F.col("dist").cast(COST_TYPE)).alias("cost"))
