"""Score a stream of points against fixed centroids.

The SQL form of the assignment is a per-row expression with the model as a
literal, so it runs unchanged on a streaming DataFrame (no state, no
watermark needed) and every micro-batch is scored map-only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from centrix.operators.assign import assign


def score_stream(stream: DataFrame, centroids) -> DataFrame:
    """``(point_id, cluster_id, dist)`` for each arriving point."""
    return assign(stream, centroids, method="sql")
