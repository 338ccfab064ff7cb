"""Numeric helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trunc_to_long(x) -> Column:
    """Truncate toward zero (what ``%d`` and ``astype(int)`` do)."""
    return _c(x).cast("bigint")


def millis(seconds) -> Column:
    """Seconds -> milliseconds, 3 decimals."""
    return F.round(_c(seconds) * 1000.0, 3)


def round_to(x, places: int) -> Column:
    return F.round(_c(x), places)


# Fixed value: seeding trials per centre = 2 + floor(ln k), the published
# greedy k-means++ default.
TRIALS_BASE = 2


def n_local_trials(k: int) -> int:
    """Seeding trials per centre: 2 + floor(ln k)."""
    return TRIALS_BASE + int(math.log(k))


def per_cluster_rows(target_n: int, n: int, k: int) -> int:
    """New rows per cluster when enlarging n rows to target_n: (target-n) // k."""
    return (int(target_n) - int(n)) // int(k)
