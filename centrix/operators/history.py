"""Run history tables.

Long form ``(dataset, system, time_ms)`` is the storage shape; the wide,
one-column-per-system table is a pivot of it, joined to the data-set
catalogue **by name** (never pasted by row position).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = "dataset STRING, time DOUBLE"


def to_long(times: DataFrame, system: str, value: str = "time") -> DataFrame:
    """``(dataset, time)`` of one system -> ``(dataset, system, time_ms)``."""
    return times.select("dataset", F.lit(system).alias("system"), F.col(value).cast("double").alias("time_ms"))


def combine_times(catalogue: DataFrame, per_system: dict[str, DataFrame]) -> DataFrame:
    """Catalogue + one time column per system, matched on ``dataset``.

    A run missing for a system is NULL.  The system list is passed to
    ``pivot`` explicitly, so no extra pass discovers the values.
    """
    systems = list(per_system)
    long = None
    for name, df in per_system.items():
        part = to_long(df, name)
        long = part if long is None else long.unionByName(part)
    wide = long.groupBy("dataset").pivot("system", systems).agg(F.first("time_ms"))
    return catalogue.join(wide, "dataset", "left").select(catalogue.columns + systems)


def pending(todo: DataFrame, history: DataFrame) -> DataFrame:
    """Data sets not yet recorded (left anti join on ``dataset``)."""
    return todo.join(history.select("dataset"), "dataset", "left_anti")


def append_record(history: DataFrame, record: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return history.unionByName(record)


def make_record(spark: SparkSession, dataset: str, time_ms: float) -> DataFrame:
    return spark.createDataFrame([(dataset, float(time_ms))], RECORD_SCHEMA)


def side_by_side(left: DataFrame, right: DataFrame, key: str = "point_id") -> DataFrame:
    """Two frames next to each other, aligned by id (not by position)."""
    return left.join(right, key)
