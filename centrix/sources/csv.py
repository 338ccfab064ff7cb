"""Run-history CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TIME_SCHEMA = "dataset STRING, time DOUBLE"
LOCAL_SCHEMA = ("dataset STRING, n_samples BIGINT, n_features INT, n_clusters INT, "
                "`training_time (ms)` DOUBLE, `NMI score` DOUBLE")


def read_history(spark: SparkSession, path: str, schema: str = TIME_SCHEMA) -> DataFrame:
    """Read a history CSV with a header and an explicit schema (no inference)."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def write_history(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a history table as CSV with a header and no index column."""
    df.write.mode(mode).csv(path, header=True)
