"""A data set is four files sharing a base name (S3) and a folder of them (S4):

    <name>.txt      points
    <name>-pa.txt   true partition (one label per point, same order)
    <name>-c.txt    true centroids (k rows)
    <name>-ic.txt   start centroids (k rows)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centrix.sources.fs import list_names, path_exists
from centrix.sources.text import load_labels, load_points


# The file names of one data set's roles, as the published
# data sets use them (points, true partition, true centroids, start centroids).
SUFFIX_POINTS = ".txt"
SUFFIX_PARTITION = "-pa.txt"
SUFFIX_TRUE_CENTROIDS = "-c.txt"
SUFFIX_START_CENTROIDS = "-ic.txt"


@dataclass
class Dataset:
    name: str
    points: DataFrame
    partition: DataFrame | None
    true_centroids: DataFrame | None
    start_centroids: DataFrame | None


def load_dataset(spark: SparkSession, root: str, name: str) -> Dataset:
    base = f"{root.rstrip('/')}/{name}"
    points = load_points(spark, base + SUFFIX_POINTS)
    part_path = base + SUFFIX_PARTITION
    part = load_labels(spark, part_path) if path_exists(spark, part_path) else None
    true_c = None
    if path_exists(spark, base + SUFFIX_TRUE_CENTROIDS):
        true_c = load_points(spark, base + SUFFIX_TRUE_CENTROIDS, id_col="cluster_id") \
            .select(F.col("cluster_id").cast("int"), "coord")
    start_c = None
    if path_exists(spark, base + SUFFIX_START_CENTROIDS):
        start_c = load_points(spark, base + SUFFIX_START_CENTROIDS, dtype="double", id_col="cluster_id") \
            .select(F.col("cluster_id").cast("int"), "coord")
    return Dataset(name, points, part, true_c, start_c)


def list_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Base names of the point files (or folders of part files) in ``root``,
    names without '-', as ``(dataset)``.  Names only: contents are not read."""
    names = {n.split(".", 1)[0] for n in list_names(spark, root) if n.endswith(SUFFIX_POINTS) and "-" not in n}
    return spark.createDataFrame([(n,) for n in sorted(names)], "dataset STRING")
