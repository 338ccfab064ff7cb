"""Point sets derived from the driver's tables (FIXTURES part B).

points64  embeddings: coord = round(e * 1000) as BIGINT, d = 64; truth label+1
points2   events:     coord = [user_id, round(value * 100)], d = 2; truth = rank
          of event_type
start64   lowest vec_id of each label, cluster_id = label + 1
start2    the five lowest event_id, cluster_id = 1..5 in id order
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _quantise(col: str) -> F.Column:
    return F.transform(col, lambda x: F.round(x.cast("double") * 1000.0).cast("bigint"))


def points64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), _quantise("embedding").alias("coord"))


def partition64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), (F.col("label") + 1).cast("int").alias("label"))


def start64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First point (lowest id) of each true class, as a start centroid."""
    emb = table(spark, sf_dir, "embeddings")
    first = emb.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return first.select((F.col("label") + 1).cast("int").alias("cluster_id"),
                        F.transform(_quantise("embedding"), lambda x: x.cast("double")).alias("coord"))


def points2(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("point_id"),
                     F.array(F.col("user_id"), F.round(F.col("value") * 100.0).cast("bigint")).alias("coord"))


def partition2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label = 1-based rank of event_type.  The rank table has one row per
    distinct type; Spark broadcasts it where its size threshold allows."""
    ev = table(spark, sf_dir, "events")
    types = ev.select("event_type").distinct()
    ranks = types.withColumn("label", F.row_number().over(Window.orderBy("event_type")).cast("int"))
    return ev.select("event_id", "event_type").join(ranks, "event_type") \
        .select(F.col("event_id").alias("point_id"), "label")


def start2(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """The k lowest event ids (a top-k pick) as start centroids."""
    first = points2(spark, sf_dir).orderBy("point_id").limit(k)
    return first.select(F.row_number().over(Window.orderBy("point_id")).cast("int").alias("cluster_id"),
                        F.transform("coord", lambda x: x.cast("double")).alias("coord"))
