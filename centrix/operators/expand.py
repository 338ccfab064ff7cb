"""Enlarging a data set and row order.

``expand`` adds ``(target_n - n) // k`` synthetic points per true centroid,
each feature drawn from normal(centre, 1) and truncated toward zero, labelled
with the centroid's ``cluster_id``; they are appended after the originals
(new ids continue after the largest existing id, cluster by cluster).
Draws are counter-based (Box-Muller on hashed uniforms keyed by seed,
feature and new-row number), so any task re-run gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from centrix.functions.hashrand import hash_uniform_sql, normal_sql, stream, stream_sql
from centrix.functions.numeric import per_cluster_rows
from centrix.operators.model import collect_model


def gaussian_coord_sql(seed: int, id_sql: str, centre_sql: str, d: int, dialect: str = "spark") -> str:
    """SQL for ``[trunc(centre[j] + N(0,1)) for j < d]`` keyed by (seed, j, id)."""
    u1 = hash_uniform_sql(stream_sql(stream(seed, 1), "j", dialect), id_sql, dialect)
    u2 = hash_uniform_sql(stream_sql(stream(seed, 2), "j", dialect), id_sql, dialect)
    z = normal_sql(u1, u2, dialect)
    if dialect == "spark":
        return f"transform(sequence(0, {d - 1}), j -> CAST({centre_sql}[j] + {z} AS BIGINT))"
    return (f"list_transform(range(0, {d}), lambda j: "
            f"CAST(trunc({centre_sql}[j + 1] + {z}) AS BIGINT))")


def _new_rows_arrow(spark, model, m: int, mx: int, seed: int) -> DataFrame:
    """The synthetic rows from a partition kernel over ``spark.range``: the
    same counter-based uniforms and Box-Muller formula as the SQL form."""
    import numpy as np
    import pyarrow as pa

    from centrix.functions.hashrand import np_hash_uniform
    from centrix.session import ship_package
    ship_package(spark)
    d = model.d
    streams = [(stream(stream(seed, 1), j), stream(stream(seed, 2), j)) for j in range(d)]
    bc = spark.sparkContext.broadcast((model.ids, model.C, streams))

    def fn(batches):
        cluster, C, st = bc.value
        for b in batches:
            ids = b.column(0).to_numpy()
            lab = ids // m
            out = np.empty((ids.shape[0], d), dtype=np.int64)
            for j, (s1, s2) in enumerate(st):
                u1, u2 = np_hash_uniform(s1, ids), np_hash_uniform(s2, ids)
                z = np.sqrt(-2.0 * np.log(u1)) * np.cos(2.0 * np.pi * u2)
                out[:, j] = np.trunc(C[lab, j] + z).astype(np.int64)
            coord = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), d).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids + mx + 1), coord, pa.array(cluster[lab].astype(np.int32))],
                names=["point_id", "coord", "label"])

    return spark.range(model.k * m).mapInArrow(fn, "point_id BIGINT, coord ARRAY<BIGINT>, label INT")


def expand(points: DataFrame, partition: DataFrame, true_centroids: DataFrame,
           target_n: int, seed: int = 0, method: str = "arrow") -> tuple[DataFrame, DataFrame]:
    """T7 + U1: ``(points, partition)`` with the synthetic rows appended.

    ``method='sql'`` draws with SQL expressions, ``'arrow'`` (default) with a
    NumPy kernel per partition of ``spark.range``; both use the same formula."""
    spark = points.sparkSession
    model = collect_model(true_centroids, spark)        # k x d, size-checked
    stats = points.agg(F.count(F.lit(1)).alias("n"), F.max("point_id").alias("mx")).first()
    n, mx = int(stats["n"]), int(stats["mx"] if stats["mx"] is not None else 0)
    m = per_cluster_rows(target_n, n, model.k)
    if m <= 0:
        return points, partition
    if method == "arrow":
        new = _new_rows_arrow(spark, model, m, mx, seed)
        coord_type = points.schema["coord"].dataType
        out_pts = points.select("point_id", "coord").unionByName(
            new.select("point_id", F.col("coord").cast(coord_type).alias("coord")))
        out_part = partition.select("point_id", F.col("label").cast("int")).unionByName(
            new.select("point_id", "label"))
        return out_pts, out_part
    cents = spark.createDataFrame([(i, cluster, c) for i, (cluster, c) in enumerate(model.rows())],
                                  "place INT, label INT, centre ARRAY<DOUBLE>")
    new = (spark.range(model.k * m)
           .select((F.col("id") + F.lit(mx + 1)).alias("point_id"), "id",
                   F.expr(f"CAST(id DIV {m} AS INT)").alias("place"))
           .join(F.broadcast(cents), "place")
           .select("point_id", F.expr(gaussian_coord_sql(seed, "id", "centre", model.d)).alias("coord"), "label"))
    coord_type = points.schema["coord"].dataType
    out_pts = points.select("point_id", "coord").unionByName(
        new.select("point_id", F.col("coord").cast(coord_type).alias("coord")))
    out_part = partition.select("point_id", F.col("label").cast("int")).unionByName(
        new.select("point_id", "label"))
    return out_pts, out_part


def append_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return a.unionByName(b)


def shuffle_key(seed: int) -> F.Column:
    return F.expr(hash_uniform_sql(str(stream(seed, 3)), "point_id"))


def shuffle_rows(df: DataFrame, seed: int = 0) -> DataFrame:
    """Rows in a seeded random order (a range-partitioned sort on a
    hashed key; ties broken by id)."""
    return df.withColumn("shuffle_key", shuffle_key(seed)).orderBy("shuffle_key", "point_id")


def shuffled_places(df: DataFrame, seed: int = 0, buckets: int | None = None) -> DataFrame:
    """T3 with every row's place (from 1) in the order of :func:`shuffle_rows`,
    without a sort of all rows.

    The hashed key is uniform, so equal slices of its range are buckets of about
    equal size: rows are scattered by bucket, ranked inside, and moved up by the
    counts of the buckets before (one row a bucket)."""
    buckets = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.floor(shuffle_key(seed) * buckets).cast("int")
    sizes = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_bucket").orderBy("shuffle_key", "point_id")
    ranked = df.withColumns({"_bucket": bucket, "shuffle_key": shuffle_key(seed)}).withColumn("_in", F.row_number().over(inside))
    return ranked.join(F.broadcast(sizes), "_bucket").withColumn("place", F.col("_off") + F.col("_in")).drop("_bucket", "_off", "_in")


def true_centroids_from_labels(points: DataFrame, partition: DataFrame) -> DataFrame:
    """Integer true centroids from known labels: per label, the mean of each
    feature truncated toward zero (the shape of a ``-c.txt`` file),
    ``cluster_id = label``."""
    from centrix.operators.update import cluster_sums
    j = points.join(partition, "point_id").select(F.col("label").alias("cluster_id"), "coord")
    sums = cluster_sums(j)
    return sums.select(F.col("cluster_id").cast("int"),
                       F.transform("sums", lambda s: (s.cast("double") / F.col("n")).cast("bigint")).alias("coord"))
