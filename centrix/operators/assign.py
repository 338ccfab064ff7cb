"""Nearest-centroid assignment and the pair operators.

Two physical forms of the same contract, ``(point_id, cluster_id, dist)``,
lowest cluster_id on a tie, squared distance:

* ``method="sql"``: every row sees the model as one array, a scalar subquery
  (J2; no join, no shuffle of points, no numbers in the plan), and the argmin
  is ``array_min(transform(model, c -> struct(dist, cluster_id)))``.
* ``method="arrow"``: a NumPy kernel per partition (``mapInArrow``) with
  the model in a broadcast variable, searched as a tree of boxes.  Same bits, far
  less per-row overhead for wide vectors or many centroids.

Both are map-only.  A centroid table that is too large to ship whole is a tree
whose leaves are rows of a table: points go to the leaves that can hold their
nearest centroid (:func:`assign_blocked`).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from centrix.functions.vector import checked
from centrix.operators import kernels
from centrix.operators.model import Model, ModelTooLarge, check_model, collect_model, max_model_bytes, model_value
from centrix.session import scratch_path, ship_package

SQ_DIST_LAMBDA = ("aggregate(zip_with(coord, c.coord, (x, y) -> (CAST(x AS DOUBLE) - y) * "
                  "(CAST(x AS DOUBLE) - y)), 0D, (acc, t) -> acc + t)")


def attach_model(points: DataFrame, centroids, name: str = "centroids") -> DataFrame:
    """Every point row gets the whole (size-checked) model as one value."""
    model = collect_model(centroids, points.sparkSession)
    return points.withColumns({"coord": checked("coord", model.d), name: model_value(points.sparkSession, model)})


def _best(model: Column) -> Column:
    return F.array_min(F.transform(model, lambda c: F.struct(
        F.aggregate(F.zip_with("coord", c["coord"], lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)),
                    F.lit(0.0), lambda acc, t: acc + t).alias("dist"), c["cluster_id"].alias("cluster_id"))))


def assign(points: DataFrame, centroids, method: str = "arrow", keep_coord: bool = False) -> DataFrame:
    """A1: ``(point_id, cluster_id, dist[, coord])`` for every point.

    A point with a null, or with another number of features than the model,
    fails the job, in both forms.  ``method='sql'`` is for streams and SQL
    plans; the kernel does the same arithmetic with far less work a row.  A
    centroid table past the size bound is searched leaf by leaf, by the kernel."""
    if method not in ("sql", "arrow"):
        raise ValueError("method must be 'sql' or 'arrow'")
    spark = points.sparkSession
    try:
        model = collect_model(centroids, spark)
    except ModelTooLarge:
        if not isinstance(centroids, DataFrame):
            raise
        return assign_blocked(points, centroids, keep_coord=keep_coord)
    if method == "arrow":
        return _assign_arrow(points, model, keep_coord)
    best = attach_model(points.select("point_id", "coord"), model, "_cs").select("point_id", "coord", _best(F.col("_cs")).alias("_b"))
    return best.select("point_id", F.col("_b.cluster_id").cast("int").alias("cluster_id"),
                       F.col("_b.dist").alias("dist"), *(["coord"] if keep_coord else []))


def _assign_arrow(points: DataFrame, model: Model, keep_coord: bool) -> DataFrame:
    spark = points.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast((model.ids, model.C))
    d = model.d
    coord_type = points.schema["coord"].dataType.simpleString()

    def fn(batches):
        ids, C = bc.value
        tree = kernels.Tree(C)
        for b in batches:
            X = kernels.coords(b, d)
            idx, dist = kernels.nearest(X, tree)
            cols = [b.column(b.schema.get_field_index("point_id")), pa.array(ids[idx]), pa.array(dist)]
            names = ["point_id", "cluster_id", "dist"]
            if keep_coord:
                cols.append(b.column(b.schema.get_field_index("coord")))
                names.append("coord")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "point_id BIGINT, cluster_id INT, dist DOUBLE" + (f", coord {coord_type}" if keep_coord else "")
    return points.select("point_id", "coord").mapInArrow(fn, schema)


# Pivots around which the leaves of a large centroid table are formed, at most.
MAX_PIVOTS = 4096
# A task always has room for so much of a centroid table.
LEAST_BYTES = 1 << 20
# Points packed into one block on their way to a leaf.
ROUTE_ROWS = 1 << 14


def _leaves(spark: SparkSession, centroids: DataFrame, d: int, leaf_rows: int | None) -> tuple[DataFrame, list]:
    """The centroid table as leaf rows ``(leaf, cids, cents)`` of about
    ``leaf_rows`` centroids, written to the shared folder, and the leaves' boxes.

    Centroids gather around pivots (a hash sample of them); a pivot's centroids
    are cut by a hash into as many leaves as they fill.  Which pivots were drawn
    decides how much is searched, never what is found."""
    own = centroids.select(F.col("cluster_id").cast("int").alias("cluster_id"), checked("coord", d).cast("array<double>").alias("coord"))
    k = own.count()
    if not k:
        raise ValueError("no centroids")
    most = max(max_model_bytes(spark), LEAST_BYTES)
    # a leaf takes a small part of what a task may hold, and so do all boxes together
    leaf_rows = leaf_rows or max(1, most // (8 * d * 64), -(-4 * k * 16 * d // most))
    wanted = min(MAX_PIVOTS, most // (16 * d) or 1, -(-k // leaf_rows))
    rank = F.xxhash64("cluster_id")
    pivots = own.orderBy(rank, "cluster_id").limit(int(wanted)).collect()
    model = Model.from_rows((r[0], r[1]) for r in pivots)
    near = _assign_arrow(own.select(F.col("cluster_id").cast("long").alias("point_id"), "coord"), model, keep_coord=True)
    size = near.groupBy("cluster_id").agg(F.ceil(F.count("*") / leaf_rows).cast("int").alias("_cuts"))
    part = F.pmod(F.xxhash64("point_id", F.lit("leaf")), F.col("_cuts")).cast("int")
    dealt = near.join(F.broadcast(size), "cluster_id").select(F.struct("cluster_id", part.alias("part")).alias("key"), "point_id", "coord")
    ship_package(spark)

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("point_id").to_numpy())
        ids, C = group.column("point_id").to_numpy()[order].astype(np.int32), kernels.matrix(group.column("coord").combine_chunks(), d)[order]
        low, high = (pa.array([v.tolist()], pa.list_(pa.float64())) for v in (C.min(axis=0), C.max(axis=0)))
        return pa.table({"cids": pa.array([ids.tobytes()], pa.binary()), "cents": pa.array([C.tobytes()], pa.binary()), "low": low, "high": high})

    path = scratch_path(spark, "centroid-leaves")
    rows = dealt.groupBy("key").applyInArrow(pack, "cids BINARY, cents BINARY, low ARRAY<DOUBLE>, high ARRAY<DOUBLE>")
    rows.withColumn("leaf", F.monotonically_increasing_id()).write.parquet(path)
    made = spark.read.parquet(path)
    boxes = made.select("leaf", "low", "high").orderBy("leaf").limit(most // (16 * d) + 1).collect()
    if len(boxes) * 16 * d > most:
        raise ModelTooLarge("the boxes of the centroid table exceed centrix.maxModelBytes")
    return made.select("leaf", "cids", "cents"), boxes


def assign_blocked(points: DataFrame, centroids: DataFrame, block_rows: int | None = None,
                   keep_coord: bool = False) -> DataFrame:
    """A1 for a centroid table too large to ship whole: an exact search tree
    whose leaves (of about ``block_rows`` centroids) are rows of a table.

    Only the leaves' boxes are shipped.  Each point first goes to the leaf whose
    box is nearest; with the distance found there, it goes to every other
    leaf whose box isn't farther (a point's distance to a box is never above its
    computed distance to a centroid inside, see ``kernels.Tree``).  Points
    travel in packed blocks; a leaf many points go to is one large key of
    an equi join, which Spark splits.  Two joins and one aggregate, whatever the
    number of leaves; no task holds more than a leaf and a block.
    """
    spark = points.sparkSession
    d = int(centroids.select(F.size("coord")).first()[0])
    leaves, boxes = _leaves(spark, centroids, d, block_rows)
    ship_package(spark)
    bc = spark.sparkContext.broadcast(([r["leaf"] for r in boxes], np.array([r["low"] for r in boxes]), np.array([r["high"] for r in boxes])))

    # a number for every row, fixed by writing it down
    path = scratch_path(spark, "routed-points")
    points.select(F.monotonically_increasing_id().alias("row"), "point_id", "coord").write.parquet(path)
    rows = spark.read.parquet(path)

    def packed(leaf: int, row: np.ndarray, X: np.ndarray, best: np.ndarray) -> Iterator[tuple]:
        for at in range(0, len(row), ROUTE_ROWS):
            part = slice(at, at + ROUTE_ROWS)
            yield leaf, row[part].tobytes(), np.ascontiguousarray(X[part]).tobytes(), best[part].tobytes()

    def blocks(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], kind) for j, kind in enumerate((pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                                          names=["leaf", "rows", "x", "best"])

    block_schema = "leaf BIGINT, rows BINARY, x BINARY, best BINARY"

    def route(first: bool):
        def fn(batches):
            leaf_ids, low, high = bc.value
            tree = kernels.Boxes(low, high)
            for b in batches:
                row, X = b.column(0).to_numpy(), kernels.coords(b, d)
                best = np.full(len(row), np.inf) if first else b.column(2).to_numpy()
                for at in range(0, len(row), ROUTE_ROWS):
                    part = slice(at, at + ROUTE_ROWS)
                    bound = tree.box_dists(kernels.columns_of(X[part]))
                    nearest = bound.argmin(axis=1)
                    found = []
                    for j, leaf in enumerate(leaf_ids):
                        go = np.flatnonzero(nearest == j if first else (bound[:, j] <= best[part]) & (nearest != j))
                        if len(go):
                            found += packed(leaf, row[part][go], X[part][go], best[part][go])
                    if found:
                        yield blocks(found)

        return fn

    def search(batches):
        for b in batches:
            for rows_, x, cids, cents in zip(*(b.column(c) for c in ("rows", "x", "cids", "cents")), strict=True):
                ids = np.frombuffer(cids.as_buffer(), np.int32)
                tree = kernels.Tree(np.frombuffer(cents.as_buffer(), np.float64).reshape(-1, d))
                idx, dist = kernels.nearest(np.frombuffer(x.as_buffer(), np.float64).reshape(-1, d), tree)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(rows_.as_buffer(), np.int64)), pa.array(dist), pa.array(ids[idx])], names=["row", "dist", "cluster_id"])

    found_schema = "row BIGINT, dist DOUBLE, cluster_id INT"

    def visit(sent: DataFrame) -> DataFrame:
        return sent.join(leaves, "leaf").select("rows", "x", "cids", "cents").mapInArrow(search, found_schema)

    best = F.min(F.struct("dist", "cluster_id")).alias("b")
    path = scratch_path(spark, "first-leaf")
    visit(rows.select("row", "coord").mapInArrow(route(True), block_schema)).write.parquet(path)
    first = spark.read.schema(found_schema).parquet(path)
    again = rows.select("row", "coord").join(first.select("row", "dist"), "row").select("row", "coord", "dist")
    every = first.unionByName(visit(again.mapInArrow(route(False), block_schema)))
    out = rows.join(every.groupBy("row").agg(best), "row")
    return out.select("point_id", F.col("b.cluster_id").alias("cluster_id"), F.col("b.dist").alias("dist"), *(["coord"] if keep_coord else []))


def all_pairs(points: DataFrame, centroids) -> DataFrame:
    """``(point_id, cluster_id)`` for every point and centroid.

    n x k rows with k bounded by the model size check; the ids of the attached
    model are exploded, so there is no join operator and no shuffle.
    """
    spark = points.sparkSession
    with_model = points.select("point_id", model_value(spark, collect_model(centroids, spark)).alias("_cs"))
    return with_model.select("point_id", F.explode("_cs.cluster_id").alias("cluster_id"))


def pair_distances(points: DataFrame, centroids) -> DataFrame:
    """``(point_id, cluster_id, dist)`` for all n x k pairs (map-only)."""
    with_model = attach_model(points.select("point_id", "coord"), centroids, "_cs")
    pairs = with_model.select("point_id", "coord", F.inline("_cs").alias("cluster_id", "_cc"))
    return pairs.select("point_id", F.col("cluster_id").cast("int"),
                        F.expr(SQ_DIST_LAMBDA.replace("c.coord", "_cc")).alias("dist"))


def co_partitioned(df: DataFrame, key: str = "point_id", buckets: int | None = None) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key`` in the shared folder.

    Joins and aggregates by ``key`` over such tables, and over what is selected or
    exploded from them, shuffle nothing: the shuffle is paid once, here.  The
    table's name is new; drop it when it isn't needed any more."""
    spark = df.sparkSession
    name = f"centrix_by_{key}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortBy(key)
    writer.option("path", scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def pair_distances_joined(pairs: DataFrame, points: DataFrame, centroids: DataFrame) -> DataFrame:
    """Pair table -> point -> centroid, three-way equi join with distance.

    The pair table and the points join on ``point_id`` (both grow with n: a shuffle
    join, or none where both are :func:`co_partitioned`); the centroids join on
    ``cluster_id`` and are broadcast only after the model size check.
    """
    check_model(centroids)
    cen = F.broadcast(centroids.select(F.col("cluster_id").cast("int"), F.col("coord").alias("_cc")))
    joined = pairs.join(points.select("point_id", "coord"), "point_id").join(cen, "cluster_id")
    return joined.select("point_id", "cluster_id", F.expr(SQ_DIST_LAMBDA.replace("c.coord", "_cc")).alias("dist"))


def min_dist(points: DataFrame, centroids) -> DataFrame:
    """A2: ``(point_id, dist)`` to the nearest centroid: one map-only pass, no
    pair table."""
    return assign(points, centroids).select("point_id", "dist")


def min_pair_dist(pair_dists: DataFrame) -> DataFrame:
    """A2 over a pair table that is there already (partial + final aggregate)."""
    return pair_dists.groupBy("point_id").agg(F.min("dist").alias("dist"))


def nearest_all_ties(points: DataFrame, centroids) -> DataFrame:
    """Every centroid at the minimum distance (ties kept), map-only.

    The reference joins the distance table back to its per-point minimum;
    here each row computes its k distances, keeps those equal to their
    minimum and explodes them, so nothing is shuffled.
    """
    with_model = attach_model(points.select("point_id", "coord"), centroids, "_cs")
    dists = with_model.select("point_id", F.expr(
        f"transform(_cs, c -> named_struct('dist', {SQ_DIST_LAMBDA}, 'cluster_id', c.cluster_id))").alias("_ds"))
    best = dists.select("point_id", "_ds", F.array_min("_ds").alias("_m"))
    ties = best.select("point_id", F.explode(F.filter("_ds", lambda s: s["dist"] == F.col("_m")["dist"])).alias("_t"))
    return ties.select("point_id", F.col("_t.cluster_id").cast("int").alias("cluster_id"),
                       F.col("_t.dist").alias("dist"))


def distinct_points(points: DataFrame) -> DataFrame:
    """A10: one row per distinct coordinate with its multiplicity ``w`` and the
    lowest ``point_id``.  Duplicates are combined map-side before the
    shuffle, so a coordinate held by a third of all rows stays cheap."""
    return points.groupBy("coord").agg(F.count(F.lit(1)).alias("w"), F.min("point_id").alias("point_id"))
