"""Vector arithmetic on ARRAY columns, kept inside Spark SQL.

All distances are *squared* Euclidean, summed feature by feature from the
first to the last (a left fold starting at 0.0).  The NumPy kernel in
``centrix.operators.kernels`` uses the same order, so both give the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sq_dist(a, b) -> Column:
    """Squared Euclidean distance of two equal-length numeric arrays."""
    a, b = _c(a), _c(b)
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double"))
                   * (x.cast("double") - y.cast("double"))),
        F.lit(0.0), lambda acc, t: acc + t)


def sq_norm(a) -> Column:
    """Squared norm of a numeric array (row norm used by seeding)."""
    return F.aggregate(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double")),
                       F.lit(0.0), lambda acc, t: acc + t)


def checked_sql(coord: str, d: int) -> str:
    """SQL of a vector column that fails the job on a row that is null, has
    another length than ``d``, or holds a null."""
    return (f"CASE WHEN {coord} IS NULL OR size({coord}) <> {int(d)} OR exists({coord}, x -> x IS NULL) "
            f"THEN raise_error('every point must have {int(d)} features, none of them null') ELSE {coord} END")


def checked(coord: str, d: int) -> Column:
    return F.expr(checked_sql(coord, d))


def vec_add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def vec_div(a, n) -> Column:
    """Element-wise a / n as doubles (mean of a summed vector)."""
    n = _c(n) if isinstance(n, (str, Column)) else F.lit(n)
    return F.transform(_c(a), lambda x: x.cast("double") / n.cast("double"))


def vec_least(a, b) -> Column:
    """Element-wise minimum of two arrays."""
    return F.zip_with(_c(a), _c(b), lambda x, y: F.least(x, y))


SQ_DIST_SQL = ("aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, "
               "(acc, t) -> acc + t)")


MODEL_TYPE = "ARRAY<STRUCT<cluster_id: INT, coord: ARRAY<DOUBLE>>>"


def register_sql_functions(spark: SparkSession) -> None:
    """SQL functions, no Python in the row path:

    * ``sq_dist(a, b)``: squared distance of two vectors.
    * ``nearest_centroid(coord, model)``: ``struct(dist, cluster_id)`` of the
      nearest entry of a model array (lowest id on a tie).  With the model as
      a scalar subquery, ``(SELECT array_sort(collect_list(struct(cluster_id,
      coord))) FROM centroids)``, Spark evaluates the subquery once and ships
      the value with every task: no join, no shuffle of the points.
    """
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION sq_dist(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) "
              f"RETURNS DOUBLE RETURN {SQ_DIST_SQL}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION nearest_centroid(p ARRAY<DOUBLE>, m {MODEL_TYPE}) "
              "RETURNS STRUCT<dist: DOUBLE, cluster_id: INT> RETURN "
              "array_min(transform(m, c -> named_struct('dist', aggregate(zip_with(p, c.coord, "
              "(x, y) -> (x - y) * (x - y)), 0D, (acc, t) -> acc + t), 'cluster_id', c.cluster_id)))")
