"""Vector means for any SQL user: two table functions.

    SELECT cluster_id, n, mean FROM vector_mean(TABLE(
        SELECT cluster_id, col, limb, sum(v) AS v
        FROM vector_sums(TABLE(SELECT cluster_id, coord FROM assigned))
        GROUP BY cluster_id, col, limb) PARTITION BY cluster_id)

``vector_sums`` adds up the vectors of each key as they pass a task and gives
rows of limbs (exact integers, see ``operators.exact``); SQL's own ``sum``
merges them, map-side first; ``vector_mean`` sees one key's few limbs.  Any
width, no number of features in the text, the same bits in any order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

from centrix.operators.exact import to_doubles
from centrix.operators.update import partial_sums
from centrix.session import ship_package


class _VectorSums:
    """``(key, coord)`` rows of any partition -> ``(cluster_id, col, limb, v)``.
    A vector that is null, holds a null or has another length than the others of
    its batch fails the job; so does, at the end, one of another batch."""

    def eval(self, table: pa.RecordBatch) -> Iterator[pa.Table]:
        keys, coord = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table.column(0), table.column(1)))
        if len(keys):
            if coord.null_count:
                raise ValueError("a vector is null")
            d = len(coord[0])
            rows = partial_sums(keys, coord.cast(pa.list_(pa.float64())), d)
            # the count stands at column -1 - d: it tells the width too
            column = rows.column("col").to_numpy()
            yield pa.table({"cluster_id": rows.column("key").cast(pa.int64()), "col": pa.array(np.where(column == d, -1 - d, column).astype(np.int32)),
                            "limb": rows.column("limb"), "v": rows.column("v")})


class _VectorMean:
    """One key's merged limbs -> ``(cluster_id, n, mean)``."""

    def __init__(self):
        self.rows = []

    def eval(self, table: pa.RecordBatch) -> Iterator[pa.Table]:
        self.rows.append(pa.table({name: table.column(i) for i, name in enumerate(("key", "col", "limb", "v"))}))
        return iter(())

    def terminate(self) -> Iterator[pa.Table]:
        if not self.rows:
            return
        rows = pa.concat_tables(self.rows)
        column, limb, value = (rows.column(c).to_numpy().astype(np.int64) for c in ("col", "limb", "v"))
        widths = np.unique(column[column < 0])
        if len(widths) != 1:
            raise ValueError("vectors of different lengths")
        d = int(-1 - widths[0])
        sums = to_doubles((1, d + 1), np.zeros(len(column), np.int64), np.where(column < 0, d, column), limb, value)[0]
        yield pa.table({"cluster_id": rows.column("key").slice(0, 1), "n": pa.array([int(sums[d])], pa.int64()),
                        "mean": pa.array([(sums[:d] / sums[d]).tolist()], pa.list_(pa.float64()))})


def register_table_functions(spark: SparkSession) -> None:
    """Make ``vector_sums`` and ``vector_mean`` known to the session's SQL."""
    ship_package(spark)
    spark.udtf.register("vector_sums", arrow_udtf(_VectorSums, returnType="cluster_id BIGINT, col INT, limb INT, v BIGINT"))
    spark.udtf.register("vector_mean", arrow_udtf(_VectorMean, returnType="cluster_id BIGINT, n BIGINT, mean ARRAY<DOUBLE>"))
