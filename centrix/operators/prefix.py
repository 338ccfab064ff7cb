"""Running sums over all rows, without one task seeing all of them.

Rows are dealt to ranges of their order, each range is sorted and summed where
it lies, and the ranges' totals (one row a range) are summed in their turn.  No
bound or value of the data is part of a plan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from centrix.session import scratch_path, ship_package

WHOLE = ("tinyint", "smallint", "int", "bigint")


def range_sums(df: DataFrame, weight: str, order: str | list[str], ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_range`` and ``_in``, the running sum inside the row's range,
    written to the shared folder (so a repeated task can't deal the rows
    otherwise); and ``(_range, _off, _tot)``, the sum before each range and of it.

    A null weight counts as 0.  Rows of equal order may lie in two ranges: a
    value that a third of the rows share doesn't meet in one task."""
    spark = df.sparkSession
    order = [order] if isinstance(order, str) else order
    whole = df.schema[weight].dataType.simpleString() in WHOLE
    kind, held = (np.int64, "BIGINT") if whole else (np.float64, "DOUBLE")
    own = df.withColumn("_w", F.coalesce(F.col(weight).cast(held), F.lit(0).cast(held)))
    tie = F.xxhash64(*[f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    keys = [*[F.col(c) for c in order], tie]
    dealt = own.repartitionByRange(ranges, *keys) if ranges else own.repartitionByRange(*keys)
    ship_package(spark)

    def run(batches):
        from pyspark import TaskContext
        at, total, seen = TaskContext.get().partitionId(), kind(0), 0
        for b in batches:
            w = b.column(b.schema.get_field_index("_w")).to_numpy(zero_copy_only=False)
            sums = np.cumsum(np.concatenate([[total], w]), dtype=kind)[1:]
            if len(sums):
                total = sums[-1]
            count = np.arange(seen, seen + len(w))
            seen += len(w)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(w), at, np.int32)), pa.array(count), pa.array(sums)],
                                             names=[*b.schema.names, "_range", "_i", "_in"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    path = scratch_path(spark, "range-sums")
    dealt.sortWithinPartitions(*order).mapInArrow(run, f"{schema}, _range INT, _i BIGINT, _in {held}").drop("_w").write.parquet(path)
    rows = spark.read.parquet(path)
    totals = rows.groupBy("_range").agg(F.max_by("_in", "_i").alias("_tot"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)   # one row a range
    totals = totals.select("_range", "_tot", F.coalesce(F.sum("_tot").over(before), F.lit(0).cast(held)).alias("_off"))
    return rows.drop("_i"), totals


def prefix_sum(df: DataFrame, weight: str, order: str | list[str], out: str, ranges: int | None = None, before: bool = False) -> DataFrame:
    """``df`` with ``out``, the sum of ``weight`` over all rows up to this one in
    ``order`` (``before``: without this one)."""
    rows, totals = range_sums(df, weight, order, ranges)
    run = F.col("_off") + F.col("_in")
    if before:
        run = run - F.coalesce(F.col(weight), F.lit(0))
    return rows.join(totals.select("_range", "_off"), "_range").withColumn(out, run).drop("_range", "_in", "_off")
