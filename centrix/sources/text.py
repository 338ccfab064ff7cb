"""Whitespace-separated point files.

One point per line, features separated by whitespace.  Line numbers become
``point_id`` (1-based) so labels, partitions and centroids join on ids, never
on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centrix.functions.text import split_ws, to_numbers
from centrix.operators.prefix import prefix_sum
from centrix.session import scratch_path
from centrix.sources.fs import path_exists



def with_row_id(lines: DataFrame, id_col: str = "point_id", start: int = 1) -> DataFrame:
    """Number the rows of a file scan in file order, 1-based by default.

    ``lines`` must still carry ``_path``/``_block`` (file path, split start).
    The rows are read once and written to the shared folder with their place in
    the task's read.  Ids come from (path, split start, position inside the split):
    one small aggregate per split, a two-level prefix sum over the split table,
    and a join back (broadcast where Spark's own size threshold allows it).  Part
    files are ordered by their number, other files by name; neither the rows
    nor the splits pass through one task.
    """
    spark = lines.sparkSession
    path = scratch_path(spark, "numbered-lines")
    lines.withColumn("_mono", F.monotonically_increasing_id()).write.parquet(path)   # the one scan of the text
    tagged = spark.read.parquet(path)
    splits = (tagged.groupBy("_path", "_block")
              .agg(F.min("_mono").alias("_m0"), F.count(F.lit(1)).alias("_cnt")))
    splits = splits.withColumns({"_folder": F.regexp_extract("_path", "^(.*/)?([^/]*)$", 1), "_name": F.substring_index("_path", "/", -1)})
    splits = splits.withColumn("_part", F.regexp_extract("_name", r"^part-(\d+)", 1).try_cast("bigint"))   # null: no part file
    placed = prefix_sum(splits, "_cnt", ["_folder", "_part", "_name", "_block"], "_above", before=True)
    out = tagged.join(placed.select("_path", "_block", "_m0", "_above"), ["_path", "_block"])
    out = out.withColumn(id_col, F.lit(start) + F.col("_above") + F.col("_mono") - F.col("_m0"))
    return out.drop("_mono", "_m0", "_above", "_path", "_block")


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path)
    raw = raw.select("value", F.col("_metadata.file_path").alias("_path"),
                     F.col("_metadata.file_block_start").alias("_block"))
    return raw.filter(F.trim(F.col("value")) != "")


def load_points(spark: SparkSession, path: str, dtype: str = "bigint",
                on_error: str = "raise", id_col: str = "point_id") -> DataFrame:
    """Read a point file into ``(point_id, coord ARRAY<dtype>)`` (S1 + F2 + F3)."""
    lines = _read_lines(spark, path)
    pts = lines.select(to_numbers(split_ws("value"), dtype, on_error).alias("coord"),
                       "_path", "_block")
    return with_row_id(pts, id_col).select(id_col, "coord")


def load_labels(spark: SparkSession, path: str, col: str = "label") -> DataFrame:
    """A one-number-per-line file as ``(point_id, label INT)``."""
    pts = load_points(spark, path, dtype="bigint")
    return pts.select("point_id", F.col("coord")[0].cast("int").alias(col))


def check_dims(points: DataFrame, coord: str = "coord") -> int:
    """One pass: every row must have the same number of features; returns d."""
    row = points.agg(F.min(F.size(coord)).alias("lo"), F.max(F.size(coord)).alias("hi")).first()
    if row is None or row["lo"] is None:
        raise ValueError("no points")
    if row["lo"] != row["hi"]:
        raise ValueError(f"ragged rows: between {row['lo']} and {row['hi']} features")
    return int(row["lo"])


def write_points(points: DataFrame, path: str, coord: str = "coord",
                 order_by: str | None = "point_id", mode: str = "error", integer: bool = True) -> None:
    """Write coordinates as text, single-space separated.

    Values are truncated toward zero, as ``%d`` does, or written in full with
    ``integer=False``.  With ``order_by`` the files hold the rows in that order
    (range-partitioned sort), so a later :func:`load_points` gives the same
    ids back.
    """
    df = points.orderBy(order_by) if order_by else points
    kind = "bigint" if integer else "string"
    text = df.select(F.array_join(F.transform(coord, lambda x: x.cast(kind)), " ").alias("value"))
    text.write.mode(mode).text(path)


# The parts of a saved result, with their columns.
_OUTPUT_SCHEMAS = {
    "label": "point_id BIGINT, cluster_id INT, dist DOUBLE",
    "centroid": "cluster_id INT, n BIGINT, coord ARRAY<DOUBLE>",
    "cost": "iter INT, cost DOUBLE",
    "history": "iter INT, point_id BIGINT, cluster_id INT, dist DOUBLE",
}


def write_output(path: str, labels: DataFrame | None = None, centroids: DataFrame | None = None,
                 costs: DataFrame | None = None, fmt: str = "parquet", history: DataFrame | None = None) -> list[str]:
    """Write whichever of labels / centroids / costs / labels by iteration are
    present (S6)."""
    if fmt not in ("parquet", "text"):
        raise ValueError("fmt must be 'parquet' or 'text'")
    written = []
    for name, df in (("label", labels), ("centroid", centroids), ("cost", costs), ("history", history)):
        if df is None:
            continue
        target = f"{path.rstrip('/')}/{name}"
        if fmt == "parquet":
            df.write.mode("overwrite").parquet(target)
        else:
            cols = []
            for f in df.schema.fields:
                if f.dataType.typeName() == "array":
                    cols.append(F.array_join(F.transform(f.name, lambda x: x.cast("string")), " "))
                else:
                    cols.append(F.col(f.name).cast("string"))
            df.select(F.concat_ws(" ", *cols).alias("value")).write.mode("overwrite").text(target)
        written.append(target)
    return written


def load_output(spark: SparkSession, path: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read back the parts that :func:`write_output` wrote, in either form, with
    fixed schemas (S7).  Absent parts are left out."""
    if fmt not in ("parquet", "text"):
        raise ValueError("fmt must be 'parquet' or 'text'")
    out = {}
    for name, schema in _OUTPUT_SCHEMAS.items():
        target = f"{path.rstrip('/')}/{name}"
        if not path_exists(spark, target):
            continue
        if fmt == "parquet":
            out[name] = spark.read.schema(schema).parquet(target)
            continue
        words = spark.read.text(target).select(split_ws("value").alias("w"))
        cols = []
        for k, field in enumerate(f.split(" ", 1) for f in schema.split(", ")):
            col, kind = field
            value = F.slice("w", F.lit(k + 1), F.size("w")) if kind.startswith("ARRAY") else F.col("w")[k]
            cols.append(value.cast(kind).alias(col))
        out[name] = words.select(*cols)
    return out


def clean_text(spark: SparkSession, src: str, dst: str) -> None:
    """Rewrite any whitespace-separated numeric file as single-space integers
    into a new folder (S8)."""
    pts = load_points(spark, src, dtype="double")
    write_points(pts, dst)
