"""Named tables (S11): replace a table from a query, clear a table.

A durable table is a name that points to one version of its rows, a folder below
the warehouse.  A replacement is written as a new version beside the old one, and
then the name is switched over in one step of the catalog.  Until that step
readers see the old rows, and a replacement that fails never reaches it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from centrix.sources.fs import list_names, path_exists, remove


def _folder(spark: SparkSession, name: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions"


def replace_table(df: DataFrame, name: str, durable: bool = False, keep: int = 2) -> DataFrame:
    """CREATE OR REPLACE: a temp view for in-job names; a written version and a
    switched name when ``durable`` (which also cuts lineage).

    The replacement may read the table it replaces, and may have other columns.
    The last ``keep`` versions stay, for readers that began before the switch."""
    spark = df.sparkSession
    if not durable:
        df.createOrReplaceTempView(name)
        return spark.table(name)
    folder = _folder(spark, name)
    before = list_names(spark, folder) if path_exists(spark, folder) else []
    version = f"v{max([int(v[1:].split('-')[0]) for v in before], default=0) + 1:09d}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(f"{folder}/{version}")
    except BaseException:
        remove(spark, f"{folder}/{version}")
        raise
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{folder}/{version}`")
    for old in sorted([*before, version])[:-max(1, keep)]:
        remove(spark, f"{folder}/{old}")
    return spark.table(name)


def clear_table(spark: SparkSession, name: str) -> None:
    """Empty a durable table (a new version without rows), or drop a temp view."""
    if spark.catalog.tableExists(name) and not _is_temp(spark, name):
        replace_table(spark.table(name).limit(0), name, durable=True)
    else:
        spark.catalog.dropTempView(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a durable table, its name first and then all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    remove(spark, _folder(spark, name))


def _is_temp(spark: SparkSession, name: str) -> bool:
    return any(t.name == name and t.isTemporary for t in spark.catalog.listTables())
