"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from centrix.session import scratch_path, ship_package

#: Fixed value: characters that separate words (space and 0x09-0x0D).
WORD = r"[^\x20\x09-\x0D]+"
WS = " \t\n\x0b\x0c\r"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def hash_share(col: str, share: float, seed: str) -> Column:
    """True for a fixed, key-determined share of rows (a documented training
    bound, never used to skip rows of a result)."""
    if share >= 1.0:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.col(col), F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000)


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package made importable in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def maybe_in(df: DataFrame, col: str, keys: DataFrame, key_col: str, bits: int = 1 << 23, others: bool = False) -> DataFrame:
    """``df`` without most rows whose ``col`` isn't among the keys (nulls count
    as a key): a bitmap of hashes, of ``bits`` bits whatever the input, is
    broadcast in words of 64.  For use before a join, which decides.
    ``others``: exactly the rows that are left out otherwise."""
    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c)), F.lit(bits))

    def word(p: Column) -> Column:
        return F.shiftright(p, 6).cast("int")

    at = keys.select(place(key_col).alias("p"))
    one = F.expr("shiftleft(1L, cast(p & 63 as int))")
    marks = at.groupBy(word(F.col("p")).alias("_word")).agg(F.bit_or(one).alias("_marks"))
    bit = F.getbit(F.col("_marks"), place(col).bitwiseAND(F.lit(63)).cast("int"))
    if others:
        return df.join(F.broadcast(marks), word(place(col)) == F.col("_word"), "left").where(F.coalesce(bit == 0, F.lit(True))).drop("_word", "_marks")
    return df.join(F.broadcast(marks), word(place(col)) == F.col("_word")).where(bit == 1).drop("_word", "_marks")
