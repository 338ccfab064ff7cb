"""A training-data pipeline of five stages over ``documents``.

Each stage takes the Parquet table the one before it wrote, works on all of
it, and returns what it keeps; all but the last return the columns of
``documents``.  It belongs to the subpackage ``centrix.llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centrix.llm import bpe, line_dedup, mixing, quality_model, simhash
from centrix.llm.catalog import tokenizer_path, word_count
from centrix.llm.common import cut, maybe_in, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality_model.classify(docs).where("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines; a document keeps its row, and ``n_chars`` follows."""
    found = line_dedup.dedup_lines(docs)
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each class of near copies one row: the smallest id (null last),
    then the smallest hash of the text, then of the row; of equal rows one."""
    row = [*docs.columns, *[F.col(c).isNull() for c in docs.columns]]
    keys = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"),
                    F.xxhash64(*row).alias("h"), F.xxhash64(F.lit("row"), *row).alias("g"))
    root = simhash.near_classes(docs.withColumn("_row", keys), shingle=4, distance=4, id_col="_row")
    stay = root.where(F.col("_row") == F.col("component_id")).groupBy("_row").agg(F.count("*").alias("n"))
    stay = cut(stay.select(F.col("_row.h").alias("h"), F.col("_row").alias("_k"), "n"), "near-stay")
    at = docs.withColumn("_row", keys).withColumn("_h", F.col("_row.h"))
    alone, again = stay.where("n = 1"), stay.where("n > 1")
    one = at.join(alone.hint("shuffle_hash"), F.col("_row") == F.col("_k")).select(docs.columns)
    # only rows that have equal ones are looked at again
    equal = maybe_in(at, "_h", again, "h").join(again.hint("shuffle_hash"), F.col("_row") == F.col("_k"))
    return one.union(equal.dropDuplicates(["_row"]).select(docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their targets."""
    found = mixing.mix(docs.withColumn("_size", word_count()), size_col="_size")
    return found.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded again."""
    return bpe.encode_decode(docs, tokenizer_path(), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", tokens),
]

#: Not expressible in SQL (a trained scorer, SimHash, BPE); tested against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs, name.replace(" ", "-"))
    return docs
