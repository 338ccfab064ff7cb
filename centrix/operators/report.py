"""Reports over the combined run table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATALOGUE_COLS = ["dataset", "n_samples", "n_features", "n_clusters"]


def system_columns(combined: DataFrame, first: int = 4) -> list[str]:
    """The system columns, i.e. every column from position ``first`` on."""
    return combined.columns[first:]


def matching(df: DataFrame, text: str, keep: bool = True, col: str = "dataset") -> DataFrame:
    """P5: rows whose name contains ``text`` (``keep=False``: do not contain)."""
    cond = F.col(col).contains(text)
    return df.filter(cond if keep else ~cond)


def with_samples(df: DataFrame, n: int) -> DataFrame:
    """Rows with exactly ``n`` samples."""
    return df.filter(F.col("n_samples") == n)


def _long(df: DataFrame, ids: list[str]) -> DataFrame:
    systems = [c for c in df.columns if c not in CATALOGUE_COLS and c not in ids]
    return df.unpivot(ids, systems, "system", "time_ms").filter(F.col("time_ms").isNotNull())


def by_sample_size(combined: DataFrame, families: list[str]) -> DataFrame:
    """K6: ``(family, system, n_samples, time_ms)`` — one series per family
    and system (families matched by substring of the data-set name)."""
    fam = F.explode(F.array(*[F.lit(f) for f in families])).alias("family")
    tagged = combined.select("*", fam).filter(F.col("dataset").contains(F.col("family")))
    return _long(tagged, ["family", "n_samples"] + [c for c in CATALOGUE_COLS if c != "n_samples"]) \
        .select("family", "system", "n_samples", "time_ms")


def by_dimension(combined: DataFrame, sample_sizes: list[int]) -> DataFrame:
    """K7: ``(n_samples, system, n_features, time_ms)`` for the given sizes."""
    sel = combined.filter(F.col("n_samples").isin(sample_sizes))
    return _long(sel, CATALOGUE_COLS).select("n_samples", "system", "n_features", "time_ms")


def select_iterations(history: DataFrame, iters: list[int]) -> DataFrame:
    """The asked-for iterations of a per-iteration history."""
    return history.filter(F.col("iter").isin(iters))


def last_iteration(history: DataFrame, value: str) -> DataFrame:
    """The value at the last iteration (``max_by``)."""
    return history.agg(F.max_by(value, "iter").alias(value))
