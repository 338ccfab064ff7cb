"""Text helpers: whitespace split, string-array to numbers, JSON-like arrays,
data-set names (F2, F3, F4, F10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_ws(line) -> Column:
    """Trim all surrounding whitespace, split on runs of whitespace."""
    return F.split(F.regexp_replace(_c(line), r"^\s+|\s+$", ""), r"\s+")


def to_numbers(arr, dtype: str = "bigint", on_error: str = "raise") -> Column:
    """String array -> number array.  ``on_error='raise'`` uses the ANSI cast
    (bad text fails the job); ``'null'`` uses try_cast (bad text -> NULL)."""
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    if on_error == "raise":
        return F.transform(_c(arr), lambda s: s.cast(dtype))
    return F.transform(_c(arr), lambda s: s.try_cast(dtype))


def parse_json_array(text) -> Column:
    """'[1.5,\\n 2]' -> [1.5, 2.0] (newlines dropped, then parsed as JSON)."""
    return F.from_json(F.regexp_replace(_c(text), r"\n", ""), "array<double>")


def dataset_name(base, suffix) -> Column:
    """``base || suffix``, e.g. 'a3' + 'e2'."""
    base = _c(base)
    suffix = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(base, suffix)
