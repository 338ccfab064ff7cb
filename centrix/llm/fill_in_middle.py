"""Fill-in-the-middle order of texts, cut at units found by a learned index.

A text is a row of units (lines, unless told otherwise).  A cut after ``i``
units lies at the code point where unit ``i`` begins.  The boundaries of a text
are kept as a learned rank index: straight segments that predict the place of
every boundary from its rank within a fixed error, and one byte a boundary for
what the prediction misses.  A cut is predicted from its segment and corrected
by its stored residual, so it is exact.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, text_or_empty

#: Fixed value: a unit is a line with its end, or the last line without one.
LINES = r"[^\n]*\n|[^\n]+"
#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Largest error of a segment; with the rounding of one, a residual fits a byte.
ERROR = 126


class RankIndex:
    """Boundaries ``ends[i]`` (ascending, from 0) by segments and residuals.

    Segments are grown greedily: from its first boundary, a segment goes on as
    long as one slope keeps every boundary within ``error``; the slopes that
    do form an interval that only shrinks.
    """

    def __init__(self, ends: list[int], error: int = ERROR):
        self.first, self.base, self.slope = [], [], []
        start, low, high = 0, 0.0, float("inf")
        for i, end in enumerate(ends):
            run, rise = i - start, end - ends[start]
            if run:
                below, above = (rise - error) / run, (rise + error) / run
                if below <= high and above >= low:
                    low, high = max(low, below), min(high, above)
                    continue
                self._close(start, ends, low, high)
            start, low, high = i, 0.0, float("inf")
        self._close(start, ends, low, high)
        kind = np.min_scalar_type(-error - 2)
        guess = np.repeat(np.array(self.base), runs := np.diff([*self.first, len(ends)]))
        rank = np.arange(len(ends)) - np.repeat(np.array(self.first), runs)
        guess = guess + np.floor(np.repeat(np.array(self.slope), runs) * rank).astype(np.int64)
        self.residual = (np.asarray(ends, dtype=np.int64) - guess).astype(kind)

    def _close(self, start: int, ends: list[int], low: float, high: float) -> None:
        self.first.append(start)
        self.base.append(ends[start])
        self.slope.append((low + high) / 2 if high < float("inf") else 0.0)

    def __getitem__(self, rank: int) -> int:
        at = bisect_right(self.first, rank) - 1
        guess = self.base[at] + int(np.floor(self.slope[at] * (rank - self.first[at])))
        return guess + int(self.residual[rank])

    def __len__(self) -> int:
        return len(self.residual)


def arrange(form: str, prefix: str, middle: str, suffix: str) -> str:
    if form == "psm":
        return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    if form == "spm":
        return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return prefix + middle + suffix


def restore(form: str, output: str) -> str:
    """The text, from what :func:`arrange` made and the form alone."""
    if form == "plain":
        return output
    second = SUFFIX if form == "psm" else PREFIX
    one, _, rest = output[len(PREFIX):].partition(second)
    two, _, middle = rest.partition(MIDDLE)
    return one + middle + two if form == "psm" else two + middle + one


def draws(seed: int, key) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit draws of a row, the same in every run."""
    digest = hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, percent: int = 100,
              spm_percent: int = 50, units: str = LINES, with_texts: bool = True) -> DataFrame:
    """Fill-in-the-middle form of every text.

    ``units`` is a pattern whose matches cover the text.  Of ``n`` units the
    prefix takes those before the smaller and the middle those before the
    larger of two draws; ``percent`` of the rows are rearranged, and of these
    ``spm_percent`` with the suffix first.  A text that is empty or holds a
    mark stays plain, as then it could not be told apart again.

    Result, one row per input row: ``id_col``, ``n`` (units), ``form`` (plain,
    psm, spm), ``prefix_chars``, ``middle_chars`` (code points; null if plain),
    ``n_segments`` of the index, ``output_sha256``, ``restored_sha256`` (of the
    text rebuilt from output and form), and with ``with_texts`` also ``output``.
    A null text counts as empty, a null id draws like the id ``null``; rows
    that share id and text get equal rows.  Map-only: nothing is shuffled, and
    a task holds one batch.
    """
    fields = [docs.schema[id_col], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
              T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
              T.StructField("n_segments", T.LongType()), T.StructField("output_sha256", T.StringType()),
              T.StructField("restored_sha256", T.StringType())]
    if with_texts:
        fields.append(T.StructField("output", T.StringType()))

    def one(key, text: str, unit: re.Pattern) -> list:
        index = RankIndex([0, *(m.end() for m in unit.finditer(text))])
        n = len(index) - 1
        if len(text) != index[n]:
            raise ValueError("units must cover the whole text")
        h1, h2, h3, h4 = draws(seed, key)
        form = "spm" if h4 % 100 < spm_percent else "psm"
        if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= percent:
            form = "plain"
        a, b = (index[i] for i in sorted((h1 % (n + 1), h2 % (n + 1))))
        output = arrange(form, text[:a], text[a:b], text[b:])
        back = restore(form, output)
        sizes = [None, None] if form == "plain" else [a, b - a]
        return [n, form, *sizes, len(index.first), *(hashlib.sha256(t.encode()).hexdigest() for t in (output, back)), output]

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = re.compile(units)
        for batch in batches:
            columns: list[list] = [[] for _ in fields[1:]]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for column, value in zip(columns, one(key, text, unit), strict=False):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=k) for c, k in zip(columns, kinds, strict=False))], names=[f.name for f in fields])

    return map_batches(docs.select(F.col(id_col), text_or_empty(text_col)), run, T.StructType(fields))
