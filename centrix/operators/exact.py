"""Sums of doubles that don't depend on the order of the rows.

A sum is kept as an integer in limbs of 32 bits: limb ``l`` counts multiples of
``2^(32 l)``.  Limbs are 64-bit integers, so partial sums of any rows, blocks
or tasks merge by adding integers, in any order and with nothing lost, and the
total is rounded to a double once.  Spark merges them as ``sum(BIGINT)``.

Inside a task the additions are plain float64 sums that happen to be exact:
values are cut at fixed powers of two into parts that are short enough for
their sum to fit a double, from the top down until nothing is left.  Points
whose features share a range (integers, fixed decimals scaled to integers) are
one part and cost nothing extra.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centrix.operators.kernels import column_sums

LIMB = 32
MASK = (1 << LIMB) - 1
#: With weights, rows are summed so many at a time and weights in digits of so
#: many bits, so that a digit times a part still sums exactly.
WEIGHT_ROWS = 1 << 12
WEIGHT_BITS = 8


def is_plain(X: np.ndarray) -> bool:
    """Whether any float64 sum of rows of ``X`` is exact, whatever its order."""
    top = np.abs(X).max(initial=0.0)
    if not np.isfinite(top):
        raise ValueError("every point must have finite features")
    if top == 0.0:
        return True
    bits = 53 - int(len(X)).bit_length() - int(np.frexp(top)[1])
    if bits > 1000:
        return False
    # all values must be multiples of 2^-bits, the unit that sums of this size keep
    return bool((np.ldexp(np.rint(np.ldexp(X, bits)), -bits) == X).all())


def parts(x: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """``x`` as arrays that add up to it and of which up to ``rows`` values of
    a column sum exactly, in any order."""
    rest = x
    while (top := np.abs(rest).max(initial=0.0)) != 0.0:
        if not np.isfinite(top):
            raise ValueError("sums need finite values")
        # adding and taking away 1.5 * 2^p rounds to multiples of 2^(p - 52)
        power = int(np.frexp(top)[1]) + int(rows).bit_length()
        if power > 1020:
            raise ValueError("values are too large to be added")
        if power <= -1022:  # multiples of the smallest double, and few of them
            yield rest
            return
        shift = np.ldexp(1.5, power)
        part = (rest + shift) - shift
        yield part
        rest = rest - part


def _upper_half(x: np.ndarray) -> np.ndarray:
    """``x`` rounded to 26 bits, so that products with short digits are exact."""
    fraction, exponent = np.frexp(x)
    return np.ldexp(np.rint(fraction * 2.0 ** 26), exponent - 26)


class ExactSums:
    """Exact sums of ``width`` columns for ``k`` groups."""

    def __init__(self, k: int, width: int):
        self.shape = (k, width)
        self.limbs: dict[int, np.ndarray] = {}

    def _add(self, limb: int, column: int, values: np.ndarray) -> None:
        if values.any():
            if limb not in self.limbs:
                self.limbs[limb] = np.zeros(self.shape, np.int64)
            self.limbs[limb][:, column:column + values.shape[1]] += values

    def add(self, sums: np.ndarray, column: int = 0, shift: int = 0) -> None:
        """Add a (k, columns) array of doubles, times ``2^shift``, as they are."""
        fraction, exponent = np.frexp(sums)
        whole = (fraction * 2.0 ** 53).astype(np.int64)
        low = exponent.astype(np.int64) - 53 + shift
        sign, size = np.sign(whole), np.abs(whole)
        at, by = low >> 5, low & 31
        near, far = (size & MASK) << by, (size >> LIMB) << by
        pieces = (near & MASK, (near >> LIMB) + (far & MASK), far >> LIMB)
        for limb in np.unique(at[whole != 0]).tolist():
            here = sign * (at == limb)
            for j, piece in enumerate(pieces):
                self._add(limb + j, column, piece * here)

    def add_columns(self, idx: np.ndarray, XT: np.ndarray, column: int = 0, weight: np.ndarray | None = None) -> None:
        """Add to each group its points, columns of ``XT`` (d, n), times ``weight``."""
        k, n = self.shape[0], XT.shape[1]
        if weight is None:
            for part in parts(XT, n):
                self.add(column_sums(idx, part, k), column)
            return
        for low in range(0, n, WEIGHT_ROWS):
            rows = slice(low, low + WEIGHT_ROWS)
            whole = weight[rows].astype(np.int64)
            # room for a digit of the weight besides the number of rows
            for part in parts(XT[:, rows], len(whole) << WEIGHT_BITS):
                high = _upper_half(part)
                for piece in (high, part - high):
                    for bit in range(0, max(1, int(whole.max(initial=0)).bit_length()), WEIGHT_BITS):
                        digit = (whole >> bit & (1 << WEIGHT_BITS) - 1).astype(np.float64)
                        self.add(column_sums(idx[rows], piece * digit, k), column, bit)

    def add_integers(self, idx: np.ndarray, XT: np.ndarray, column: int = 0) -> None:
        """:meth:`add_columns` for 64-bit integers, of any size."""
        low = XT & (1 << 32) - 1
        for piece, shift in ((low, 0), (XT >> 32, 32)):
            self.add(column_sums(idx, piece.astype(np.float64), self.shape[0]), column, shift)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The limbs that aren't 0: group, column, limb, value."""
        found = [(*np.nonzero(v), limb, v) for limb, v in self.limbs.items()]
        group, column, limb, value = ([], [], [], [])
        for g, c, at, v in found:
            group.append(g)
            column.append(c)
            limb.append(np.full(len(g), at))
            value.append(v[g, c])
        empty = np.zeros(0, np.int64)
        return tuple(np.concatenate([empty, *x]) for x in (group, column, limb, value))


def to_doubles(shape: tuple, group: np.ndarray, column: np.ndarray, limb: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The sums that limb rows (each group, column and limb once) stand for.

    Carries make the limbs canonical, so equal sums give equal doubles."""
    out = np.zeros(shape)
    if not len(value):
        return out
    low, high = int(limb.min()), int(limb.max()) + 3
    held = np.zeros((high - low, *shape), np.int64)
    held[limb - low, group, column] = value

    def carry() -> None:
        for j in range(len(held) - 1):
            held[j + 1] += held[j] >> LIMB
            held[j] &= MASK

    carry()
    negative = held[-1] < 0
    held[:, negative] *= -1
    carry()
    # from the top down, what a sum rounds off is kept and added at the end
    rest = np.zeros(shape)
    for j in range(len(held) - 1, -1, -1):
        term = np.ldexp(held[j].astype(np.float64), LIMB * (j + low))
        total = out + term
        back = total - out
        rest += (out - (total - back)) + (term - back)
        out = total
    out = out + rest
    return np.where(negative, -out, out)


#: One limb of a sum: of which group, which column.
LIMB_SCHEMA = T.StructType([T.StructField("grp", T.IntegerType()), T.StructField("col", T.IntegerType()), T.StructField("limb", T.IntegerType()), T.StructField("v", T.LongType())])


def limb_batch(sums: ExactSums) -> pa.RecordBatch:
    group, column, limb, value = sums.rows()
    return pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in (group, column, limb)), pa.array(value)], names=["grp", "col", "limb", "v"])


def merge_limbs(rows: DataFrame) -> DataFrame:
    """Partial sums merged by Spark: one row a limb."""
    keys = [c for c in rows.columns if c != "v"]
    return rows.groupBy(*keys).agg(F.sum("v").alias("v"))


def collect_sums(rows: DataFrame, shape: tuple) -> np.ndarray:
    """The sums of limb rows as a (groups, columns) array of doubles; a limb
    may come in several rows."""
    got = rows.toArrow()
    group, column, limb, value = (got.column(c).to_numpy().astype(np.int64) for c in ("grp", "col", "limb", "v"))
    if not len(value):
        return np.zeros(shape)
    low = int(limb.min())
    key = ((limb - low) * shape[0] + group) * shape[1] + column
    held = np.zeros((int(limb.max()) - low + 1) * shape[0] * shape[1], np.int64)
    np.add.at(held, key, value)
    there = np.flatnonzero(held)
    limb, rest = np.divmod(there, shape[0] * shape[1])
    group, column = np.divmod(rest, shape[1])
    return to_doubles(shape, group, column, limb + low, held[there])
