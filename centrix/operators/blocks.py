"""Dense point blocks for iterative scans.

An iterative job scans the same points once per iteration.  Converting
``ARRAY`` rows to Arrow each time costs more than the arithmetic, so the
points are packed once into blocks: one row per few MB of points holding the
ids (int64) and the coordinates as one row-major float64 matrix, both as
BINARY.  Each later pass moves a handful of large buffers per partition.
Integer coordinates below 2^53 are exact in float64, so results do not change.
A block's matrix is kept in the narrowest type that holds all its values as they
are (``kind``), and a block knows whether plain float64 sums over its points are
exact (``plain``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centrix.operators import kernels
from centrix.operators.exact import is_plain
from centrix.session import ship_package

BLOCK_BYTES = 4 << 20
BLOCK_SCHEMA = "n INT, d INT, ids BINARY, x BINARY, kind STRING, plain BOOLEAN"

# Types a matrix may be kept in, narrow ones first.
KINDS = ("i1", "i2", "f4", "i4", "f8")


def narrow(X: np.ndarray) -> tuple[bytes, str]:
    """A matrix as the bytes of the narrowest type that keeps every bit."""
    for kind in KINDS:
        if kind[0] == "i" and not (np.abs(X).max(initial=0.0) < 2.0 ** (8 * int(kind[1]) - 1)):
            continue
        with np.errstate(over="ignore"):
            small = X.astype("<" + kind)
        # equal as bits: a negative zero stays one
        if kind == "f8" or np.array_equal(small.astype(np.float64).view(np.int64), X.view(np.int64)):
            return small.tobytes(), kind
    raise AssertionError("f8 holds everything")


def to_blocks(points: DataFrame, d: int | None = None, block_bytes: int = BLOCK_BYTES,
              weight: str | None = None) -> DataFrame:
    """``(point_id, coord[, weight])`` -> ``(n, d, ids, x, kind, plain[, w])`` blocks,
    partition by partition (no shuffle).  Rows of another length than ``d``
    or with a null feature fail the job.  ``weight`` (a multiplicity column) is packed as float64."""
    if d is None:
        first = points.select(F.size("coord")).first()
        if first is None:
            raise ValueError("no points")
        d = int(first[0])
    rows = max(1, block_bytes // (8 * d))
    ship_package(points.sparkSession)

    def emit(ids: np.ndarray, X: np.ndarray, W) -> pa.RecordBatch:
        X = np.ascontiguousarray(X, dtype=np.float64)
        cols = [pa.array([len(ids)], pa.int32()), pa.array([d], pa.int32()),
                pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                *(pa.array([v], t) for v, t in zip((*narrow(X), is_plain(X)), (pa.binary(), pa.string(), pa.bool_()), strict=True))]
        names = ["n", "d", "ids", "x", "kind", "plain"]
        if weight:
            cols.append(pa.array([np.ascontiguousarray(W, dtype=np.float64).tobytes()], pa.binary()))
            names.append("w")
        return pa.RecordBatch.from_arrays(cols, names=names)

    def fn(batches):
        pend_ids, pend_x, pend_w, count = [], [], [], 0
        for b in batches:
            pend_ids.append(b.column(b.schema.get_field_index("point_id")).to_numpy(zero_copy_only=False))
            pend_x.append(kernels.coords(b, d))
            if weight:
                pend_w.append(np.asarray(b.column(b.schema.get_field_index(weight))
                                         .to_numpy(zero_copy_only=False), dtype=np.float64))
            count += b.num_rows
            if count >= rows:
                ids, X = np.concatenate(pend_ids), np.concatenate(pend_x)
                W = np.concatenate(pend_w) if weight else None
                lo = 0
                while count - lo >= rows:
                    yield emit(ids[lo:lo + rows], X[lo:lo + rows], W[lo:lo + rows] if weight else None)
                    lo += rows
                pend_ids, pend_x, count = [ids[lo:]], [X[lo:]], count - lo
                pend_w = [W[lo:]] if weight else []
        if count:
            yield emit(np.concatenate(pend_ids), np.concatenate(pend_x),
                       np.concatenate(pend_w) if weight else None)

    cols = ["point_id", "coord"] + ([weight] if weight else [])
    schema = BLOCK_SCHEMA + (", w BINARY" if weight else "")
    return points.select(*cols).mapInArrow(fn, schema)


def iter_rows(batches, d: int) -> Iterator[dict]:
    """Inside a task: every block row as a dict of arrays, those of its columns
    that are there and not null (``x`` in its own type, ``plain`` as a truth value)."""
    kinds = {"ids": "i8", "x": None, "w": "f8", "label": "i4", "far": "f8", "dn": "f8"}
    for b in batches:
        columns = {name: b.column(i) for i, name in enumerate(b.schema.names)}
        for i in range(b.num_rows):
            row = {name: np.frombuffer(columns[name][i].as_buffer(), dtype="<" + (kind or columns["kind"][i].as_py()))
                   for name, kind in kinds.items() if name in columns and columns[name][i].is_valid}
            if "x" in row:
                row["x"] = row["x"].reshape(-1, d)
            if "plain" in columns:
                row["plain"] = columns["plain"][i].as_py()
            yield row
