"""Counter-based random numbers that Spark SQL, DuckDB and NumPy compute to
the same bits.

``rand()``/``randn()`` depend on partitioning and have no twin outside Spark,
so every random draw here is a pure function of (stream, id).  A draw joins two
integer mixes of the id's low 30 bits and the rest, one modulo each of two
primes below 2^31 (all products stay below 2^62: no overflow in BIGINT or
int64), so it has the 53 bits of a double and no period among 64-bit ids.  A
stream number is derived from the user seed and the draw's role (step, trial,
feature), so re-running any task gives the same draw.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the mixing function (our own choice; changing them changes
# every seeded result).
P = 2147483647          # the prime 2^31 - 1: stream numbers and the first mix
Q = 2147483629          # the prime 2^31 - 19: the second mix
M_STREAM = 1000003      # stream derivation multiplier
# per mix: modulus, multiplier and addend of the first and second round
MIXES = ((P, 48271, 12345, 69621, 54321), (Q, 69621, 54321, 48271, 12345))
LOW = (1 << 30) - 1     # the id's low part
TOP = 1.0 - 2.0 ** -53  # the largest draw


def stream(seed: int, *parts: int) -> int:
    """Stream number for a draw role, e.g. ``stream(seed, step, trial)``."""
    s = int(seed) % P
    for p in parts:
        s = (s * M_STREAM + int(p) + 1) % P
    return s


def stream_sql(base: int, part_sql: str, dialect: str = "spark") -> str:
    """SQL for ``stream(..., part)`` when the last part (>= 0) is a column/lambda."""
    v = f"CAST({int(base)} AS BIGINT) * {M_STREAM} + ({part_sql}) + 1"
    return f"pmod({v}, {P})" if dialect == "spark" else f"(({v}) % {P})"


def hash_uniform_sql(stream_sql: str, id_sql: str, dialect: str = "spark") -> str:
    """SQL text of a uniform draw in (0, 1) for ``(stream, id)``."""
    spark = dialect == "spark"
    v = f"CAST({id_sql} AS BIGINT)"
    low, high = f"({v} & {LOW})", f"shiftright({v}, 30)" if spark else f"({v} >> 30)"
    num = "{}D" if spark else "CAST({} AS DOUBLE)"

    def mix(m: int, a1: int, b1: int, a2: int, b2: int) -> str:
        def mod(e: str) -> str:
            return f"pmod({e}, {m})" if spark else f"((({e}) % {m} + {m}) % {m})"

        h1 = mod(f"{low} * {a1} + ({stream_sql})")
        h2 = mod(f"{h1} * {h1} + {b1}")
        h3 = mod(f"{h2} * {a2} + {mod(high)}")
        return mod(f"{h3} * {h3} + {b2}")

    x, y = (f"CAST({mix(*c)} AS DOUBLE)" for c in MIXES)
    draw = f"(({x} + ({y} + {num.format('0.5')}) / {num.format(f'{Q}.0')}) / {num.format(f'{P}.0')})"
    return f"least({draw}, {num.format(repr(TOP))})"


def hash_uniform(stream_no: int, id_col: str) -> Column:
    return F.expr(hash_uniform_sql(str(int(stream_no)), id_col))


def np_hash_uniform(stream_no: int, ids: np.ndarray) -> np.ndarray:
    """NumPy twin of :func:`hash_uniform_sql` (same bits)."""
    ids = np.asarray(ids, dtype=np.int64)
    low, high = ids & LOW, ids >> 30
    mixed = []
    for m, a1, b1, a2, b2 in MIXES:
        h = (low * a1 + int(stream_no)) % m
        h = (h * h + b1) % m
        h = (h * a2 + high % m) % m
        mixed.append(((h * h + b2) % m).astype(np.float64))
    return np.minimum((mixed[0] + (mixed[1] + 0.5) / float(Q)) / float(P), TOP)


def normal_sql(u1_sql: str, u2_sql: str, dialect: str = "spark") -> str:
    """Standard normal draw by Box-Muller from two uniforms."""
    two = "2.0D" if dialect == "spark" else "2.0"
    return f"(sqrt(-{two} * ln({u1_sql})) * cos({two} * pi() * {u2_sql}))"
