"""SimHash near-duplicate classes over whole documents.

Fingerprints (64 bits, majority of the shingles' XXH64 bits) are embedded by
their bit counts per segment: with segments of two bits, writing each count in
unary (0: 00, 1: 01, 2: 11) gives a 64-bit word whose bit differences are the
Manhattan distance between the count vectors, and that distance is a lower
bound of the fingerprints' bit distance.  The 32 segments form ``distance + 2``
blocks.  Count vectors within the distance agree on at least two whole blocks,
so both lie in one cell of the grid spanned by some pair of blocks: a join on
(pair, cell) finds every pair within range, is narrowed by the Manhattan
distance, and verified by the exact bit distance.  Before that, fingerprints
that share a half with the first one of that half are tied to it where near, so
a dense group of near copies is linked in a line, not pair by pair; the join
leaves out pairs that are tied already.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, map_batches, text_or_empty
from .components import components

SEGMENTS = 32  # of two bits each
#: Shingles hashed at a time, so that a very long text needs bounded memory.
CHUNK = 1 << 16


def simhash_text(text: str, size: int) -> int:
    """The fingerprint as an unsigned integer; no words: zero."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    n = max(len(words) - size + 1, min(len(words), 1))
    if not n:
        return 0
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    begin = np.concatenate(([0], ends[:-1]))[:n].tolist()
    end = (ends[min(size, len(words)) - 1:] - 1).tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for k in range(0, n, CHUNK):
        raw = b"".join([digest(line[i:j], 42) for i, j in zip(begin[k:k + CHUNK], end[k:k + CHUNK])])
        ones += np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fp)``, ``fp`` the fingerprint as a signed long."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash_text(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=schema.names)

    return map_batches(docs.select(F.col(id_col), text_or_empty(text_col)), run, schema)


def _mask(segments: range) -> int:
    bits = sum(3 << (2 * s) for s in segments)
    return bits - (1 << 64) if bits >> 63 else bits


def unary_counts(fp: Column) -> Column:
    """Per two-bit segment the bit count in unary."""
    low = F.lit(0x5555555555555555)
    x, y = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    return x.bitwiseOR(y).bitwiseOR(F.shiftleft(x.bitwiseAND(y), 1))


def leader_pairs(fps: DataFrame, distance: int) -> DataFrame:
    """Pairs ``(a, b)`` of each distinct fingerprint with the smallest one that
    has the same half, if near.  At most two pairs a fingerprint."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    cells = fps.select("fp", F.explode(F.array(F.shiftrightunsigned("fp", 32), low.bitwiseOR(F.lit(1 << 32)))).alias("cell"))
    leaders = cells.groupBy("cell").agg(F.min("fp").alias("a"))
    return (cells.join(leaders, "cell").where((F.col("a") != F.col("fp")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= distance))
            .select("a", F.col("fp").alias("b")))


def near_pairs(fps: DataFrame, distance: int) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of distinct fingerprints (column ``fp``)
    at most ``distance`` bits apart, but for those of one known group (a column
    ``root``, where there is one); a pair may come more than once.  A
    fingerprint has a bounded number of such partners whatever the input."""
    if "root" not in fps.columns:
        fps = fps.withColumn("root", F.lit(None).cast("long"))
    blocks = distance + 2
    edge = [SEGMENTS * k // blocks for k in range(blocks + 1)]
    masks = [_mask(range(edge[k], edge[k + 1])) for k in range(blocks)]
    cells = [F.struct(F.lit(n).alias("grid"), F.col("counts").bitwiseAND(F.lit(masks[i] | masks[j])).alias("cell"))
             for n, (i, j) in enumerate(combinations(range(blocks), 2))]
    at = (fps.select("fp", "root", unary_counts(F.col("fp")).alias("counts"))
          .select("fp", "root", "counts", F.explode(F.array(*cells)).alias("at")).select("fp", "root", "counts", "at.*"))
    x, y = at.alias("x"), at.alias("y")
    return x.join(y, (F.col("x.grid") == F.col("y.grid")) & (F.col("x.cell") == F.col("y.cell"))
                  & (F.col("x.fp") < F.col("y.fp")) & ~F.coalesce(F.col("x.root") == F.col("y.root"), F.lit(False))
                  & (F.bit_count(F.col("x.counts").bitwiseXOR(F.col("y.counts"))) <= distance)
                  & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= distance)
                  ).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))


def near_classes(docs: DataFrame, shingle: int = 4, distance: int = 4,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fp, component_id)`` for every row: its fingerprint and the
    smallest id reachable over links of at most ``distance`` bits.

    Texts without words (empty, null) have fingerprint zero and link like any
    other.  Copies collapse to their fingerprint before any join, so a group of
    copies costs one row.  Repeated ids keep their rows.  A null id counts only
    where its class has no other id (``component_id`` is then null).
    """
    own = cut(fingerprints(docs, shingle, id_col, text_col), "simhash")
    fps = cut(own.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-distinct")
    tied = cut(leader_pairs(fps, distance), "simhash-tied")
    known = components(tied, name="simhash-cc").select(F.col("node").alias("fp"), "root")
    more = near_pairs(fps.select("fp").join(known, "fp", "left"), distance)
    root = components(tied.union(more), name="simhash-cc").select(F.col("node").alias("fp"), "root")
    root = fps.join(root, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = root.groupBy("root").agg(F.min("least").alias("component_id"))
    of = root.join(smallest, "root").select("fp", "component_id")
    return own.join(of, "fp").select(id_col, "fp", "component_id")
