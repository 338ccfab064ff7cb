"""Benchmark passages in documents, found by suffix arrays of the documents.

The documents are cut into shards of whole documents.  Each shard gets a suffix
array over its words, and every suffix of every benchmark item is searched in
it by bisection: where its first words lie, how far the longest match goes, and
where.  A document stands whole in one shard, so a shard's findings about it
are final, and nothing but the findings leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, map_batches, text_or_empty

#: Bytes of text in a shard (a longer document is a shard of its own) and of
#: benchmark text that is sent to the tasks at once.
SHARD_BYTES = 8 << 20
BENCH_BYTES = 16 << 20

#: Fixed value: words are runs of digits, letters and bytes beyond ASCII, with
#: A-Z lower-cased; all else separates them.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


class Numbers(dict):
    """Numbers words from 1 on as they come; 0 ends a document."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


def suffix_array(words: np.ndarray, vocabulary: int, depth: int) -> np.ndarray:
    """Positions of ``words`` in the order of their suffixes' first ``depth``
    numbers at least, by prefix doubling: the first sort takes as many words
    as fit 63 bits, and each later one sorts only what is tied."""
    size = len(words)
    bits = max(1, int(vocabulary).bit_length())
    done = max(1, min(depth, 63 // bits))
    padded = np.concatenate([words.astype(np.int64), np.zeros(done, np.int64)])
    key = padded[:size].copy()
    for j in range(1, done):
        key <<= bits
        key |= padded[j:size + j]
    order = np.argsort(key)
    new = np.concatenate([[True], np.diff(key[order]) != 0]) if size else np.zeros(0, bool)
    slot = np.arange(size)
    first = np.maximum.accumulate(np.where(new, slot, 0)) if size else slot
    rank = np.zeros(size + 1, np.int64)  # one more: beyond the end, before all
    rank[order] = first + 1
    tied = np.flatnonzero(~new | ~np.concatenate([new[1:], [True]])) if size else slot
    while done < depth and len(tied):
        own = order[tied]
        key = rank[own] << 32 | rank[np.minimum(own + done, size)]
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[tied] = own
        new = np.concatenate([[True], np.diff(key) != 0])
        rank[own] = np.maximum.accumulate(np.where(new, tied, 0)) + 1
        tied = tied[~new | ~np.concatenate([new[1:], [True]])]
        done *= 2
    return order


def _compare(words: np.ndarray, at: np.ndarray, queries: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign of suffix ``at`` against the query (0: it starts with the whole
    query), and how many words agree.  ``words`` ends with a 0."""
    sign, same = np.zeros(len(at), np.int8), np.zeros(len(at), np.int64)
    open_, last = np.arange(len(at)), len(words) - 1
    j = 0
    while len(open_ := open_[size[open_] > j]):
        a, b = words[np.minimum(at[open_] + j, last)], queries[begin[open_] + j]
        equal = a == b
        sign[open_[~equal]] = np.sign(a[~equal] - b[~equal])
        open_ = open_[equal]
        same[open_] += 1
        j += 1
    return sign, same


def bisect(words: np.ndarray, order: np.ndarray, queries: np.ndarray, begin: np.ndarray, size: np.ndarray, after: bool = False) -> np.ndarray:
    """First slot whose suffix isn't below the query (``after``: is above all
    suffixes that start with it), for all queries at once."""
    low, high = np.zeros(len(begin), np.int64), np.full(len(begin), len(order), np.int64)
    while len(live := np.flatnonzero(low < high)):
        middle = (low[live] + high[live]) >> 1
        sign, _ = _compare(words, order[middle], queries, begin[live], size[live])
        right = sign <= 0 if after else sign < 0
        low[live[right]] = middle[right] + 1
        high[live[~right]] = middle[~right]
    return low


@dataclass
class Items:
    """Benchmark texts as word lists, with the distinct windows and whose they are."""

    ids: list            # of the items
    texts: list          # of lists of words
    windows: list        # distinct word tuples
    item_of: np.ndarray  # of each (window, item) pair, by window
    starts: np.ndarray   # where a window's pairs begin

    @staticmethod
    def of(rows: list[tuple], window: int) -> Items:
        ids = sorted({r[0] for r in rows}, key=lambda i: (i is not None, i))
        place, owners, texts = {k: n for n, k in enumerate(ids)}, {}, []
        for key, raw in rows:
            words = words_of(raw)
            texts.append((place[key], words))
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[i:i + window]), set()).add(place[key])
        counts = [len(o) for o in owners.values()]
        return Items(ids, texts, list(owners), np.array([i for o in owners.values() for i in sorted(o)], np.int64), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))

    def numbered(self, number: dict, lists: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat word numbers of ``lists`` with begins and sizes; -1: not in the shard."""
        size = np.array([len(x) for x in lists], np.int64)
        get = number.get
        flat = np.array([get(w, -1) for x in lists for w in x], np.int64)
        return flat, np.cumsum(size) - size, size


class Shard:
    """Whole documents as one row of word numbers, a 0 after each."""

    def __init__(self, texts: list[bytes], depth: int):
        self.number = Numbers()
        rows = []
        self.size = np.zeros(len(texts), np.int64)
        for i, raw in enumerate(texts):
            words = words_of(raw)
            self.size[i] = len(words)
            rows += np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)
        self.words = np.concatenate([*rows, np.zeros(1, np.int32)])
        self.start = np.cumsum(self.size + 1) - self.size - 1
        self.order = suffix_array(self.words, len(self.number), depth)

    def place(self, at: np.ndarray) -> np.ndarray:
        """Which document a position is in."""
        return np.searchsorted(self.start, at, side="right") - 1


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... count[0] of them, then those of the next."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _hits(shard: Shard, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Difference array of hit words; documents and items that share a window."""
    flat, begin, size = items.numbered(shard.number, items.windows)
    there = np.flatnonzero(np.minimum.reduceat(flat, begin) > 0) if len(begin) else begin
    low = bisect(shard.words, shard.order, flat, begin[there], size[there])
    high = bisect(shard.words, shard.order, flat, begin[there], size[there], after=True)
    found = high - low
    at, window = shard.order[_spread(low, found)], np.repeat(there, found)
    edge = np.zeros(len(shard.words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size[window], -1)
    pairs = np.unique(shard.place(at) * max(1, len(items.windows)) + window)
    doc, window = np.divmod(pairs, max(1, len(items.windows)))
    owned = items.starts[window + 1] - items.starts[window]
    both = np.unique(np.repeat(doc, owned) * max(1, len(items.ids)) + items.item_of[_spread(items.starts[window], owned)])
    return edge, *np.divmod(both, max(1, len(items.ids)))


def _chunks(bench: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    """The benchmark's rows, about ``most`` bytes of text at a time: parts by a
    hash, as many as its measured size asks for (a single text is never cut)."""
    own = bench.select(F.col(id_col).alias("i"), text_or_empty(text_col).cast("binary").alias("t"))
    total = own.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(1, -(-int(total) // most))
    part = own.withColumn("p", F.pmod(F.xxhash64("i", "t"), F.lit(parts)))
    for p in range(parts):
        yield [(r["i"], bytes(r["t"])) for r in part.where(F.col("p") == p).collect()]


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        at, ends = 0, np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0)))
        while at < batch.num_rows:
            # up to the document that fills the shard
            last = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most - size)) + 1
            piece = batch.slice(at, min(last, batch.num_rows) - at)
            held.append(piece)
            size += int(ends[at + piece.num_rows - 1] - (ends[at - 1] if at else 0))
            at += piece.num_rows
            if size >= most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if size or held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()[:1]


def find(docs: DataFrame, bench: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", shard_bytes: int = SHARD_BYTES, bench_bytes: int = BENCH_BYTES) -> DataFrame:
    """Which words of a document lie in a passage of ``window`` words that a
    benchmark item holds too, and which items these are.

    An item of fewer words, but not none, is one passage.  Result, one row per
    document row: ``id_col``, ``n_words``, ``spans`` (array of start and
    n_words, the runs of hit words) and ``items`` (ids as strings, distinct,
    ascending; a null id is the empty string).  Null and empty texts have no
    words; items that share an id are one item; repeated rows each get a row.

    The documents are read once and never shuffled.  Benchmark text goes to the
    tasks in parts of ``bench_bytes``; a larger benchmark takes one pass over
    the documents for each part, and the findings are carried from pass to pass.
    """
    spark = docs.sparkSession
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("n_words", T.IntegerType())]))
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_t", T.BinaryType()), T.StructField("n_words", T.LongType()),
                           T.StructField("spans", span), T.StructField("items", T.ArrayType(T.StringType()))])
    state = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).cast("binary").alias("_t"), F.lit(0).cast("long").alias("n_words"),
                        F.array().cast(span).alias("spans"), F.array().cast("array<string>").alias("items"))
    kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32())])), pa.list_(pa.string())]
    chunks = list(_chunks(bench, item_col, item_text, bench_bytes)) if bench_bytes else []
    for n, rows in enumerate(chunks):
        items = Items.of(rows, window)
        held = spark.sparkContext.broadcast(items)
        final = n + 1 == len(chunks)  # texts are not needed any more

        def run(batches: Iterator[pa.RecordBatch], held=held, final=final) -> Iterator[pa.RecordBatch]:
            items = held.value
            names = ["" if i is None else str(i) for i in items.ids]
            for batch in _shards(batches, shard_bytes):
                texts = batch.column(1).to_pylist()
                shard = Shard(texts, window)
                edge, doc, item = _hits(shard, items)
                for i, old in enumerate(batch.column(3).to_pylist()):
                    for s in old:
                        edge[shard.start[i] + s["start"]] += 1
                        edge[shard.start[i] + s["start"] + s["n_words"]] -= 1
                hit = np.diff((np.cumsum(edge) > 0).astype(np.int8), prepend=0)
                begin, end = np.flatnonzero(hit > 0), np.flatnonzero(hit < 0)
                spans: list[list] = [[] for _ in texts]
                for d, a, b in zip(shard.place(begin).tolist(), begin.tolist(), end.tolist(), strict=True):
                    spans[d].append({"start": a - int(shard.start[d]), "n_words": b - a})
                found = batch.column(4).to_pylist()
                for d, i in zip(doc.tolist(), item.tolist(), strict=True):
                    found[d].append(names[i])
                found = [sorted(set(x)) for x in found]
                texts = pa.nulls(len(texts), pa.binary()) if final else batch.column(1)
                yield pa.RecordBatch.from_arrays([batch.column(0), texts, *(pa.array(c, type=k) for c, k in zip((shard.size, spans, found), kinds, strict=True))], names=[f.name for f in schema.fields])

        state = map_batches(state, run, schema)
        if not final:
            state = cut(state, "decontaminate")
    return state.select(F.col("_id").alias(id_col), "n_words", "spans", "items")


def remove(docs: DataFrame, bench: DataFrame, window: int = 10, **names) -> DataFrame:
    """The documents (all their columns) that share no passage with the benchmark."""
    row = F.struct(*docs.columns)
    found = find(docs.select(row.alias("_row"), F.col(names.get("text_col", "text")).alias("text")), bench, window,
                 **{**names, "id_col": "_row", "text_col": "text"})
    return found.where(F.size("items") == 0).select("_row.*")


def longest(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text: str = "text", shard_bytes: int = SHARD_BYTES, bench_bytes: int = BENCH_BYTES) -> DataFrame:
    """The longest verbatim match of every suffix of every item, and where.

    Result, one row per item and word of it that any document holds:
    ``item_col``, ``item_start``, ``n_words`` (of the match), ``id_col`` and
    ``start`` (the document and its word where the match begins; of equally
    long ones the smallest id, null last, then the smallest start).  Each
    shard sends one row per suffix at most; Spark takes the best of them.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_start", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("doc", kind), T.StructField("start", T.LongType())])
    arrow = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).cast("binary").alias("_t"))
    out = None
    for rows in _chunks(bench, item_col, item_text, bench_bytes):
        items = Items.of(rows, 1)
        held = spark.sparkContext.broadcast(items.texts)
        names = spark.createDataFrame(list(enumerate(items.ids)), T.StructType([T.StructField("item", T.LongType()), T.StructField(item_col, bench.schema[item_col].dataType)]))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            texts = [w for _, w in held.value]
            depth = max(map(len, texts), default=1)
            sizes = np.array([len(w) for w in texts], np.int64)
            item = np.repeat(np.array([i for i, _ in held.value], np.int64), sizes)
            for batch in _shards(batches, shard_bytes):
                shard = Shard(batch.column(1).to_pylist(), depth)
                flat, begin, size = Items.numbered(None, shard.number, texts)
                at = np.arange(len(flat))
                left = np.repeat(begin + size, size) - at
                slot = bisect(shard.words, shard.order, flat, at, left)
                best, where = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                for near in (slot - 1, slot):
                    place = shard.order[np.clip(near, 0, len(shard.order) - 1)]
                    _, same = _compare(shard.words, place, flat, at, left)
                    better = same > best
                    best[better], where[better] = same[better], place[better]
                some = np.flatnonzero(best)
                # of all places of the longest match, the smallest document
                low = bisect(shard.words, shard.order, flat, at[some], best[some])
                high = bisect(shard.words, shard.order, flat, at[some], best[some], after=True)
                rank = pa.compute.rank(batch.column(0), null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
                doc = shard.place(shard.order)
                key = np.append(rank[doc] << 32 | (shard.order - shard.start[doc]), 0)
                ranges, which = np.unique(np.stack([low, high], axis=1), axis=0, return_inverse=True)
                least = np.minimum.reduceat(key, ranges.ravel())[::2][which.ravel()] if len(some) else low
                back = np.zeros(len(rank) + 2, np.int64)
                back[rank] = np.arange(len(rank))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item[some]), pa.array(at[some] - np.repeat(begin, size)[some]), pa.array(best[some]),
                     batch.column(0).take(pa.array(back[least >> 32])), pa.array(least & 0xFFFFFFFF)], names=schema.fieldNames())

        found = map_batches(arrow, run, schema)
        order = F.struct((-F.col("n_words")).alias("l"), F.col("doc").isNull().alias("none"), "doc", "start")
        best = F.min_by(F.struct("n_words", "doc", "start"), order)
        part = (found.groupBy("item", "item_start").agg(best.alias("b")).join(F.broadcast(names), "item")
                .select(item_col, "item_start", "b.n_words", F.col("b.doc").alias(id_col), "b.start"))
        out = part if out is None else out.unionByName(part)
    return out
