"""Collocations: phrases that stand together more often than their parts.

Every word begins a suffix.  Suffixes are cut at each length up to the longest
phrase, counted once within a shard, and routed by a hash of their leading
words, so that all that are equal meet in one group.  There, suffix pointers go
through a multikey three-way quicksort (one word of the suffix at a time):
parts lighter than the least count are abandoned at once, and what is left of a
part at full depth is one phrase, its weight the phrase's count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, map_batches, text_or_empty

#: Bytes of text in a shard, and of text for which one group of suffixes of
#: each length and language is made.
SHARD_BYTES = 8 << 20
GROUP_BYTES = 4 << 20
#: Parts of at most so many pointers are finished by a plain sort.
SMALL = 24

#: Fixed value: A-Z lower-cased; `.,;:!?` and 0x0A-0x0D end a piece (here all
#: as \n); a tab separates words as a space does.
FOLD = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


class Numbers(dict):
    """Numbers words from 1 on as they come; 0 ends a piece, -1 is no word."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 1
        return number


def distinct_suffixes(row: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length: where each distinct suffix of that length first stands in
    ``row`` (0: end of a piece), and how often it does."""
    at = np.flatnonzero(row)
    code = np.zeros(len(at), np.int64)
    for size in range(1, longest + 1):
        last = at + size - 1
        inside = last < len(row)
        inside[inside] = row[last[inside]] > 0
        at, code = at[inside], code[inside]
        if not len(at):
            return
        _, first, code, count = np.unique(code << 32 | row[at + size - 1], return_index=True, return_inverse=True, return_counts=True)
        yield size, at[first], count


def frequent(words: np.ndarray, width: int, weight: np.ndarray, least: int) -> tuple[list[int], list[int]]:
    """Suffixes (rows of ``width`` words) of at least ``least`` weight in all:
    a pointer to one of each, and the weight.

    Multikey three-way quicksort: a part is split by its pivot's word at the
    part's depth into those below, equal and above; the equal ones go on with
    the next word.  Leading words route the pointers to slots first, and the
    slots that are too light are abandoned before the sort."""
    pointer = np.arange(len(weight), dtype=np.int64) * width
    slots = 1 << max(4, int(4 * len(weight)).bit_length())
    lead = words[pointer].astype(np.int64)
    if width > 1:
        lead = lead * 0x9E3779B1 + words[pointer + 1]
    slot = (lead ^ lead >> 17) & (slots - 1)
    held = np.bincount(slot, weights=weight, minlength=slots)[slot] >= least
    found, totals = [], []
    parts = [(pointer[held], weight[held], 0)]
    while parts:
        own, mass, depth = parts.pop()
        if int(mass.sum()) < least:
            continue
        if depth == width:
            found.append(int(own[0]))
            totals.append(int(mass.sum()))
            continue
        if len(own) <= SMALL:
            tails = sorted(zip(*(words[own + j].tolist() for j in range(depth, width)), own.tolist(), mass.tolist(), strict=True))
            begin = 0
            for i in range(1, len(tails) + 1):
                if i == len(tails) or tails[i][:-2] != tails[begin][:-2]:
                    if (total := sum(t[-1] for t in tails[begin:i])) >= least:
                        found.append(tails[begin][-2])
                        totals.append(total)
                    begin = i
            continue
        word = words[own + depth]
        pivot = sorted((word[0], word[len(word) // 2], word[-1]))[1]
        for side, deeper in ((word < pivot, 0), (word == pivot, 1), (word > pivot, 0)):
            if side.any():
                parts.append((own[side], mass[side], depth + deeper))
    return found, totals


def counts(docs: DataFrame, longest: int = 3, least: int = 10, lang_col: str = "lang", text_col: str = "text",
           shard_bytes: int = SHARD_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``(lang, m, phrase, a)``: phrases of ``m`` words, 1 to ``longest``, that
    occur ``least`` times or more in the texts of a language; with ``m = 0``
    and no phrase, the number of all words (several rows a language, to be added).

    A null text is empty, a null language ``und``.  A suffix crosses the network
    once per shard and length whatever its frequency, so a word, pair or
    passage that fills the corpus makes no large group; the number of groups
    follows the measured size of the texts."""
    own = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).cast("binary").alias("t"))
    size = own.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    groups = max(1, int(size) // group_bytes)
    blocks = T.StructType([T.StructField("lang", T.StringType()), T.StructField("m", T.IntegerType()), T.StructField("route", T.LongType()),
                           T.StructField("words", T.BinaryType()), T.StructField("n", T.BinaryType())])

    def routed(lang: str, number: Numbers, row: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = list(number)[1:]
        names[0] = b""
        mark = np.array([zlib.crc32(w) for w in names], np.uint64)
        for m, at, count in distinct_suffixes(row, longest):
            route = np.zeros(len(at), np.uint64)
            for j in range(m):
                route = (route ^ mark[row[at + j]]) * np.uint64(0x9E3779B97F4A7C15)
            route = ((route >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(route, kind="stable")
            at, count, route = at[order], count[order].astype("<i4"), route[order]
            edges = np.flatnonzero(np.diff(route, prepend=-1))
            out: list[list] = [[], []]
            for begin, end in zip(edges, [*edges[1:], len(at)], strict=True):
                flat = (at[begin:end, None] + np.arange(m)).ravel()
                out[0].append(b" ".join(map(names.__getitem__, row[flat].tolist())))
                out[1].append(count[begin:end].tobytes())
            k = len(edges)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * k), pa.array([m] * k, pa.int32()), pa.array(route[edges]), *(pa.array(c, pa.binary()) for c in out)], names=blocks.fieldNames())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def flush():
            for lang, (number, rows) in held.items():
                yield from routed(lang, number, np.concatenate(rows))

        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                number, rows = held.setdefault(lang, (Numbers(), []))
                words = raw.translate(FOLD).replace(b"\n", b" \n ").split(b" ")
                row = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                rows += row[row >= 0], np.zeros(1, np.int64)
                size += len(raw)
                if size >= shard_bytes:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    def merged(key: tuple, group: pa.Table) -> pa.Table:
        lang, m = key[0].as_py(), key[1].as_py()
        tokens = b" ".join(group.column("words").to_pylist()).split(b" ")
        number = Numbers()
        words = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        weight = np.frombuffer(b"".join(group.column("n").to_pylist()), "<i4").astype(np.int64)
        found, totals = frequent(words, m, weight, least)
        phrases = [b" ".join(tokens[p:p + m]).decode(errors="replace") for p in found]
        sizes = [m] * len(found)
        if m == 1:
            phrases, sizes, totals = [*phrases, None], [*sizes, 0], [*totals, int(weight.sum())]
        return pa.table({"lang": pa.array([lang] * len(sizes), pa.string()), "m": pa.array(sizes, pa.int32()), "phrase": pa.array(phrases, pa.string()), "a": pa.array(totals, pa.int64())})

    parts = map_batches(own, split, blocks)
    return parts.groupBy("lang", "m", "route").applyInArrow(merged, "lang string, m int, phrase string, a long")


def mine(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, inside_percent: int = 50, **names) -> DataFrame:
    """The ``top`` collocations of each language.

    A candidate is a phrase of 2 to ``longest`` words that occurs ``a >= least``
    times.  Cut after its first k words it scores ``floor(10^6 a a / (l r))``
    with the counts of both parts; its lowest cut counts (ties: the smallest
    k).  A candidate is dropped if it lies inside a longer one that occurs at
    least ``inside_percent`` of 100 times as often.  Result: ``lang``, ``rank``, ``phrase``,
    ``a``, ``l``, ``r``, ``n`` (all words of the language), ``score``, by score
    and ``a`` descending, then the phrase in byte order.  No text, no rows."""
    found = cut(counts(docs, longest, least, **names), "phrases")
    parts = found.where("m > 0").select("lang", "phrase", "m", "a")
    candidates = parts.where("m > 1")
    cuts = (candidates.withColumn("k", F.explode(F.expr("sequence(1, m - 1)")))
            .withColumn("_left", F.expr("substring_index(phrase, ' ', k)")).withColumn("_right", F.expr("substring_index(phrase, ' ', k - m)")))
    left = parts.select("lang", F.col("phrase").alias("_left"), F.col("a").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("_right"), F.col("a").alias("r"))
    wide = "cast({} as decimal(19,0))".format
    score = F.expr(f"cast(1000000 as decimal(7,0)) * {wide('a')} * {wide('a')} div ({wide('l')} * {wide('r')})")
    scored = (cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_c")))
    word = F.split("phrase", " ")
    inner = (candidates.where("m > 2").withColumn("_w", word)
             .withColumn("_size", F.explode(F.expr("sequence(2, m - 1)"))).withColumn("_from", F.explode(F.expr("sequence(1, m - _size + 1)")))
             .select("lang", F.array_join(F.slice("_w", F.col("_from"), F.col("_size")), " ").alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("_longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < inside_percent * F.col("a")))
            .select("lang", "phrase", "a", "_c.l", "_c.r", "_c.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's rows are ranked by parts first, then the parts' best
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = (kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(spread)))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top))
    total = found.where("m = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
