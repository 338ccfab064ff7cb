"""Plain-Python versions that the operators are tested against."""

from __future__ import annotations

import re

import xxhash

DIR1, DIR2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LONG = "long words here. " * 20_000

#: Nulls in any column, empty and very long texts, ties, repeated rows.
EDGE = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "One line of text.\nAnother line of it.", "en", None, 36),
    (3, "One line of text.\nAnother line of it.", "en", None, 36), (None, "a text without an id", None, "b", 20),
    (None, None, None, None, None), (5, LONG, "de", "b", len(LONG)), (6, "\n\n \t\n", "de", "b", 5),
    (7, "One line of text.\nAnother line of it.", "fr", "c", 36), (8, "é́ 日本語 👩‍👩‍👧 ＡＢＣ", "xx", "c", 20), (9, "!!! ### 123", None, "c", 11),
]
#: Extra columns whose names operators use themselves.
CLASH = ["id", "at", "n", "key", "node", "root", "score", "kept", "copies", "target", "size", "fp", "lanes", "part", "hits", "side", "body", "line", "_s", "_id", "_drop", "stratum"]


def edge(spark, rows=EDGE):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASH})


def empty(spark):
    return edge(spark, [])


def documents(spark, sf=DIR1):
    return spark.read.parquet(f"{sf}/documents.parquet")


class Groups(dict):
    """Union-find over what it is asked for; the smallest member is the root."""

    def root(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def tie(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self[b] = a


def doc_fingerprint(text: str | None, size: int = 4) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def edits(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, start=1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, start=1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
