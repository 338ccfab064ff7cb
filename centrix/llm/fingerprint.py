"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A document is the multiset of its paragraphs (split at line feeds).  Each
paragraph is hashed to a wide vector, and a document's fingerprint is the sum
of its paragraphs' vectors, lane by lane modulo 2^32.  So the order of the
paragraphs doesn't matter, inserting a paragraph adds its vector, deleting one
subtracts it (``combine``), and equal multisets have equal fingerprints.

The vector has two parts: ``EXACT`` lanes cut from the paragraph's SHA-512
(equality; an accidental match needs all 512 bits to agree), and ``LANES`` + 1
lanes that count, over the paragraph's word pairs, the ones in each bit of
their 64-bit hash, and the pairs themselves.  Counts are sums too, and their
excess of ones over zeros is a random projection of the pairs' multiset, so
the cosine of two such vectors estimates how alike two documents are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, maybe_in, text_or_empty

EXACT, LANES = 16, 64
MODULUS = 1 << 32


def _sums(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` (each once) plus ``lanes`` (array of EXACT + LANES + 1 sums,
    modulo 2^32).  Two counts of ones are summed in one 64-bit number: a text has
    fewer than 2^31 word pairs."""
    par = texts.select(*keys, F.explode(F.split(text_col, "\n")).alias("par"))
    par = par.select(*keys, F.sha2("par", 512).alias("digest"),
                     F.filter(F.split("par", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w"))
    pairs = F.when(F.size("w") < 2, F.transform("w", lambda a: F.xxhash64(a))).otherwise(
        F.zip_with(F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"), lambda a, b: F.xxhash64(a, b)))
    one = par.select(*keys, "digest", F.posexplode_outer(pairs).alias("at", "h"))
    first = F.coalesce("at", F.lit(0)) == 0
    exact = [F.sum(F.when(first, F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long")).otherwise(0)).alias(f"x{k}")
             for k in range(EXACT)]
    half = LANES // 2
    ones = [F.sum(F.coalesce(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(1 << 32 | 1)), F.lit(0))).alias(f"b{k}") for k in range(half)]
    total = one.groupBy(*keys).agg(*exact, *ones, F.count("h").alias("_pairs"))
    lanes = [F.col(f"x{k}").bitwiseAND(F.lit(MODULUS - 1)) for k in range(EXACT)]
    lanes += [F.col(f"b{k}").bitwiseAND(F.lit(MODULUS - 1)) for k in range(half)] + [F.shiftrightunsigned(f"b{k}", 32) for k in range(half)]
    return total.select(*keys, F.array(*lanes, F.col("_pairs").bitwiseAND(F.lit(MODULUS - 1))).alias("lanes"))


def _once(d: DataFrame, rows: DataFrame) -> DataFrame:
    """``d`` (id, text_sha256, n, body) with repeated rows once; ``rows`` tells
    which ids have any.  Only their texts are shuffled."""
    again = cut(rows.where("count > 1").select("id").distinct(), "repeated-rows")
    some = maybe_in(d, "id", again, "id").groupBy("id", "text_sha256").agg(F.first("n").alias("n"), F.first("body").alias("body"))
    return maybe_in(d, "id", again, "id", others=True).union(some)


def as_text(lanes: Column) -> Column:
    """The fingerprint as lowercase hex, eight digits a lane."""
    return F.lower(F.array_join(F.transform(lanes, lambda v: F.lpad(F.hex(v), 8, "0")), ""))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes after inserting (``sign`` 1) or deleting (-1) a multiset's lanes."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y * F.lit(sign).cast("long"), F.lit(MODULUS)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of the two documents' excesses, not below 0; 1 for
    equal lanes."""
    def excess(v: Column) -> Column:
        n = F.element_at(v, EXACT + LANES + 1)
        return F.transform(F.slice(v, EXACT + 1, LANES), lambda c: (c * 2 - n).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    x, y = excess(a), excess(b)
    cosine = dot(x, y) / F.sqrt(F.nullif(dot(x, x) * dot(y, y), F.lit(0.0)))
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(cosine, F.lit(0.0)))))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(id, text_sha256, n, body)`` of all rows, and ``(id, text_sha256, n, count)``;
    hashes are bytes here."""
    d = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body"))
    d = d.select("id", F.unhex(F.sha2("body", 256)).alias("text_sha256"), F.length("body").cast("long").alias("n"), "body")
    return d, cut(d.groupBy("id", "text_sha256", "n").count(), "fingerprint-rows")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, text_sha256, lanes)``, one row per distinct id and text.

    A null text counts as empty; a text without words has its paragraphs'
    exact lanes and no word pairs.
    """
    d, rows = _rows(docs, id_col, text_col)
    made = _sums(_once(d, rows), ["id", "text_sha256"], "body")
    return made.select(F.col("id").alias(id_col), F.lower(F.hex("text_sha256")).alias("text_sha256"), "lanes")


def successors(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, next)`` for every distinct id: the next larger id, and the
    smallest after the largest; nulls count as smallest.

    Ids are dealt by range; only the first id of each range crosses ranges.
    """
    ids = docs.select(F.col(id_col).alias("id")).distinct()
    dealt = cut(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "id-ranges")
    first = dealt.groupBy("part").agg(F.min(F.struct("id")).alias("f"))  # one row a range
    after = first.select("part", F.lead("f").over(Window.orderBy("part")).alias("over"),
                         F.min("f").over(Window.partitionBy()).alias("start"))
    order = Window.partitionBy("part").orderBy("id")
    return (dealt.withColumn("following", F.lead(F.struct("id")).over(order)).join(F.broadcast(after), "part")
            .select("id", F.coalesce("following", "over", "start")["id"].alias("next")))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, and compare.

    The edited text replaces the last floor(n / 2) code points by the first as
    many (or all) of the next document by ascending id (after the last: the
    first).  Per row: ``id_col, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.  Rows that share an id have
    the same next document; where the next id has several rows, it is the one
    with the smallest SHA-256.  A single document is its own next one.  Null
    texts count as empty, a null id as the smallest id.

    A text's own fingerprint is summed where the text is read.  What travels by
    id is each text's first half, which its edited text keeps and which mostly
    holds the start its predecessor asks for; second halves travel only where a
    longer predecessor asks for more.
    """
    d, rows = _rows(docs, id_col, text_col)
    once = _once(d, rows)
    follow = cut(successors(rows, "id"), "successors")
    # per id, what it asks of its next one: of the next one's text with the smallest hash
    size = rows.groupBy("id").agg(F.max(F.expr("n div 2")).alias("need")).withColumnRenamed("id", "to")
    pick = rows.groupBy("id").agg(F.min(F.struct("text_sha256", "n")).alias("p")).select(F.col("id").alias("from"), F.col("p.text_sha256").alias("sha"), F.col("p.n").alias("length"))
    asked = (follow.join(size, follow["id"].eqNullSafe(size["to"])).select("to", "next", "need"))
    asked = cut(asked.join(pick, asked["next"].eqNullSafe(pick["from"])).select("to", "from", "sha", "need", "length"), "asked")

    own = cut(_sums(once, ["id", "text_sha256"], "body"), "fingerprints")
    head = once.select("id", "text_sha256", "n", F.expr("left(body, cast(n - n div 2 as int))").alias("head"))
    # the hash is compared as a range, so that both joins deal the halves by id alone and share that exchange
    given = (head.join(asked, head["id"].eqNullSafe(asked["from"]) & (head["text_sha256"] <= asked["sha"]) & (head["text_sha256"] >= asked["sha"]))
             .select("to", F.expr("left(head, cast(least(need, n) as int))").alias("start")))
    more = cut(asked.where("need > length - length div 2").select("to", F.col("from").alias("mid"), F.col("sha").alias("msha"), F.expr("need - (length - length div 2)").alias("rest")), "asked-more")
    tail = maybe_in(once, "id", more, "mid").select("id", "text_sha256", F.expr("substring(body, cast(n - n div 2 as int) + 1)").alias("tail"))
    added = (tail.join(more, tail["id"].eqNullSafe(more["mid"]) & (tail["text_sha256"] == more["msha"]))
             .select(F.col("to").alias("to2"), F.expr("left(tail, cast(rest as int))").alias("start2")))
    both = head.join(given, head["id"].eqNullSafe(given["to"])).join(added, head["id"].eqNullSafe(added["to2"]), "left")
    text = F.concat("head", F.expr("left(concat(start, coalesce(start2, '')), cast(n div 2 as int))"))
    both = both.select("id", "text_sha256", "n", text.alias("edited")).withColumn("edited_sha256", F.unhex(F.sha2("edited", 256)))
    edited = _sums(both, ["id", "text_sha256", "n", "edited_sha256"], "edited").withColumnsRenamed({"id": "eid", "text_sha256": "etext", "lanes": "elanes"})
    # own lanes meet the next one's by id; of these only the likeness goes on
    given = (own.join(asked, own["id"].eqNullSafe(asked["from"]) & (own["text_sha256"] <= asked["sha"]) & (own["text_sha256"] >= asked["sha"]))
             .select(F.col("to").alias("before"), F.col("lanes").alias("nlanes")))
    near = (own.join(given, own["id"].eqNullSafe(given["before"]))
            .select("id", "text_sha256", "lanes", likeness(F.col("lanes"), F.col("nlanes")).alias("near_next")))
    count = rows.select(F.col("id").alias("cid"), F.col("text_sha256").alias("ctext"), "count")
    out = (near.join(edited, near["id"].eqNullSafe(edited["eid"]) & (F.col("text_sha256") == F.col("etext")))
           .join(count, near["id"].eqNullSafe(count["cid"]) & (F.col("text_sha256") == F.col("ctext")))
           .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int")))))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_chars"), F.lower(F.hex("edited_sha256")).alias("edited_sha256"), as_text(F.col("lanes")).alias("fingerprint"),
                      as_text(F.col("elanes")).alias("edited_fingerprint"),
                      likeness(F.col("lanes"), F.col("elanes")).alias("near_edited"), "near_next")
