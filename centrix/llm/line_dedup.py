"""Fuzzy line deduplication, in DataFrame functions only.

Lines are normalised (lower case, ASCII punctuation and digits dropped) and
hashed; lines of one normal form are one node.  Every node gets a
63-bit SimHash of its words.  SimHashes at most ``distance`` bits apart agree on
two of ``distance + 2`` blocks (pigeonhole), so they share a cell (pair of
blocks, their bits).  In every shared cell the members are first tied to the
cell's leaders, one per band of lengths, where near; a join on the cell then
finds every near pair that isn't tied yet and whose lengths allow it.  Pairs are narrowed by the exact bit
distance and verified by the edit similarity of the lines, in words.  One
occurrence per connected group stays: the first by document id, then by line.
"""

from __future__ import annotations

import math
import string
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, maybe_in, text_or_empty
from .components import components

#: Bits of a SimHash: three are summed per column, 21 bits apart.
COLUMNS, LANES = 21, 3
BITS = COLUMNS * LANES
#: Names of columns that are joined to the documents for a while.
ID, DROP = "__line_dedup_id", "__line_dedup_drop"
#: Capital letters below U+0530 (Latin, Greek, Cyrillic) and their small ones.
_CAPITALS = [c for c in map(chr, range(0x41, 0x530)) if c.lower() != c and len(c.lower()) == 1]
_FROM = "".join(_CAPITALS) + "\t\v\f\r " + string.punctuation + string.digits
_TO = "".join(c.lower() for c in _CAPITALS) + " " * 5
#: What is dropped, as a pattern.
_DROPPED = "[" + "".join("\\" + c for c in string.punctuation) + string.digits + "]+"


def normalised(line: Column) -> Column:
    """Small letters, no ASCII punctuation or digits, trimmed.  ASCII lines take
    patterns, which cost less than a look at each character."""
    plain = F.lower(F.regexp_replace(F.regexp_replace(line, _DROPPED, ""), "[\t\x0b\f\r]", " "))
    return F.trim(F.when(F.octet_length(line) == F.char_length(line), plain).otherwise(F.translate(line, _FROM, _TO)))


def simhash_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, at, node, words, sim)`` of every line with a word: its document
    and number (from 0), the hashes of its normal form, how many words it has,
    and its SimHash.

    Sums are combined per line before the shuffle, so that what is shuffled is
    one row of counts a line, and a line that many documents share is as many
    rows of its own.  Where rows share an id (null is one), equal lines at one
    number are made one before their words are summed; only those rows' text is
    shuffled."""
    keys = ["id", "at", "n1", "n2"]

    def normal(rows: DataFrame) -> DataFrame:
        # normalised before the lines become rows: a filter on a column made later would make it twice
        norm = rows.select("id", F.posexplode(F.transform(F.split("text", "\n"), normalised)).alias("at", "norm")).where("norm <> ''")
        return norm.select("id", "at", F.xxhash64("norm").alias("n1"), F.xxhash64(F.lit("norm"), "norm").alias("n2"), "norm")

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    shared = cut(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "lines-ids")
    once = normal(maybe_in(rows, "id", shared, "id")).groupBy(*keys).agg(F.max("norm").alias("norm"))
    norm = normal(maybe_in(rows, "id", shared, "id", others=True)).union(once)
    words = (norm.select(*keys, F.explode(F.split("norm", " ")).alias("word"))
             .where("word <> ''").select(*keys, F.xxhash64("word").alias("h")))
    spread = F.lit(sum(1 << (COLUMNS * k) for k in range(LANES)))
    sums = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(spread)).alias(f"b{b}") for b in range(COLUMNS)]
    total = words.groupBy(*keys).agg(*sums, F.count("*").alias("words"))
    # all lanes at once: the top bit of a lane is set by more than half the words
    half = (F.lit((1 << (COLUMNS - 1)) - 1) - F.shiftright("words", 1)) * spread
    total = total.withColumn("half", half)
    most = [F.shiftrightunsigned(F.col(f"b{b}") + F.col("half"), COLUMNS - 1).bitwiseAND(spread) for b in range(COLUMNS)]
    sim = reduce(Column.bitwiseOR, [F.shiftleft(m, b) for b, m in enumerate(most)])
    return total.select("id", "at", F.struct("n1", "n2").alias("node"), "words", sim.alias("sim"))


def _masks(distance: int) -> list[int]:
    """The bits of every two of ``distance + 2`` blocks."""
    blocks = distance + 2
    edge = [BITS * k // blocks for k in range(blocks + 1)]
    return [(1 << edge[i + 1]) - (1 << edge[i]) + (1 << edge[j + 1]) - (1 << edge[j]) for i, j in combinations(range(blocks), 2)]


def _cell(sim: Column, n: int, mask: int) -> Column:
    return F.xxhash64(F.lit(n), sim.bitwiseAND(F.lit(mask)))


def spots(nodes: DataFrame) -> DataFrame:
    """``(spot, sim, band, n)``: a spot is a SimHash and a length band, ``n`` its
    nodes."""
    return cut(nodes.groupBy("spot").agg(F.min("sim").alias("sim"), F.min("band").alias("band"), F.count("*").alias("n")), "lines-all-spots")


def shared_cells(every: DataFrame, distance: int) -> DataFrame:
    """``(cell, spot, sim, band)`` of the cells that several spots share.
    SimHashes at most ``distance`` bits apart share a cell: one of ``_masks``
    and its bits.  ``every``: what ``spots`` gives."""
    cells = F.array(*[_cell(F.col("sim"), n, m) for n, m in enumerate(_masks(distance))])
    each = every.select("spot", "sim", "band", F.explode(cells).alias("cell"))
    # few cells repeat: dealt out first, they are counted once, in small tables
    shared = cut(each.select("cell").repartition("cell").groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "lines-cells")
    return cut(maybe_in(each, "cell", shared, "cell").join(shared.hint("shuffle_hash"), "cell").select("cell", "spot", "sim", "band"), "lines-members")


def leader_pairs(nodes: DataFrame, members: DataFrame, several: DataFrame, distance: int) -> DataFrame:
    """Pairs ``(a, b)`` of each node with the first node of its spot, and of
    these with the first nodes of the leading spots of the cell's own and next
    length band, if near.  Linear in the nodes: a dense group of near lines is
    tied together here, so that ``near_nodes`` needn't pair it.  ``several``:
    the spots of more than one node."""
    leads = (members.groupBy("cell", F.col("band").alias("at")).agg(F.min("sim").alias("lead"))
             .withColumn("head", F.xxhash64("lead", "at")))
    asks = members.select("cell", "spot", "sim", F.explode(F.array("band", F.col("band") + 1)).alias("at"))
    near = (asks.join(leads.hint("shuffle_hash"), ["cell", "at"]).where((F.col("spot") != F.col("head")) & (F.bit_count(F.col("sim").bitwiseXOR(F.col("lead"))) <= distance))
            .select("head", "spot").distinct())
    near = cut(near, "lines-heads")
    wanted = several.select("spot").union(near.select("head")).union(near.select("spot"))
    some = cut(maybe_in(nodes.select("spot", "node"), "spot", wanted, "spot"), "lines-some")
    first = cut(some.groupBy("spot").agg(F.min("node").alias("a")), "lines-first")
    same = some.join(first, "spot").where(F.col("node") != F.col("a")).select("a", F.col("node").alias("b"))
    heads = first.select(F.col("spot").alias("head"), "a").join(near, "head")
    return same.union(heads.join(first.select("spot", F.col("a").alias("b")), "spot").select("a", "b"))


def near_nodes(nodes: DataFrame, members: DataFrame, distance: int, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` of nodes with near SimHashes and lengths, without those
    of one known group (column ``root``)."""
    one = (F.min("root") == F.max("root")) & (F.count("root") == F.count("*"))
    known = cut(nodes.groupBy("spot").agg(F.when(one, F.xxhash64(F.min("root"))).alias("known"), F.count("*").alias("n")), "lines-known")
    at = members.join(known.hint("shuffle_hash"), "spot")
    x, y = at.alias("x"), at.alias("y")
    differ = F.col("x.sim").bitwiseXOR(F.col("y.sim"))
    # a pair comes once: in the first of the cells that it shares
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, _cell(F.col("x.sim"), n, m)) for n, m in enumerate(_masks(distance))])
    pairs = x.join(y.hint("shuffle_hash"), (F.col("x.cell") == F.col("y.cell")) & (F.bit_count(differ) <= distance) & (F.col("x.spot") < F.col("y.spot")) & (first == F.col("x.cell"))
                   & (F.abs(F.col("x.band") - F.col("y.band")) <= 1) & ~F.coalesce(F.col("x.known") == F.col("y.known"), F.lit(False))
                   ).select(F.col("x.spot").alias("s"), F.col("y.spot").alias("t")).distinct()
    own = known.where("n > 1 and known is null").select(F.col("spot").alias("s"), F.col("spot").alias("t"))
    pairs = cut(pairs.union(own), "lines-spots")
    a = nodes.select(F.col("spot").alias("s"), F.col("node").alias("a"), F.col("root").alias("ra"), F.col("words").alias("wa"))
    b = nodes.select(F.col("spot").alias("t"), F.col("node").alias("b"), F.col("root").alias("rb"), F.col("words").alias("wb"))
    most = F.floor((1 - F.lit(similarity)) * F.greatest("wa", "wb") + 1e-9)
    some_a = maybe_in(a, "s", pairs, "s").join(pairs, "s").alias("p")
    other = maybe_in(b, "t", pairs, "t").alias("q")
    return some_a.join(other, (F.col("p.t") == F.col("q.t")) & ~F.coalesce(F.col("ra") == F.col("rb"), F.lit(False)) & (F.abs(F.col("wa") - F.col("wb")) <= most)
                       & ((F.col("p.s") != F.col("q.t")) | (F.col("a") < F.col("b")))).select("a", "b")


def word_codes(norm: Column) -> Column:
    """The line as a string of one hashed character (U+0100 to U+D6FF) a word,
    so that character edits are word edits."""
    words = F.filter(F.split(norm, " "), lambda w: w != "")
    code = F.transform(words, lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(0xD600)) + 0x100), 4, "0"))
    return F.decode(F.unhex(F.array_join(code, "")), "UTF-16BE")


def verified(pairs: DataFrame, docs: DataFrame, lines: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """The pairs with an edit similarity (1 - edits / longer length, in words)
    of ``similarity`` or more.  ``lines``: what ``simhash_lines`` gives."""
    wanted = pairs.select("a").union(pairs.select("b")).distinct().select(F.col("a").alias("w"), F.col("a.n1").alias("h"))
    # one place of each node, then those documents only
    place = maybe_in(lines.select("id", "at", "node", F.col("node.n1").alias("n1")), "n1", wanted, "h").join(wanted, F.col("node") == F.col("w"))
    place = cut(place.groupBy("node").agg(F.min(F.struct("id", "at")).alias("p")).select("node", F.col("p.id").alias("pid"), "p.at"), "lines-places")
    some = maybe_in(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", place, "pid")
    # only the lines that are asked for are shuffled
    some = some.select("id", F.posexplode(F.split("text", "\n")).alias("l", "line")).withColumn("key", F.xxhash64("id", "l"))
    some = maybe_in(some, "key", place.select(F.xxhash64("pid", "at").alias("key")), "key")
    text = some.join(place.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("pid")) & (F.col("l") == F.col("at"))).select(
        "node", word_codes(normalised(F.col("line"))).alias("code"))
    # rows that share an id may hold another line at that place: the larger code stands
    text = cut(text.groupBy("node").agg(F.max("code").alias("code")), "lines-near")
    a, b = text.select(F.col("node").alias("a"), F.col("code").alias("x")), text.select(F.col("node").alias("b"), F.col("code").alias("y"))
    both = pairs.join(a, "a").join(b, "b").withColumn("most", F.floor((1 - F.lit(similarity)) * F.greatest(F.length("x"), F.length("y")) + 1e-9).cast("int"))
    near = F.when(F.abs(F.length("x") - F.length("y")) <= F.col("most"), F.expr("levenshtein(x, y, most) >= 0")).otherwise(False)
    return both.where(near).select("a", "b")


def repeats(docs: DataFrame, distance: int = 3, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, drop)``: per document the sorted numbers (from 0) of the lines
    that repeat an earlier one; documents without any are left out."""
    lines = cut(simhash_lines(docs, id_col, text_col), "lines-simhash")
    nodes = cut(lines.groupBy("node").agg(F.count("*").alias("n"), F.max("sim").alias("sim"), F.max("words").alias("words")), "lines-nodes")
    # shorter lines can't have a near partner: not one edit keeps the similarity
    long = nodes.where(F.floor((1 - F.lit(similarity)) * (F.col("words") + 1) + 1e-9) >= 1)

    def links(pairs: DataFrame) -> DataFrame:
        return cut(verified(cut(pairs, "lines-pairs"), docs, lines, similarity, id_col, text_col), "lines-links")

    # lines of that similarity differ by one band of lengths at most
    band = F.floor(F.log(F.col("words").cast("double")) / max(-math.log(similarity), 1e-9)).cast("int")
    long = long.withColumn("band", band).withColumn("spot", F.xxhash64("sim", "band"))
    every = spots(long)
    several = every.where("n > 1")
    members = shared_cells(every, distance)
    tied = links(leader_pairs(long, members, several, distance))
    known = cut(components(tied, name="lines-cc"), "lines-tied").withColumnRenamed("node", "k")
    paired = maybe_in(long, "spot", members.select("spot").union(several.select("spot")), "spot")
    more = links(near_nodes(cut(paired.join(known.hint("shuffle_hash"), F.col("node") == F.col("k"), "left").drop("k"), "lines-paired"), members, distance, similarity))
    stars = known.select(F.col("root").alias("a"), F.col("k").alias("b"))
    group = components(stars.union(more), name="lines-cc").withColumnRenamed("node", "k")
    # only lines that repeat, exactly or nearly, are looked at again
    again = cut(nodes.join(group.hint("shuffle_hash"), F.col("node") == F.col("k"), "left").where("n > 1 or root is not null").select(
        F.col("node").alias("k"), F.col("node.n1").alias("h"), F.coalesce("root", "node").alias("root")), "lines-groups")
    found = maybe_in(lines.select("id", "at", "node", F.col("node.n1").alias("n1")), "n1", again, "h")
    found = cut(found.join(again.hint("shuffle_hash"), F.col("node") == F.col("k")).select("id", "at", "root"), "lines-again")
    keep = found.groupBy("root").agg(F.min(F.struct("id", "at")).alias("first")).select(F.col("root").alias("r"), "first")
    return (found.join(keep.hint("shuffle_hash"), F.col("root") == F.col("r")).where(~F.struct("id", "at").eqNullSafe(F.col("first")))
            .groupBy("id").agg(F.sort_array(F.collect_set("at")).alias("drop")))


def dedup_lines(docs: DataFrame, distance: int = 3, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines removed from ``text_col``, plus ``n_lines``
    and ``n_dropped``.

    Lines of blanks, ASCII digits and punctuation only are never dropped and
    never compared.  A document whose every line repeats keeps its row, with an
    empty text.  A null text stays null, with no lines; texts are processed
    whole.  Rows that share an id count as one document: equal lines at the
    same number in them are one occurrence, and a line dropped from one is
    dropped from all.  A null id sorts first.  Added columns replace input
    columns of the same name.  Copies collapse before any join; what joins
    afterwards are keys, not texts, and a SimHash has a bounded number of
    partners, so no group of copies is paired with itself.
    """
    d = docs.drop("n_lines", "n_dropped")
    gone = repeats(docs, distance, similarity, id_col, text_col).select(F.col("id").alias(ID), F.col("drop").alias(DROP))
    x = d.join(gone.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col(ID)), "left")
    n_lines = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(F.split(text_col, "\n")))
    kept = F.expr(f"array_join(filter(split(`{text_col}`, '\\n'), (l, i) -> not array_contains({DROP}, i)), '\\n')")
    return (x.withColumn("n_lines", n_lines).withColumn("n_dropped", F.when(F.col(text_col).isNull() | F.col(DROP).isNull(), 0).otherwise(F.size(DROP)))
            .withColumn(text_col, F.when(F.col(DROP).isNull(), F.col(text_col)).otherwise(kept)).drop(ID, DROP))
