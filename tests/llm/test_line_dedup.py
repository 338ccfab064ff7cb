import re
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from centrix.llm import line_dedup
from tests.llm.helpers import EDGE, Groups, documents, edge, edits, empty


def _norm(line):
    return "".join(dict(zip(line_dedup._FROM, line_dedup._TO + "\0" * len(line_dedup._FROM), strict=False)).get(c, c) for c in line).replace("\0", "").strip(" ")


def _sim(norm):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in norm.split(" ") if w]
    return sum(1 << b for b in range(line_dedup.BITS) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _drops(docs, distance=3, similarity=0.8):
    """Dropped (id, line) by looking at every pair of lines."""
    places = {}
    for i, text in docs:
        for at, line in enumerate((text or "").split("\n")):
            norm = _norm(line)
            if norm:
                places.setdefault(norm, set()).add((i is not None, i or 0, at))
    g, norms = Groups(), sorted(places)
    sims = {n: _sim(n) for n in norms}
    words = {n: [w for w in n.split(" ") if w] for n in norms}
    for k, a in enumerate(norms):
        g.root(a)
        for b in norms[k + 1:]:
            if (sims[a] ^ sims[b]).bit_count() <= distance:
                most = max(len(words[a]), len(words[b]))
                if edits(words[a], words[b]) <= (1 - similarity) * most + 1e-9:
                    g.tie(a, b)
    groups = {}
    for n, p in places.items():
        groups.setdefault(g.root(n), set()).update(p)
    return {(i if known else None, at) for p in groups.values() for known, i, at in sorted(p)[1:]}


def _got(df):
    return {(r.id, at) for r in line_dedup.repeats(df).collect() for at in r["drop"]}


def test_documents_against_brute_force(spark):
    df = documents(spark)
    assert _got(df) == _drops([(r.doc_id, r.text) for r in df.collect()])


def test_edges(spark):
    assert _got(edge(spark)) == _drops([(r[0], r[1]) for r in EDGE])
    out = line_dedup.dedup_lines(edge(spark))
    rows = out.select("doc_id", "text", "n_lines", "n_dropped", "kept").collect()
    assert len(rows) == len(EDGE) and all(r.kept == "clash" for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1].text is None and by[1].n_lines == 0
    assert by[7].text == "" and by[7].n_dropped == 2       # every line repeats
    assert by[3].n_dropped == 0 and by[6].text == "\n\n \t\n"
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_near_lines_keep_one_of_each_group(spark):
    base = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)]
    docs = [(k, "\n".join([f"own line of {'abcdefghij'[k]}", " ".join([*base[:k * 7], "changed" + "abcdefghij"[k], *base[k * 7 + 1:]])])) for k in range(10)]
    docs.append((99, "Own   LINE of a!\n" + " ".join(reversed(base))))
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    assert _got(df) == _drops(docs)
    assert (99, 0) in _got(df) and (99, 1) not in _got(df)


def test_lines_of_one_simhash_and_many_lengths(spark):
    docs = [(k, " ".join(["shti"] * n + ["x" * (k % 3 + 1)] * (k % 4 == 0))) for k, n in enumerate([10, 50, 52, 12, 300, 55, 9, 41, 250, 8, 7, 6, 5, 4, 3, 290])]
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    assert _got(df) == _drops(docs) and len(_drops(docs)) > 5


def test_only_native_operators(spark):
    plan = line_dedup.dedup_lines(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_word_codes_are_word_edits(spark):
    df = spark.createDataFrame([("a b c d", "a x c d"), ("a b", "b a c"), ("", "a")], "x STRING, y STRING")
    got = df.select(F.levenshtein(line_dedup.word_codes(F.col("x")), line_dedup.word_codes(F.col("y"))).alias("d"), "x", "y").collect()
    assert all(r.d == edits(r.x.split(), r.y.split()) for r in got)


def test_repeated_rows_with_near_lines(spark):
    base = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)]
    first, near = " ".join(base), " ".join([*base[:40], "changed", *base[41:]])
    assert (_sim(first) ^ _sim(near)).bit_count() <= 3
    for docs in ([(1, first)] * 5 + [(2, near)], [(None, first)] * 5 + [(2, near)], [(None, first + f"\nown {'abcde'[k]}") for k in range(5)] + [(2, near)]):
        df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
        assert _got(df) == _drops(docs) and (2, 0) in _got(df)
    short = [(1, "a b")] * 3 + [(2, "a c")]
    lines = line_dedup.simhash_lines(spark.createDataFrame(short, "doc_id BIGINT, text STRING"), "doc_id", "text")
    assert {(r.id, r.words) for r in lines.collect()} == {(1, 2), (2, 2)}


def test_copies_do_not_overflow_the_sums(spark):
    text = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(1100))
    df = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    assert [(r.words, r.sim) for r in line_dedup.simhash_lines(df, "doc_id", "text").collect()] == [(1100, _sim(text))]


def test_cells_miss_no_near_pair():
    for distance in range(6):
        masks = line_dedup._masks(distance)
        near = combinations(range(line_dedup.BITS), min(distance, 3))
        differ = [sum(1 << b for b in some) for some in near] + [sum(1 << b for b in range(k, line_dedup.BITS, 13)[:distance]) for k in range(13)]
        assert all(any(not m & d for m in masks) for d in differ)


def test_ascii_lines_have_the_normal_form_of_others(spark):
    lines = ["", " ", "\t\x0b\f\r", "A-b C1\td!\x0be\ff\rg", "\\^]['\"$1 x", "a\0b\x7f\x1f", "Ünï CÔDE №1", "Σ ΑΣ İ I", "A" * 9, "ＡＢ１！", "e\u0301 É", "1,000.5%"]
    lines += [f"Q{chr(c)}z {chr(c)}" for c in range(1, 0x600)]
    df = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "k INT, line STRING")
    each = F.trim(F.translate("line", line_dedup._FROM, line_dedup._TO))
    rows = df.select("line", line_dedup.normalised(F.col("line")).alias("norm"), each.alias("each")).collect()
    assert [r for r in rows if r.norm != r.each] == [] and len(rows) == len(lines)


def test_a_line_is_normalised_once(spark):
    rows = line_dedup.simhash_lines(documents(spark), "doc_id", "text")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == plan.count("posexplode(") > 0


def test_majority_at_the_edges(spark):
    docs = [(n, " ".join(["ab"] * (n // 2) + ["cd"] * (n - n // 2))) for n in [1, 2, 3, 4, 510, 511, 512, 1023, 5000]]
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    assert {(r.id, r.words, r.sim) for r in line_dedup.simhash_lines(df, "doc_id", "text").collect()} == {(n, n, _sim(t)) for n, t in docs}
