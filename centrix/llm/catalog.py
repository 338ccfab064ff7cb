"""Queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fill_in_middle, fingerprint, html_text, licences, line_dedup, mixing, phrases, quality_model, quality_rules, simhash, toxicity
from .common import WORD, table, text_or_empty


def tokenizer_path() -> str:
    """The public byte-level BPE file; ``CENTRIX_TOKENIZER`` names another."""
    named = os.environ.get("CENTRIX_TOKENIZER")
    if named:
        return named
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def word_count(text_col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted", "n_hits")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_classes(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "quality_score", "kept")


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["n_words"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.transform(table(spark, sf_dir, "documents"), with_texts=False)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_quality_rules, op3_fingerprints, op4_simhash, op5_line_dedup, op6_html_text,
                            op7_mixing, op8_quality_model, op9_licences, op10_bpe, op11_collocations, op12_decontamination, op13_fill_in_middle)}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The mix in SQL: the same hash, shares and order, without the rank steps.
ORACLES: dict[str, str] = {"op7_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         list_extract([5, 2, 1], 1 + CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS INT)) AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source) AS k,
         coalesce(sum(200 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY 2.0 * source_size / weight DESC, source DESC ROWS UNBOUNDED PRECEDING) AS open,
         150 * sum(source_size) OVER () AS total FROM s),
c AS (
  SELECT CAST(total - held AS DOUBLE) AS num, 100.0 * CAST(open AS DOUBLE) AS den FROM r
  WHERE 2.0 * source_size * 100 * open >= weight * (total - held) ORDER BY k LIMIT 1),
g AS (
  SELECT source, source_size,
         CASE WHEN 2.0 * source_size * den < weight * num OR num IS NULL THEN CAST(2 * source_size AS DOUBLE) ELSE weight * num / den END AS target
  FROM s LEFT JOIN c ON true),
e AS (
  SELECT d.doc_id, d.source, d.size, g.source_size, g.target,
         least(2.0, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END) AS expected,
         (CAST('0x' || substr(md5(concat_ws('|', 'mix', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR))), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (
  SELECT *, floor(expected) AS sure, expected - floor(expected) AS p FROM e),
o AS (
  SELECT *, CASE WHEN p > 0 THEN u * (1 - p) / ((1 - u) * p) END AS odds,
         target - sum(size * sure) OVER (PARTITION BY source) AS remains FROM q),
w AS (
  SELECT *, sum(CASE WHEN odds IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id, size RANGE UNBOUNDED PRECEDING) AS upto FROM o),
x AS (
  SELECT *, odds IS NOT NULL AND upto <= remains AS inside,
         remains - coalesce(max(CASE WHEN odds IS NOT NULL AND upto <= remains THEN upto END) OVER (PARTITION BY source), 0) AS rest FROM w),
m AS (
  SELECT source, arg_min((doc_id, size), (abs(rest - size), odds, doc_id, size)) AS best FROM x
  WHERE odds IS NOT NULL AND NOT inside AND abs(rest - size) < abs(rest) GROUP BY source)
SELECT x.doc_id, x.size, x.source_size, x.target,
       CAST(x.sure AS BIGINT) + CAST(x.inside OR ((x.doc_id, x.size) IS NOT DISTINCT FROM m.best AND x.odds IS NOT NULL) AS BIGINT) AS copies,
       (CAST(x.sure AS BIGINT) + CAST(x.inside OR ((x.doc_id, x.size) IS NOT DISTINCT FROM m.best AND x.odds IS NOT NULL) AS BIGINT)) * x.size AS taken
FROM x LEFT JOIN m ON x.source IS NOT DISTINCT FROM m.source
""",
    "op11_collocations": rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS i FROM w, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, CAST(count(*) AS BIGINT) AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
c AS (
  SELECT f.lang, f.m, f.phrase, f.a, k, x.a AS l, y.a AS r, CAST((1000000::HUGEINT * f.a * f.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) f
  JOIN f x ON x.lang = f.lang AND x.phrase = array_to_string(string_split(f.phrase, ' ')[1:k], ' ')
  JOIN f y ON y.lang = f.lang AND y.phrase = array_to_string(string_split(f.phrase, ' ')[k + 1:], ' ')),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, a, array_to_string(string_split(phrase, ' ')[1:2], ' ') AS phrase FROM f WHERE m = 3
    UNION ALL SELECT lang, a, array_to_string(string_split(phrase, ' ')[2:3], ' ') FROM f WHERE m = 3) GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.a IS NULL OR b.m = 3 OR 100 * i.a < 50 * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, t.n, score
FROM k JOIN t ON t.lang = k.lang QUALIFY rank <= 2000
""",
    "op12_decontamination": rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, CAST(greatest(1, len(w) - 9) + 1 AS BIGINT))) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT size FROM v),
e AS (
  SELECT row, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT row, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS i FROM d, s WHERE len(w) >= size)),
m AS (SELECT e.row, e.i, e.size, v.item FROM e JOIN v ON v.win = e.win AND v.size = e.size),
h AS (SELECT row, CAST(count(DISTINCT pos) AS BIGINT) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS pos FROM m) GROUP BY row),
n AS (SELECT row, CAST(count(DISTINCT item) AS BIGINT) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM m GROUP BY row)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.row = d.row LEFT JOIN n ON n.row = d.row
""",
    "op13_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
r AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM r),
c AS (SELECT *, array_to_string(u[1:x], '') AS pre, array_to_string(u[x + 1:y], '') AS mid, array_to_string(u[y + 1:], '') AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""}
