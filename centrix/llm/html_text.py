"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks (runs of text between block-level
tags).  Each block is described by its own word count and link density, those
of its neighbours, and where its enclosing tags place it (page furniture, main
content, heading), and a decision tree trained on a small labelled table says
whether it belongs to the main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, text_or_empty

#: HTML's block-level elements, elements without end tag, and
#: elements whose content isn't shown as text.
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
             "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
             "tbody td tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template iframe object svg math canvas audio video head title textarea select button noframes".split())
RAW = set("script style noscript template iframe textarea title noframes svg math".split())
FURNITURE = set("nav aside footer form menu dialog fieldset search address".split())
CONTENT = set("article main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role attributes that mark page furniture, and those
#: that mark the main text.
FURNITURE_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                      "alert popup modal overlay newsletter subscribe subscription signup sidebar side aside rail nav navbar navigation menu breadcrumb "
                      "breadcrumbs footer foot masthead topbar toolbar share sharing social related recommended recommendations recommend comment "
                      "comments commentlist discussion disqus reply replies respond response responses widget widgets pagination pager paging login "
                      "search skip tags tagcloud disclaimer copyright complementary contentinfo".split())
CONTENT_WORDS = set("article articlebody main post entry story content".split())
#: Words that make an article element something beside the page's article.
BESIDE_WORDS = set("comment comments reply replies related recommended recommendations teaser promo ad advert sponsored".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: The labelled table: words and link density of the block, of the one before
#: and of the one after, furniture (1: inside such a tag, or so named), content
#: (1: inside article or main, or so named), heading, and the label.
TRAINING = [
    # paragraphs, short and long, of an article
    (80, 0.0, 60, 0.0, 70, 0.0, 0, 1, 0, 1), (12, 0.0, 90, 0.0, 40, 0.0, 0, 1, 0, 1), (2, 0.0, 30, 0.0, 25, 0.0, 0, 1, 0, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 1), (45, 0.3, 50, 0.0, 4, 0.0, 0, 1, 0, 1), (6, 1.0, 40, 0.1, 50, 0.0, 0, 1, 0, 1),
    (150, 0.1, 5, 0.0, 3, 1.0, 0, 1, 0, 1), (9, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (20, 0.8, 20, 0.8, 20, 0.8, 0, 1, 0, 1),
    (7, 0.0, 6, 1.0, 60, 0.0, 0, 1, 1, 1), (4, 0.0, 80, 0.0, 55, 0.0, 0, 1, 1, 1), (10, 0.0, 3, 1.0, 3, 1.0, 0, 1, 1, 1),
    (3, 0.0, 0, 0.0, 2, 0.0, 0, 1, 1, 1), (300, 0.0, 2, 0.0, 12, 0.5, 0, 1, 0, 1),
    # furniture inside and outside an article: menus, notices, adverts, forms, comments
    (3, 1.0, 3, 1.0, 3, 1.0, 1, 0, 0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (12, 0.0, 60, 0.0, 80, 0.0, 1, 1, 0, 0),
    (60, 0.0, 70, 0.0, 90, 0.0, 1, 1, 0, 0), (120, 0.0, 40, 0.0, 50, 0.0, 1, 0, 0, 0), (8, 0.2, 100, 0.0, 0, 0.0, 1, 0, 0, 0),
    (5, 0.0, 30, 0.0, 20, 0.0, 1, 1, 1, 0), (4, 0.0, 2, 0.0, 6, 1.0, 1, 0, 1, 0), (25, 0.0, 20, 0.0, 30, 0.0, 1, 0, 0, 0),
    (2, 0.5, 4, 1.0, 9, 0.0, 1, 1, 0, 0), (45, 0.1, 3, 0.0, 45, 0.0, 1, 1, 0, 0), (1, 0.0, 1, 0.0, 1, 0.0, 1, 0, 0, 0),
    # what stands outside of a page's article, however long
    (90, 0.0, 70, 0.0, 80, 0.0, 0, -1, 0, 0), (12, 0.0, 4, 0.0, 40, 0.0, 0, -1, 0, 0), (3, 1.0, 3, 1.0, 30, 0.0, 0, -1, 0, 0),
    (4, 0.0, 8, 0.0, 25, 0.0, 0, -1, 1, 0), (25, 0.0, 60, 0.0, 0, 0.0, 0, -1, 0, 0), (1, 0.0, 0, 0.0, 9, 0.0, 0, -1, 0, 0),
    (30, 0.1, 90, 0.0, 20, 0.5, 0, -1, 0, 0), (200, 0.0, 30, 0.0, 5, 0.0, 0, -1, 0, 0),
    # pages without article tags: long plain blocks and what stands between them
    (90, 0.0, 70, 0.0, 80, 0.0, 0, 0, 0, 1), (35, 0.05, 60, 0.0, 4, 1.0, 0, 0, 0, 1), (18, 0.0, 40, 0.0, 45, 0.0, 0, 0, 0, 1),
    (5, 0.0, 50, 0.0, 60, 0.0, 0, 0, 0, 1), (2, 0.0, 45, 0.0, 33, 0.0, 0, 0, 0, 1), (60, 0.2, 3, 1.0, 3, 1.0, 0, 0, 0, 1),
    (25, 0.0, 30, 0.0, 2, 0.0, 0, 0, 0, 1), (12, 0.0, 20, 0.0, 25, 0.0, 0, 0, 0, 1), (7, 0.0, 3, 1.0, 70, 0.0, 0, 0, 1, 1),
    (5, 0.0, 60, 0.0, 80, 0.0, 0, 0, 1, 1), (4, 0.0, 0, 0.0, 40, 0.0, 0, 0, 1, 1), (3, 0.0, 25, 0.0, 30, 0.0, 0, 0, 1, 1),
    (22, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (200, 0.3, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (16, 0.0, 18, 0.0, 17, 0.0, 0, 0, 0, 1),
    # their menus, link lists, by-lines and copyright lines
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (6, 1.0, 4, 1.0, 80, 0.0, 0, 0, 0, 0), (5, 0.9, 70, 0.0, 5, 0.9, 0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (4, 0.0, 60, 0.0, 3, 1.0, 0, 0, 0, 0), (7, 0.0, 5, 0.0, 3, 1.0, 0, 0, 0, 0),
    (10, 0.6, 3, 0.0, 12, 0.6, 0, 0, 0, 0), (30, 0.9, 10, 0.9, 25, 0.9, 0, 0, 0, 0), (5, 0.0, 4, 0.0, 0, 0.0, 0, 0, 0, 0),
    (1, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (8, 0.5, 90, 0.0, 0, 0.0, 0, 0, 0, 0), (15, 0.7, 40, 0.0, 35, 0.0, 0, 0, 0, 0),
    (2, 0.0, 3, 1.0, 2, 1.0, 0, 0, 1, 0), (3, 0.0, 4, 1.0, 4, 1.0, 0, 0, 1, 0),
]


def _grow(x: np.ndarray, y: np.ndarray, depth: int) -> tuple:
    """A classification tree: (feature, cut, below, above) or a share of ones."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return (share,)
    best = (share * (1 - share) * len(y) - 1e-9, None, None)
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for cut in (values[1:] + values[:-1]) / 2:
            low = y[x[:, k] <= cut]
            high = y[x[:, k] > cut]
            impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in (low, high))
            if impurity < best[0]:
                best = (impurity, k, cut)
    _, k, cut = best
    if k is None:
        return (share,)
    low = x[:, k] <= cut
    return (k, float(cut), _grow(x[low], y[low], depth - 1), _grow(x[~low], y[~low], depth - 1))


@cache
def tree(depth: int = 8) -> tuple:
    """The tree trained on the labelled table."""
    t = np.array(TRAINING, dtype=float)
    return _grow(t[:, :-1], t[:, -1], depth)


def belongs(row: tuple) -> bool:
    node = tree()
    while len(node) > 1:
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node[0] > 0.5


def _marks(name: str, attributes: str) -> tuple[bool, bool, bool, bool]:
    """Whether an element is furniture by its tag, furniture by its name, named
    like content, or not shown."""
    furniture, named, content, hidden = name in FURNITURE, False, False, name in HIDDEN
    if attributes and name not in ("body", "html"):
        for key, *values in _ATTR.findall(attributes):
            value = "".join(values)
            key = key.lower()
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                hidden = hidden or name not in ("a", "span")
            elif key in ("class", "id", "role"):
                words = {w.lower() for w in _WORDS.findall(value)}
                content = content or bool(words & CONTENT_WORDS) and name not in ("a", "span", "p")
                named = named or bool(words & (BESIDE_WORDS if name in CONTENT else FURNITURE_WORDS))
    return furniture, named, content, hidden


def blocks(page: str) -> list[tuple[str, int, int, bool, int, bool]]:
    """Text blocks in page order: text, words, linked words, furniture,
    content, heading.  White space inside a block is one space.

    ``content`` is 1 inside the page's strongest content element (an article,
    else a main element, else one so named), -1 outside it, and 0 on pages
    without any.  A page header outside of that is furniture, and so is what
    its element's tag or name says, except that names of elements around an
    article don't count inside it (layouts are often named after sidebars)."""
    out, parts = [], []  # parts: (text, inside a link)
    stack: list[tuple] = []  # name, its marks, and the named depth around it
    depth = dict.fromkeys(("furniture", "named", "content", "hidden", "link", "heading", "article", "main", "header"), 0)

    def count(mark: tuple, by: int) -> None:
        for key, on in zip(("furniture", "named", "content", "hidden"), mark[1:5], strict=True):
            depth[key] += by * on
        depth["link"] += by * (mark[0] == "a")
        depth["heading"] += by * (mark[0] in HEADINGS)
        if mark[0] in ("article", "main", "header") and not mark[2]:
            depth[mark[0]] += by
        if by < 0 and mark[0] in CONTENT:
            depth["named"] = mark[5]

    def end() -> None:
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            linked = sum(len(t.split()) for t, link in parts if link)
            out.append((text, len(text.split()), linked, dict(depth)))
        parts.clear()

    def say(text: str) -> None:
        if text and not depth["hidden"]:
            parts.append((html.unescape(text), depth["link"] > 0))

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:].removesuffix("]]>"))
            continue
        name = m[2].lower()
        if name == "br":
            parts.append((" ", False))
        if name in BLOCKS:
            end()
        if m[1]:
            if any(s[0] == name for s in stack):
                while stack:
                    closed = stack.pop()
                    if closed[0] in BLOCKS:
                        end()
                    count(closed, -1)
                    if closed[0] == name:
                        break
        elif name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else (size if name in ("script", "style") else at)
        elif name not in VOID and not m[3].rstrip().endswith("/"):
            if name in BLOCKS and stack and stack[-1][0] == "p":  # a block ends an open paragraph
                count(stack.pop(), -1)
            mark = (name, *_marks(name, m[3]), depth["named"])
            if name in CONTENT:
                depth["named"] = 0
            stack.append(mark)
            count(mark, 1)
    end()
    level = next((key for key in ("article", "main", "content") if any(d[key] and not d["furniture"] and not d["named"] for *_, d in out)), None)

    def placed(d: dict) -> tuple[bool, int, bool]:
        inside = 0 if level is None else 1 if d[level] else -1
        return bool(d["furniture"] or d["named"] or (d["header"] and inside < 1)), inside, d["heading"] > 0

    return [(text, words, linked, *placed(d)) for text, words, linked, d in out]


def main_text(page: str) -> str:
    """The blocks of the main text in page order, one line each."""
    found = blocks(page)
    rows = [(w, linked / w) for _, w, linked, *_ in found]
    edge = (0, 0.0)
    kept = []
    for k, (text, _, _, furniture, content, heading) in enumerate(found):
        before = rows[k - 1] if k else edge
        after = rows[k + 1] if k + 1 < len(rows) else edge
        if belongs((*rows[k], *before, *after, furniture, content, heading)):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``(id_col, *keep, text, n_chars)``, one row per input row.

    A null page counts as empty; a page without main text has the empty text
    and 0 characters.  Broken markup is read leniently: an unclosed element
    ends with its parent, an unclosed comment or tag with the page.  Pages stay
    whole.  Map-only.
    """
    fields = [pages.schema[c] for c in (id_col, *keep)]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return map_batches(pages.select(*[F.col(c) for c in (id_col, *keep)], text_or_empty(html_col)), run, schema)
