"""Fill-in-the-middle against slices of the unit list, and back."""

import hashlib
import re

import pytest

from centrix.llm import fill_in_middle as fim

from .helpers import EDGE, documents, edge, empty

TRICKY = [(20, "no end of line"), (21, "\n"), (22, "a <P> mark\nin it\n"), (23, "<S"), (24, "half a mark <\nP>\n<M\n>\n<S"), (25, "\r\n\x0b  x\n"), (26, "x" * 100_000 + "\n" + "y\n" * 5000 + "z")]


def want(key, text, seed=7, percent=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        form, out, sizes = "plain", text, (None, None)
    elif h[3] % 100 < spm:
        form, out, sizes = "spm", f"<S>{suf}<P>{pre}<M>{mid}", (len(pre), len(mid))
    else:
        form, out, sizes = "psm", f"<P>{pre}<S>{suf}<M>{mid}", (len(pre), len(mid))
    return (key, n, form, *sizes, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), out)


def check(docs, rows, **params):
    got = fim.transform(docs, **params).drop("n_segments").collect()
    assert sorted(map(tuple, got), key=str) == sorted((want(k, t, **{{"spm_percent": "spm"}.get(p, p): v for p, v in params.items()}) for k, t in rows), key=str)


def test_all_documents_and_odd_rows(spark):
    docs = documents(spark)
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])
    rows = [(r[0], r[1]) for r in EDGE] + TRICKY
    check(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), rows)
    check(edge(spark), [(r[0], r[1]) for r in EDGE], seed=11, percent=50, spm_percent=20)
    assert fim.transform(empty(spark)).count() == 0


@pytest.mark.parametrize("form", ["psm", "spm", "plain"])
def test_restore_gives_the_text_back(form):
    for parts in (("", "", ""), ("a<", "S>b", "<P"), ("<", "<", "<"), ("x\n", "", "y")):
        assert fim.restore(form, fim.arrange(form, *parts)) == "".join(parts)


def test_index_is_exact_and_small():
    regular = list(range(0, 40_000, 40))
    index = fim.RankIndex(regular)
    assert len(index.first) == 1 and [index[i] for i in range(len(regular))] == regular
    rough, at = [0], 0
    for i in range(3000):
        at += (i * 7919) % 97 + (100_000 if i % 500 == 0 else 0)
        rough.append(at)
    index = fim.RankIndex(rough)
    assert [index[i] for i in range(len(rough))] == rough
    assert index.residual.dtype.itemsize == 1 and 6 <= len(index.first) < 100


def test_units_must_cover_the_text(spark):
    with pytest.raises(Exception, match="cover"):
        fim.transform(spark.createDataFrame([(1, "ab")], "doc_id INT, text STRING"), units="a").collect()
