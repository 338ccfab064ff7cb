import html
import re

from centrix.llm import html_text
from tests.llm.helpers import DIR1

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site name</h1><p>The tagline of the whole site is here for all to read</p></header><nav><ul><li><a href=a>Home</a></ul></nav>
<div id="cookie-notice"><p>We use cookies to make this site better for you and for all others, is that fine?</p></div>
<div class="layout sidebar-right"><article><header><h2>Real &amp; title</h2></header><p>Short.</p>
<p>A paragraph with a <a href=x>link</a>&nbsp;inside
 and <b>more</b> words<br>on the second line.<p>An unclosed one &copy; 2020 &#233;<ul><li>one item<li>two items</ul>
<aside>A pull quote</aside><div class="ad">Buy this now please, it is good</div><form><label>Name</label></form>
<script>var a="</p><p>no";</script><p>The end.</p><section class="comments"><p>What a great article this was, thanks a lot!</p></section></article>
<div class="sidebar"><p>Other long text with many words that stand beside the article on this page</p></div></div><footer>Copyright</footer></body></html>"""


def test_article():
    assert html_text.main_text(ARTICLE).split("\n") == [
        "Real & title", "Short.", "A paragraph with a link inside and more words on the second line.", "An unclosed one © 2020 é", "one item", "two items", "The end."]


def test_page_without_article():
    page = ("<body><div class=menu><a href=1>Home</a> <a href=2>News</a></div><table><tr><td><h2>Title of it</h2><p>" + "word " * 50 + "<p>" + "more " * 30
            + "<p>ok then.<p>" + "again " * 44 + "</td><td><a href=x>a b</a><br><a href=y>c d</a></td></tr></table><div>Copyright 2020</div>")
    assert html_text.main_text(page).split("\n") == ["Title of it", ("word " * 50).strip(), ("more " * 30).strip(), "ok then.", ("again " * 44).strip()]


def test_broken_markup():
    for page in ("", "<", "<p", "<!-- open", "</p></div>", "<script>x", "<article><p>a<b>b", "&#0;&#xD800;&bogus;", "<a href='x>y"):
        assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("<article><p>a <b>b") == "a b"


def test_tree_fits_its_table():
    assert all(html_text.belongs(row[:-1]) == bool(row[-1]) for row in html_text.TRAINING)


def test_pages(spark):
    pages = spark.read.parquet(f"{DIR1}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?(?:h1|p)>", body)]
        want = "\n".join(p for p in parts if p)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_edges(spark):
    schema = "page_id BIGINT, url STRING, html STRING, text STRING, n_chars STRING"
    rows = [(1, None, None, "x", "y"), (1, "u", "", "x", "y"), (None, "u", "<p>" + "long text " * 30_000, "x", "y"), (2, "u", ARTICLE, None, None), (2, "u", ARTICLE, None, None)]
    got = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert [r.n_chars for r in got][:2] == [0, 0] and got[2].n_chars == 299_999 and got[3] == got[4]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0
