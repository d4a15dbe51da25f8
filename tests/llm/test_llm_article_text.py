"""Main text of pages: templates with known articles, odd pages, broken markup."""

import re
import time
from html import unescape

import pytest

from wxlake.llm import article_text, queries
from wxlake.llm.article_text import main_blocks

P = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor."

PAGES = {
    "named": (f"""<html><head><title>t</title></head><body><div id=header><a href=/>Site</a> slogan here</div>
        <div class='menu'><a>a</a><a>b</a></div><div id=content><h1>Title</h1><p>{P}</p><p>Short.</p><ul><li>one thing</li><li>two, things</li></ul>
        <h2>Sub</h2><div>direct text &amp; more<br>line</div><blockquote>quote me</blockquote></div><div id=sidebar><p>{P}</p></div>
        <div id=comments><div class=comment-body><p>{P * 5}</p></div></div><div class=footer>(c) x</div></body></html>""",
              ["Title", P, "Short.", "one thing", "two, things", "Sub", "direct text & more line", "quote me"]),
    "elements": (f"""<body><header><h1>Site</h1></header><main><article><header><h1>T</h1><p>By me</p></header><p>{P}</p>
        <div class='ad'>Buy, now, this</div><form><label>mail</label><button>go</button></form><div class=share><a>x</a></div><footer>tags</footer>
        </article><section id=comments><article class=comment><p>{P * 4}</p></article></section></main><aside><p>{P * 9}</p></aside></body>""", ["T", P]),
    "comments as articles": (f"<article><p>{P}</p></article><section class=comments><article><p>{P * 3}</p></article></section>", [P]),
    "sections": (f"<body><div class='post'><section><p>{P}</p></section><section><p>Tiny</p></section></div></body>", [P, "Tiny"]),
    "no names": (f"""<body><div><a href=1>Home</a> <a href=2>News</a></div><div><p>{P}</p><p>One.</p></div><div><p>{P}</p></div>
        <div>Copyright 2024</div></body>""", [P, "One.", P]),
    "page in a form": (f"<body><form><div class=content><p>{P}</p><p>{P}</p></div><input><select><option>x</select></form></body>", [P, P]),
    "long notice": (f"<body><div class='cookie-notice'><p>{P * 4}</p></div><div class='content has-sidebar'><p>{P}</p></div></body>", [P]),
    "link list": (f"<article><p>{P}</p><ul><li><a href=1>Read one</a></li><li><a href=2>two</a></li></ul><p>end <a href=x>link</a></p></article>",
                  [P, "end link"]),
    "hidden": (f"<article><p>{P}</p><p hidden>a</p><p style='display: none'>b</p><p aria-hidden=true>c</p></article>", [P]),
    "broken": (f"<body><div class=main><p>{P}<p>second <b>bold<p>third</i> x</div></section><div class=nav><a href=1>x</a>", [P, "second bold", "third x"]),
    "table": ("<article><p>a, b</p><table><tr><th>k<th>v<tr><td>1<td>2</table></article>", ["a, b", "k", "v", "1", "2"]),
    "references": ("<article><p>a&nbsp;&nbsp;b &lt;x&gt; &#8212; &eacute;&#x1F600; c d</p><pre>x  y\n z</pre></article>", ["a b <x> — é😀 c d", "x y z"]),
    "quotes": ("<article class='a>b'><p title=\"</p><p>\">one<!-- <p>no</p> --> two</p><script>var t='</p><p>x';</script></article>", ["one two"]),
    "less than": ("<article><p>1 < 2 and 3 <4</p></article>", ["1 < 2 and 3 <4"]),
    "plain": ("just  text\n\nhere ", ["just text here"]),
    "empty": ("", []), "null": (None, []), "blank": (" \n ", []), "only menus": ("<nav><a href=1>x</a></nav><footer>y</footer>", []),
    "empty article": ("<article></article><div class=ad>Buy this, now.</div>", []),
}


@pytest.mark.parametrize("name", PAGES)
def test_known_articles(name):
    page, blocks = PAGES[name]
    assert main_blocks(page) == blocks


@pytest.mark.parametrize("page", [
    "<" * 200_000, "<a " * 200_000, "<div>" * 50_000, "<!--" * 200_000, "&" * 200_000, "<p><b>" * 50_000 + "x", "<a href='" * 100_000, "<div class='" * 100_000,
    "</p>" * 100_000, "<table><tr><td>x" * 30_000, "<a = = = =" * 50_000, "<a    " * 100_000, "<b><i>" * 50_000 + "</b>" * 50_000, "<script>" * 100_000],
    ids=lambda p: p[:10])
def test_odd_pages_take_time_in_proportion(page):
    begun = time.process_time()
    main_blocks(page)
    assert time.process_time() - begun < 15


def test_rows_columns_and_repeats(spark):
    rows = [(1, None, "u"), (1, None, "u"), (2, "<article><p>Hi, 😀 you.</p></article>", None), (None, "x" * 3_000_000, "v")]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string").selectExpr("*", "1 as row", "2 as article")
    found = article_text.extract(pages).selectExpr("row.page_id", "row.row", "article").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, 1, ""), (1, 1, ""), (2, 1, "Hi, 😀 you."), (None, 1, "x" * 3_000_000)], key=repr)
    assert article_text.extract(pages.limit(0)).collect() == []
    assert [r.article for r in article_text.extract(pages.select("html").limit(1)).collect()] == [""]


def test_query_returns_the_article_element_of_each_page(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = queries.QUERIES["op13_html_extraction"](spark, sf).collect()
    assert sorted(r.page_id for r in found) == sorted(pages)
    for row in found:
        inner = re.search("(?s)<article>(.*)</article>", pages[row.page_id].html)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("<p>|</p>|</h1>", inner)]
        assert (row.url, row.text, row.n_chars) == (pages[row.page_id].url, "\n\n".join(b for b in blocks if b), len(row.text))
