from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from idbridge.llm.html_extract import Template, extract, main_text, subtrees
from idbridge.llm.queries import QUERIES
from idbridge.llm.store import Store

from ..conftest import SF_CHECK

PAGES = "page_id bigint, url string, html string"


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<div><div>x</div>y</div>z", "x\ny\nz"),
    ("<article><h1>T</h1><p>a &amp; b&nbsp;c<br>d</p><aside>no</aside><form><input>f</form>"
     "<section class='comments'><p>c</p></section></article><p>out", "T\na & b c d"),
    ("<body><nav>m</nav><header><h1>Site</h1></header><p>one</p><div class='sidebar'>s</div>"
     "<p>two<script>var a='</p>';</script> three</p><footer>f</footer></body>", "one\ntwo three"),
    ("<p>1 < 2 & 3 > 2</p>", "1 < 2 & 3 > 2"), ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<" * 50, "<" * 50), ('<p class="x>y">q</p>', "q"),
    ("<!-- x --><p>a<!-- b -->c</p>", "ac"), ("<p>x</p></div></p><p>y", "x\ny"), ("<b><p>x</b>y</p>", "xy"),
    ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T\nx"),
    ("<p>&#72;&eacute;&#x1F600;&lt;b&gt;</p>", "Hé😀<b>"), ("<style>p{}</style><p>a</p><noscript>n</noscript>", "a"),
    ("<article><article><p>in</p></article><p>out</p></article>", "in\nout"),
    ("<div role='navigation'>m</div><p>a</p>", "a"), ("<p>a</p><script>unclosed", "a"),
    # a word of a compound name says nothing, unless the rest only says where
    ("<article><p>a</p><section id='related-work'><p>b</p></section><div class='social-history'>c</div>"
     "<p class='notice-period'>d</p></article>", "a\nb\nc\nd"),
    ("<div class='banner-image-post'><p>all</p></div>", "all"),
    ("<p>a</p><div class='x site-footer'>f</div><div id='cookie-consent_banner2'>c</div><ul class='nav-bar-left'><li>n</ul>"
     "<div class='related-posts'>r</div><div class='ad-slot'>s</div><div class='page-header'>h</div>", "a"),
])
def test_pages(page, text):
    assert main_text(page) == text


def test_templates_are_those_of_their_host(spark):
    pages = []
    for i in range(12):
        pages.append((i, "http://a.example/x", f"<div>Menu of a</div><p>story {i}</p><p>By the desk</p>"
                                                 f"<ul><li>see {i}</li></ul>"))
        pages.append((100 + i, "https://b.example:80/y", f"<article><p>tale {i}</p><p>By the desk</p>"
                                                          f"<div>Read more</div></article><ul><li>{i}</li></ul>"))
    pages.append((200, "http://c.example/", "<div>Menu of a</div><p>By the desk</p>"))
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(pages, PAGES), Store(spark, "t")).collect()}
    for i in range(12):
        assert got[i] == f"story {i}"  # menus by words, lists by shape, paragraphs by words
        assert got[100 + i] == f"tale {i}\nBy the desk"  # a shared paragraph stays part of each article
    assert got[200] == "Menu of a\nBy the desk"


def test_share_of_the_host(spark):
    pages = [(i, "http://a/", f"<p>x {i}</p>" + ("<div>often</div>" if i < 6 else "")) for i in range(100)]
    df = spark.createDataFrame(pages, PAGES)
    got = {r.page_id: r.text for r in extract(df, Store(spark, "t"), Template(pages=5, share=0.1)).collect()}
    assert got[0] == "x 0\noften"
    got = {r.page_id: r.text for r in extract(df, Store(spark, "t"), Template(pages=5, share=0.05)).collect()}
    assert got[0] == "x 0"


def test_edge_rows(spark):
    rows = [(None, None, None), (1, None, ""), (1, "nonsense", "<p>a</p>"), (1, "nonsense", "<p>a</p>"),
            (2, "http://h/", "<p>" + "long " * 100_000 + "</p>"), (3, "http://h/", "\x00<p>﻿ b")]
    df = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("user") for c in ("host", "key", "text", "template")})
    got = extract(df, Store(spark, "t"))
    assert got.columns == ["page_id", "url", "text"] and got.count() == len(rows)
    assert got.where("text is null").count() == 0
    assert extract(spark.createDataFrame([], PAGES), Store(spark, "t")).count() == 0


def test_given_pages_against_their_articles(spark):
    """The given pages have one article of headings and paragraphs."""
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op9_html_extract"](spark, SF_CHECK).collect()}
    for r in spark.read.parquet(f"{SF_CHECK}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", body)]
        text = "\n".join(b for b in blocks if b)
        assert got[r.page_id] == (text, len(text))


def test_subtree_hashes_are_stable():
    assert subtrees("<div class='a'><p>x</p></div>") == subtrees('<DIV class="a"><p> x </p></DIV>')
    assert subtrees("<div><p>x</p></div>") != subtrees("<div><p>y</p></div>")


def _texts(spark, pages, p=Template()):
    return {r.page_id: r.text for r in extract(spark.createDataFrame(pages, PAGES), Store(spark, "t"), p).collect()}


def test_template_goes_before_the_text_is_chosen(spark):
    teaser = "<article><h2>Featured</h2><p>the same story on every page</p></article>"
    words = "amber birch cedar delta ember fjord grove heath inlet jetty kiosk larch".split()
    pages = [(i, "http://a/", f"<div><p>{w} one</p><p>{w} two</p></div>{teaser}") for i, w in enumerate(words)]
    pages += [(100 + i, "http://b/", f"<main><p>{w} text</p></main>{teaser}") for i, w in enumerate(words)]
    # an article that recurs with other surroundings is still the text of a page that has no other
    pages += [(200 + i, "http://c/", f"<nav>{w}</nav><div><article><p>copied</p></article></div>") for i, w in enumerate(words)]
    got = _texts(spark, pages)
    for i, w in enumerate(words):
        assert got[i] == f"{w} one\n{w} two"
        assert got[100 + i] == f"{w} text"
        assert got[200 + i] == "copied"


def test_an_article_without_text_is_not_the_main_text():
    assert main_text("<article><nav>m</nav></article><p>body") == "body"


def test_copies_of_a_page_count_once(spark):
    copy = "<div><p>a story</p><p>that is stored often</p></div>"
    pages = [(i, "http://a/", copy) for i in range(20)]
    pages += [(100 + i, "http://a/", f"<p>other {i}</p>" + ("<div>Menu</div>" if i < 4 else "")) for i in range(40)]
    # of 45 rows 41 are copies: five distinct pages in all share the notice
    pages += [(200 + i, "http://b/", f"<p>page {min(i, 4)}</p><div>Notice</div>") for i in range(45)]
    got = _texts(spark, pages)
    assert all(got[i] == "a story\nthat is stored often" for i in range(20))
    assert got[100] == "other 0\nMenu" and got[139] == "other 39"
    assert got[200] == "page 0" and got[244] == "page 4"


def test_many_pages_are_enough_on_a_large_host(spark):
    words = "amber birch cedar delta ember fjord grove heath inlet jetty".split()
    pages = [(i, "http://a/", f"<p>{words[i % 10]} {i}</p>" + ("<div>Sports desk</div>" if i < 60 else "")) for i in range(1000)]
    got = _texts(spark, pages)
    assert got[0] == "amber 0" and got[59] == "jetty 59"  # 6 % of the host
    assert got[60] == "amber 60"


WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty kiosk larch".split()


@pytest.mark.parametrize(("body", "text"), [
    ("<div class='post'>{0} has<br>rain</div>", "{0} has rain"),
    ("<ul><li>{0}</li><li>and {0}</li></ul>", "{0}\nand {0}"),
    ("<table><tr><td>{0}</td><td>{1}</td></tr></table>", "{0}\n{1}"),
    ("<div class='post'>part {1}</div>", "part {1}"), ("<ol><li>part {1}</li></ol>", "part {1}"),
    ("<h1>{0}</h1><ul><li>a longer point {1}</li></ul>", "{0}\na longer point {1}"),
    ("<p>{0} text</p><ul><li><a href='/'>{0}</a></li><li><a href='/x'>x{0}</a></li></ul>", "{0} text"),
])
def test_bodies_of_one_shape(spark, body, text):
    menu = "<div><a href='/1'>One</a> <a href='/2'>Two</a></div>"
    got = _texts(spark, [(i, "http://a/", menu + body.format(w, i)) for i, w in enumerate(WORDS)])
    assert got == {i: text.format(w, i) for i, w in enumerate(WORDS)}


def test_rare_blocks_of_a_common_shape_stay(spark):
    pages = [(i, "http://a/", f"<p>{w}</p><div>{w * 2} desk</div>") for i, w in enumerate(WORDS)]
    assert _texts(spark, pages)[0] == "amber\namberamber desk"
