"""Main text of pages: expected texts, densities against their definition on nested trees, broken and very long pages."""

from __future__ import annotations

import re
import time
from html import unescape
from html.parser import HTMLParser
from math import e, log

import duckdb
import pytest
from fixtures import prose

from fieldtally.llm import queries
from fieldtally.llm.dom import read
from fieldtally.llm.html_text import best_inside, chosen, densities, is_node, kept, main_text, text_of

PARAGRAPHS = [prose(i, 30 + 7 * i).replace("&", "") for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
TEXT = "\n\n".join(PARAGRAPHS)
AROUND = {
    "menu": '<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>',
    "header": "<header><h2>Site name</h2><p>Our motto</p></header>",
    "footer": "<footer><p>&copy; Somebody, all rights reserved</p></footer>",
    "sidebar": f'<div class="side-bar"><p>{prose(50, 80)}</p></div>',
    "aside": f"<aside><p>{prose(51, 60)}</p></aside>",
    "notice": f'<div id="cookie-notice"><p>{prose(52, 40)}</p></div>',
    "advert": f'<div class="ad-box top">{prose(53, 40)}</div>',
    "form": '<form action="/s"><label>Name <input name="q"></label><textarea>write</textarea></form>',
    "comments": f'<section class="post-comments"><article><p>{prose(54, 150)}</p></article><div>{prose(55, 90)}</div></section>',
    "script": '<script>document.write("<p>no</p>")</script><style>p{}</style><noscript><p>no</p></noscript><!-- <p>no</p> -->',
    "role": f'<div role="banner"><p>{prose(56, 50)}</p></div>',
}


def page(inner):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{inner}</body></html>"


@pytest.mark.parametrize("name", sorted(AROUND))
@pytest.mark.parametrize("place", ["before", "after", "inside"])
def test_all_but_the_article_goes(name, place):
    part = AROUND[name]
    if place == "inside" and name == "header":
        part = "<header><p>Our motto</p></header>"  # with a heading it is the article's own
    article = f"<article><h1>Title</h1>{BODY}{part if place == 'inside' else ''}</article>"
    inner = {"before": part + article, "after": article + part, "inside": article}[place]
    assert text_of(page(inner)) == "Title\n\n" + TEXT


@pytest.mark.parametrize("name", sorted(AROUND))
def test_without_an_article_element(name):
    part = AROUND[name]
    for inner in (f"<div class=entry><h1>Title</h1>{BODY}</div>", f"<h1>Title</h1><div><div>{BODY}</div></div>", f"<main><h1>Title</h1><div>{BODY}</div></main>"):
        assert text_of(page(part + inner + part)) == "Title\n\n" + TEXT


def test_link_lists_without_telling_names_go():
    links = "".join(f'<div><a href="/{i}">{prose(i, 6)}</a></div>' for i in range(30))
    assert text_of(page(f"<div>{links}</div><div>{BODY}</div><div>{links}</div>")) == TEXT


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ("a &amp; b &lt;c&gt; &eacute;&#233;&#xe9; &nbsp;&amp &am", "a & b <c> ééé & &am"),
        ("one<br>two<br/>three\n\t four", "one two three four"),
        ("x<b>y</b>z <i>u<span>v</span></i>", "xyz uv"),
        ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\n\nfour"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\n\nb\n\nc\n\nd"),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", "a\n\nb\n\nc\n\nd"),
        ("<h2>a<h3>b</h2>c", "a\n\nb\n\nc"),
        ("<p><b>a<p>b</b>c</p></p>d", "a\n\nbc\n\nd"),
        ("a <3 b < c </> d<", "a <3 b < c d<"),
        ("a<!-- > <b> --!>b<!-->c<!--->d<?php e?>f<!x>g", "abcdfg"),
        ('<p title="a>b" class=\'c\'>d</p><a href="x?a=1&b=\'2\'">e</a>', "d\n\ne"),
        ("a<script>if (1<2) x('</p>')</SCRIPT >b<style></style>c", "abc"),
        ("<div><p>  </p><p></p></div>", ""),
        ("a<svg/>b<wbr>c", "abc"),
        ("a  b\x1cc", "a b c"),
    ],
)
def test_reading(inner, text):
    assert text_of(f"<article>{inner}</article>") == text


def test_names_that_only_sound_alike_stay():
    inner = '<section id="related-work"><h2 id="comments">Comments</h2><p>One</p></section><div class="has-sidebar no-ads cookie-recipe"><p>Two</p></div>'
    assert text_of(page(f"<article>{inner}</article>")) == "Comments\n\nOne\n\nTwo"


def test_article_inside_of_a_telling_name_stays():
    assert text_of(page(f'<form id="form"><div class="sidebar content"><article>{BODY}</article></div></form>')) == TEXT
    assert text_of(page(f"<nav><ul><li><a href=/>Home</a></ul><article>{BODY}</article>")) == TEXT


@pytest.mark.parametrize("html", ["", " \n", "<", "</", "<!--", "<p", "<article>", "<title>x", "&", '<a href="', "<article></article>"])
def test_pages_without_text(html):
    assert text_of(html) in ("", "<", "&")


class Nested(HTMLParser):
    """A well-formed page as nested lists [name, children and texts]."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.root = ["body"]
        self.stack = [self.root]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.stack[-1].append([tag])
        self.stack.append(self.stack[-1][-1])

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        self.stack[-1].append(data)


def measures(node, linked=False):
    """(C, T, LC, LT) by a walk of the whole subtree."""
    linked = linked or node[0] == "a"
    c = sum(len(" ".join(x.split())) for x in node[1:] if isinstance(x, str))
    total = [c, 0, c if linked else 0, 0]
    for x in node[1:]:
        if not isinstance(x, str):
            inner = measures(x, linked)
            total = [total[0] + inner[0], total[1] + inner[1] + 1, total[2] + inner[2], total[3] + inner[3] + (x[0] == "a")]
    return total


def density(measured, body):
    c, t, lc, lt = (max(1, x) for x in measured)
    if not measured[0]:
        return 0.0
    plain = max(1, measured[0] - measured[2])
    return c / t * log(c / lc * t / lt, log(c / plain * lc + body[2] / body[0] * c + e))


def test_densities_are_as_defined():
    html = f'<div><h1>A title</h1><p>{PARAGRAPHS[0]}<a>more</a></p><section>own<p>{PARAGRAPHS[1]}</p><p>x</p></section></div><ul><li><a>one</a></li><li><a>two <p>deep</p></a></li></ul><div></div>'
    root = Nested(html).root
    body = measures(root)
    each, sums = [], []

    def walk(node, linked):
        linked = linked or node[0] == "a"
        here = density(measures(node, linked), body)
        at = len(each)
        each.append(here)
        own = sum(len(" ".join(x.split())) for x in node[1:] if isinstance(x, str))
        sums.append(0.0)
        total = 0.0 if linked else density((own, 1, 0, 0), body)
        for x in node[1:]:
            if not isinstance(x, str):
                total += walk(x, linked)
        sums[at] = total
        return here

    walk(root, False)
    tree = read(html, is_node)
    found, added, chars = densities(tree, kept(tree))
    assert found == pytest.approx(each) and added == pytest.approx(sums) and chars[0] == body[0]
    best = best_inside(tree, kept(tree), added)
    assert tree.names[best[0]] == "div" and added[best[0]] == max(sums)
    assert chosen(tree, kept(tree)).count(True) >= 6


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 200_000 + "x" + "</span>" * 200_000,
        "<span>" * 200_000 + "x" + "</div>" * 200_000,
        "<div><table><td>" + "<section>" * 100_000 + "</div>" * 100_000,
        "<ul><li>" * 100_000 + "x",
        "<p><b><a href='>" * 100_000,
        "<" * 400_000,
        "<!--" * 200_000,
        "<a " * 200_000,
        "<style>" * 100_000,
        "<h1>a" * 100_000,
        "<p>word " * 200_000,
        '<div class="' + "a-b " * 200_000 + '">x</div>',
        "<article>x" * 50_000,
        "&amp" * 300_000,
    ],
)
def test_reading_is_linear(html):
    began = time.process_time()
    text_of(html)
    assert time.process_time() - began < 30


def test_whole_table_equals_plain_blocks(spark, sf):
    """Pages of the test data: the blocks between the tags of their article."""
    pages = duckdb.connect().execute(f"SELECT * FROM read_parquet('{sf}/pages.parquet')").fetchall()
    expected = {}
    for page_id, url, html in pages:
        blocks = re.split(r"</?(?:p|h1)>", re.search("<article>(.*?)</article>", html, re.DOTALL)[1])
        texts = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
        expected[page_id] = (url, "\n\n".join(t for t in texts if t))
    found = {r.page_id: (r.url, r.text, r.n_chars) for r in queries.op11_html_text(spark, sf).collect()}
    assert found == {k: (u, t, len(t)) for k, (u, t) in expected.items()}


def test_odd_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars int, block int"
    rows = [(1, "u", None), (None, None, page(BODY)), (2, "u", ""), (3, None, "é" * 100_000), (3, None, "x"), (3, None, "x"), (4, "u", "<article>\U0001f600</article>")]
    found = main_text(spark.createDataFrame([(*r, "t", 1, 2) for r in rows], schema)).collect()
    key = lambda r: (str(r[0]), str(r[1]), r[2])
    texts = ["", TEXT, "", "é" * 100_000, "x", "x", "\U0001f600"]
    assert sorted(map(tuple, found), key=key) == sorted([(i, u, t, len(t)) for (i, u, _), t in zip(rows, texts, strict=True)], key=key)
    assert main_text(spark.createDataFrame([], schema)).count() == 0
