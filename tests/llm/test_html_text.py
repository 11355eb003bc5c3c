"""Main text of ordinary but untidy pages, and of the table's pages by an independent parser."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from tests import oracle
from tidegauge.llm import html_text

WORDS = "lorem ipsum dolor sit amet elit magna aliqua enim minim veniam quis".split()


def words(draw, n):
    return " ".join(draw.choice(WORDS) for _ in range(n))


def sentences(draw, n):
    return " ".join(words(draw, draw.randint(6, 18)).capitalize() + "." for _ in range(n))


def page(draw, body, head="</head>"):
    menu = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>'
    return f"<html><head><title>T</title>{head}<body><header><h2>Site</h2></header>{menu}{body}<aside class=sidebar><p>{sentences(draw, 1)}</p></aside><footer>&copy; 2024 {words(draw, 4)}</footer></body></html>"


LAYOUTS = {
    "article": ("<article><h1>{0}</h1><p>{1}</p><p>{2}</p></article>", "</head>"),
    "no end of the head": ("<article><h1>{0}</h1><p>{1}</p><p>{2}</p></article>", ""),
    "one paragraph": ("<article><p>{1}</p></article>", "</head>"),
    "slash in an unquoted value": ("<div class=content><h1>{0}</h1><div data-src=/img/></div><p>{1}</p><p>{2}</p></div>", "</head>"),
    "slash on an element that isn't void": ("<div class=content><p>{1}<div/><p>{2}</p></div></div>", "</head>"),
    "plain div": ("<div><h1>{0}</h1><p>{1}</p><p>{2}</p></div>", "</head>"),
    "plain div of one paragraph": ("<div><p>{1}</p></div>", "</head>"),
    "no box": ("<h1>{0}</h1><p>{1}<p>{2}", "</head>"),
    "unknown names, deep": ("<div id=x9><div class=qwrt><div><h1>{0}</h1><p>{1}</p><p>{2}</p></div></div></div>", ""),
}


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_no_article_is_lost(layout):
    draw, field = random.Random(3), html_text.trained()
    body, head = LAYOUTS[layout]
    for _ in range(100):
        parts = [words(draw, draw.randint(3, 8)).capitalize(), sentences(draw, 5), sentences(draw, 5)]
        expected = " ".join(p for i, p in enumerate(parts) if f"{{{i}}}" in body)
        assert html_text.extract(page(draw, body.format(*parts), head), field) == expected


def test_what_stands_in_a_head_is_hidden_and_what_does_not_ends_it():
    texts = lambda html: [b.text for b in html_text.blocks(html)]
    assert texts("<head><meta charset=x><title>t</title><link href=/a/><p>one</p>") == ["one"]
    assert texts("<head><style>p{}</style>text<p>one") == ["text", "one"]
    assert texts("<p>a<svg><path d=''/><g/>hidden</svg>b</p>") == ["a", "b"]
    assert texts("<div/><p>x</p></div>y") == ["x", "y"]


class Article(HTMLParser):
    """The text of an article's elements but those with a planted class, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside = self.skip = 0
        self.skipped = None
        self.parts = [""]

    def handle_starttag(self, tag, attrs):
        if self.skipped is None and dict(attrs).get("data-planted"):
            self.skipped = tag
        self.skip += tag == self.skipped
        self.inside += tag == "article"
        self.cut(tag)

    def handle_endtag(self, tag):
        self.skip -= tag == self.skipped
        if not self.skip:
            self.skipped = None
        self.inside -= tag == "article"
        self.cut(tag)

    def cut(self, tag):
        if tag not in ("b", "i", "em", "strong", "a", "span", "code"):
            self.parts.append("")

    def handle_data(self, data):
        if self.inside and not self.skip:
            self.parts[-1] += data


PLANTED = ('<section class="comments" data-planted=1><h3>Comments</h3><div class=comment><p>Nice one, {}.</p></div></section>', '<div class="cookie-notice" data-planted=1>We use cookies: {}.</div>', '<aside class="related" data-planted=1><ul><li><a href=/x>{}</a></li></ul></aside>')


@pytest.mark.parametrize("planted", [None, *range(3)])
def test_pages_of_the_table_by_an_independent_parser(planted):
    draw, field = random.Random(8), html_text.trained()
    rows = pq.read_table(f"{oracle.SF}/pages.parquet", columns=["html"])["html"].to_pylist()
    wrong = 0
    for html in rows:
        if planted is not None:
            html = html.replace("</article>", PLANTED[planted].format(words(draw, 6)) + "</article>")
        parser = Article()
        parser.feed(html)
        expected = " ".join(x for x in (" ".join(p.split()) for p in parser.parts) if x)
        wrong += html_text.extract(html, field) != expected
    assert wrong == 0
