from __future__ import annotations

import html
import re
import time
from collections import Counter

import duckdb
import pytest

from cartmill.llm import extraction
from tests.llm.conftest import SF


def article(page):
    """Text of the article element, by way of its known plain markup."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", inside))).split())


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in extraction.extract_text(pages).collect()}
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    assert len(got) == len(rows) > 0
    for key, url, page in rows:
        text = article(page)
        assert tuple(got[key]) == (key, url, text, len(text))


def shares(got, main):
    """Recall and precision of words, repeats counted."""
    hits = sum((Counter(got.split()) & Counter(main.split())).values())
    return hits / max(1, len(main.split())), hits / max(1, len(got.split()))


@pytest.mark.parametrize("left_out", range(len(extraction.PAGES)))
def test_labelled_pages_without_their_label(monkeypatch, left_out):
    """Weights counted on the other pages find a page's main words and no others."""
    page = extraction.PAGES[left_out]
    monkeypatch.setattr(extraction, "PAGES", extraction.PAGES[:left_out] + extraction.PAGES[left_out + 1 :])
    extraction.weights.cache_clear()
    try:
        got = extraction.main_text(re.sub(r"\[\[|\]\]", "", page))
    finally:
        extraction.weights.cache_clear()
    main = re.sub(r'<div class="ad">.*?</div>', "", re.split(r"\[\[|\]\]", page)[1])
    main = re.sub(r"<(?!/?(?:b|i|u|em|strong|code|span|a)\b)[^>]*>", " ", main)
    assert min(shares(got, re.sub(r"<[^>]*>", "", main))) >= 0.95


def prose(*numbers):
    return [f"Paragraph {i} tells a good deal about the old harbour, its boats and the people who mend them." for i in numbers]


def paragraphs(*numbers):
    return "".join(f"<p>{t}</p>" for t in prose(*numbers))


LINKS = "<ul>" + "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(8)) + "</ul>"
CELLS = [(i, i * i) for i in range(200)]
TABLE = "<table>" + "".join(f"<tr><td>{a}</td><td>{b}</td></tr>" for a, b in CELLS) + "</table>"
#: Main markup and its text.
BODIES = {
    "paragraphs": (paragraphs(1, 2, 3), " ".join(prose(1, 2, 3))),
    "table in the middle": (f"{paragraphs(1)}{TABLE}{paragraphs(2, 3)}", " ".join([*prose(1), *(f"{a} {b}" for a, b in CELLS), *prose(2, 3)])),
    "table at the end": (f"{paragraphs(1, 2)}{TABLE}", " ".join([*prose(1, 2), *(f"{a} {b}" for a, b in CELLS)])),
    "link at the end": (f"{paragraphs(1, 2)}<p><a href='/2'>Read the second part here</a></p>", " ".join([*prose(1, 2), "Read the second part here"])),
    "unknown element": (f"{paragraphs(1)}<x-box><y-z>Some words of it</y-z></x-box>{paragraphs(2)}", " ".join([*prose(1), "Some words of it", *prose(2)])),
    "headings and lists": (
        f"<h1>Old harbour</h1>{paragraphs(1)}<h2>Boats</h2><ul><li>one</li><li>two</li></ul><blockquote>Well said</blockquote>{paragraphs(2)}",
        " ".join(["Old harbour", *prose(1), "Boats one two Well said", *prose(2)]),
    ),
    "short lines": (f"<h1>Poem</h1>{paragraphs(1)}<p>sea</p><p>sky</p><p>salt</p>{paragraphs(2)}", " ".join(["Poem", *prose(1), "sea sky salt", *prose(2)])),
}
#: Pages around the main markup {}.
LAYOUTS = {
    "article": "<body><nav>L</nav><article>{}</article><footer>About us</footer></body>",
    "main": "<body><header><a href='/'>Home</a></header><main><div>{}</div></main><aside><p>Read this too, it is long and good.</p></aside></body>",
    "form around the page": "<body><form method=post id=aspnetForm><input type=hidden><div>L</div><div id=content>{}</div></form></body>",
    "article in a form": "<body><form><input><article>{}</article></form></body>",
    "has-sidebar": "<body><div class='layout has-sidebar'><div class=text>{}</div><div class=sidebar><p>Join our club of friends today.</p></div></div></body>",
    "no-sidebar with article": "<body><div class='no-sidebar'><article>{}</article></div></body>",
    "widgets": "<body><div class='widget widget-text'><div>{}</div></div><div class=footer>All rights reserved</div></body>",
    "related on": "<body><div class='post related-on'>{}</div><div>L</div></body>",
    "discussion": "<body><div id=story>{}</div><section id=discussion><div class=reply><p>I was there myself and saw it all.</p></div></section></body>",
    "comments as articles": "<main><article>{}</article><ol class=comment-list><li><article><p>Nice story, thank you very much for it!</p></article></li></ol></main>",
    "long comments": "<body><div id=story>{}</div><div id=comments>C</div></body>",
    "columns of a table": "<body><table><tr><td>L</td><td><div>{}</div></td><td><a href='/x'>More</a></td></tr></table></body>",
    "plain boxes": "<body><div><a href='/'>Start</a> <a href='/all'>All</a></div><div><div>{}</div><div><h4>Popular</h4>L</div></div></body>",
    "right in the body": "<body><div>L</div>{}<div>L</div><div>Copyright Harbour News</div></body>",
    "advert inside": "<body><div class=story>{}<div class='ad'>Buy new boats now</div></div></body>",
    "hidden parts": "<body><div class=story>{}<div style='display:none'>hidden words</div><div hidden>more of them</div></div></body>",
}


@pytest.mark.parametrize("body", BODIES)
@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(layout, body):
    """All of the main text and nothing else, whatever is around it and in it."""
    markup, text = BODIES[body]
    page = LAYOUTS[layout].replace("L", LINKS, 1).replace("L<", f"{LINKS}<").replace("C<", f"{paragraphs(*range(20, 40))}<")
    assert extraction.main_text(page.replace("{}", markup)) == text


MAIN = "<p>This is the story of a long walk along the coast.</p><p>It ended well.</p>"
TEXT = "This is the story of a long walk along the coast. It ended well."


@pytest.mark.parametrize(
    "page, text",
    [
        (MAIN, TEXT),
        (f"<nav>Home News</nav>{MAIN}<footer>About us, and much more of us</footer>", TEXT),
        (f"<div class='site-header'>The daily coast paper</div><main>{MAIN}</main>", TEXT),
        (f"<article>{MAIN}</article><div id=comments><p>I liked it very much indeed, thank you!</p></div>", TEXT),
        (f"<article>{MAIN}<aside>Read also this</aside></article><form>Mail <input></form>", TEXT),
        (f"<p class=notice>Please note our notice<article>{MAIN}</article>", TEXT),
        (f"<div style='display: none'>hidden words</div>{MAIN}", TEXT),
        (f"<title>Not me</title><script>if (a < b) document.write('<p>no</p>')</script>{MAIN}<style>p {{}}</style>", TEXT),
        (f"<!-- <p>no</p> -->{MAIN}<!-- no end", TEXT),
        ("<b>foo</b>bar&nbsp; x &amp; y&#33;<br>z", "foobar x & y! z"),
        ("1 < 2 and <a title='a > b'>more</a> words here <", "1 < 2 and more words here <"),
        ("plain\n text", "plain text"),
        ("", ""),
        (None, ""),
        ("<p></p> <div>", ""),
        ("<p", ""),
    ],
)
def test_pages(page, text):
    assert extraction.main_text(page) == text


@pytest.mark.parametrize("quote", ["'", '"'])
def test_long_attribute_values(quote):
    """A value of 10,000 characters that holds tags ends at its quote, and the class behind it counts."""
    value = "<p>words of a value</p> " * 420
    assert len(value) > 10_000
    assert extraction.main_text(f"<div data-x={quote}{value}{quote}>{MAIN}</div>") == TEXT
    aside = f"<div data-x={quote}{value}{quote} class=sidebar>Read this as well, it is long and good</div>"
    assert extraction.main_text(f"<article>{MAIN}</article>{aside}") == TEXT


def test_quotes_without_an_end_are_linear():
    start = time.time()
    for piece in ('<a ">" ', "<a '>' ", """<a '">"' """, """<a "'> """):
        extraction.main_text(piece * 50_000)
    assert time.time() - start < 20


def test_linear_in_length():
    start = time.time()
    for piece in ("<header>", "<article>x<div class=ad>y</div></article>", "<article>x", "<form><p>a b", "<", '<a "', "<div>", "</div>", "<script>", '<p "> x', "<!--", "word "):
        extraction.main_text(piece * 50_000)
    assert time.time() - start < 20


def test_nulls_and_repeats(spark):
    rows = [(1, "u", MAIN, "x"), (1, "u", MAIN, "x"), (None, None, None, None), (2, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert [tuple(r) for r in extraction.extract_text(pages).collect()] == [
        (1, "u", TEXT, len(TEXT)),
        (1, "u", TEXT, len(TEXT)),
        (None, None, "", 0),
        (2, "v", "", 0),
    ]
    assert extraction.extract_text(pages.limit(0)).count() == 0
