"""Pages whose main text only density can tell, odd markup, and very long pages."""

import time

import pytest
from pyspark.sql import functions as F

from shoplens.llm import htmltext


def prose(k, n=1):
    return " ".join(f"Sentence {k}.{j} of a story that goes on for a while, with words enough to make a dense block." for j in range(n))


def links(n, word="link"):
    return "".join(f"<a href='/{word}{k}'>{word} {k}</a> " for k in range(n))


@pytest.mark.parametrize("page,want", [
    # Stray quotes in attributes and texts.
    (f"<body><p title=it's>{prose(1)}</p><p>And it's fine here. {prose(2)}</p></body>", [prose(1), f"And it's fine here. {prose(2)}"]),
    (f'<p data-x=5">{prose(1)}</p>', [prose(1)]), (f"<p a='>' b=\">\" c>{prose(1)}</p>", [prose(1)]),
    ("a < b and <3 <", ["a < b and <3 <"]), (f"<p>{prose(1)}</p><p title='never closed>{prose(2)}", [prose(1)]),
    # The header of an article, and one by its class.
    (f"<body><header>{links(9)}</header><article><header><h1>Title</h1></header><p>{prose(1)}</p></article></body>", ["Title", prose(1)]),
    (f"<article><div class='header'><p>{prose(1)}</p></div><p>{prose(2)}</p></article>", [prose(1), prose(2)]),
    # Several articles: teasers full of links stay out; one that is split is kept whole.
    (f"<body><article><h1>One</h1><p>{prose(1, 3)}</p><p>{prose(2, 3)}</p></article><article>{links(5)}</article><article>{links(4)}</article></body>",
     ["One", prose(1, 3), prose(2, 3)]),
    (f"<article><section><p>{prose(1, 5)}</p><p>{prose(2, 5)}</p></section><section><p>{prose(3, 5)}</p></section></article>",
     [prose(1, 5), prose(2, 5), prose(3, 5)]),
    # No article: lists of links of no telling class beside a story.
    (f"<body><div>{links(30)}</div><div><h2>Story</h2><p>{prose(1, 4)}</p><p>{prose(2, 4)}</p></div><div>{links(20, 'more')}</div></body>",
     ["Story", prose(1, 4), prose(2, 4)]),
    # Marked, but the story is elsewhere: marks only weigh.
    (f"<body><main>{links(12)}</main><div><p>{prose(1, 6)}</p><p>{prose(2, 6)}</p><p>{prose(3, 6)}</p></div></body>",
     [prose(1, 6), prose(2, 6), prose(3, 6)]),
    # Words in bold are no parts of the page.
    (f"<article><p><b>{prose(1, 9)}<br>{prose(2)}</b></p><p>Short end.</p></article>", [f"{prose(1, 9)} {prose(2)}", "Short end."]),
])
def test_pages(page, want):
    assert htmltext.main_text(page) == "\n\n".join(want)


def test_density_decides(monkeypatch):
    page = f"<body><div>{links(30)}</div><div><p>{prose(1, 4)}</p><p>{prose(2, 4)}</p></div></body>"
    want = htmltext.main_text(page)
    monkeypatch.setattr(htmltext, "density", lambda *a: 1.0)
    assert htmltext.main_text(page) != want


@pytest.mark.parametrize("page", ["<a " * 330_000, "<div>" * 100_000 + "</x>" * 100_000, "<b>" * 50_000 + "<div>" * 50_000 + "</b>" * 50_000,
                                  "<!--" * 250_000, "<p title='" * 100_000, "<ul><li>" * 60_000, "&amp" * 250_000])
def test_a_megabyte_of_open_tags_takes_seconds(page):
    begun = time.process_time()
    htmltext.main_text(page)
    assert time.process_time() - begun < 20


def test_deep_nesting_loses_no_text():
    page = "<div>" * 3000 + f"<p>{prose(1)}</p>" + "</div>" * 3000 + f"<p>{prose(2)}</p>"
    assert prose(1) in htmltext.main_text(page)


def test_long_pages_in_a_table(spark):
    pages = spark.createDataFrame([(1, "u", f"<article><p>{prose(1, 20_000)}</p></article>"), (None, None, None)], "page_id long, url string, html string")
    got = htmltext.extract(pages).orderBy(F.desc("n_chars")).collect()
    assert got[0]["text"] == prose(1, 20_000) and tuple(got[1]) == (None, None, "", 0)
