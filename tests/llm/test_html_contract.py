"""What is and what is not an article's text, one rule a test."""

import pytest

from eventide.llm import html_text
from tests.llm.test_operators import LONG, none, odd  # noqa: F401

P = f"<p>{LONG[:300].strip()}</p>"
WORDS = LONG[:300].strip()


def text_of(inside):
    return html_text.main_text(f"<html><body>{inside}</body></html>").split("\n")


@pytest.mark.parametrize("part,lines", [
    ('<section id="related-work"><h2>Related work</h2><p>One. ' + WORDS + "</p></section>", ["Related work", "One. " + WORDS]),
    ('<h2 id="cookies">Cookies</h2><p>Bake them.</p>', ["Cookies", "Bake them."]),
    ('<p>So <span class="ad">this</span> stays.</p>', ["So this stays."]),
    ('<p>Read <a class="social-link" href="x">the link</a> now.</p>', ["Read the link now."]),
    ("<p>See <a title=don't href=x>It's here</a> and on.</p>", ["See It's here and on."]),
    ('<section class="notice"><p>' + WORDS + "</p></section>", [WORDS]),
    ('<div class="with-sidebar no-comments"><p>Kept.</p></div>', ["Kept."]),
    ('<div class="post-header"><p>By me.</p></div>', ["By me."]),
    ("<header><p>In the article.</p></header>", ["In the article."]),
    ("<h2>Comments on Hegel</h2><p>Kept too.</p>", ["Comments on Hegel", "Kept too."]),
    ("<table><tr><td>a<td>b</table>", ["a", "b"]),
])
def test_article_text_stays(part, lines):
    assert text_of(f"<article><h1>Head</h1>{P}{part}{P}</article>") == ["Head", WORDS, *lines, WORDS]


COMMENTS = [
    '<section id="comments"><article class="comment"><p>{w}</p></article><article class="comment"><p>{w}</p></article></section>',
    '<div class="comment-list"><h1>Comments</h1><p>{w}</p></div>',
    '<ol class="replies"><li>{w}</li></ol>',
    '<div id="disqus_thread"><p>{w}</p></div>',
    '<div class="post-comments"><div><p>{w}</p></div></div>',
    '<div itemprop="comment"><p>{w}</p></div>',
    '<div itemscope itemtype="https://schema.org/Comment"><p>{w}</p></div>',
    '<div aria-label="comments"><p>{w}</p></div>',
    "<h2>3 Comments</h2><ul><li>{w}</li></ul>",
    "<h3>Kommentare (2)</h3><p>{w}</p>",
]
FURNITURE = [
    '<div class="sidebar"><article><h1>Teaser</h1><p>{w}</p></article></div>', '<div class="ad">Buy {w}</div>',
    '<div id="site-footer">{w}</div>', "<aside><p>{w}</p></aside>", "<footer>{w}</footer>", '<div class="cookie-notice">{w}</div>',
    '<nav><a href="/">{w}</a></nav>', '<div role="complementary"><p>{w}</p></div>', '<form><p>{w}</p></form>',
    '<ul class="social share-buttons"><li><a href="x">{w}</a></li></ul>', '<div class="adBox ad-unit-3">{w}</div>',
]


@pytest.mark.parametrize("part", COMMENTS + FURNITURE)
@pytest.mark.parametrize("place", ["inside", "behind", "before"])
def test_furniture_and_comments_go(part, place):
    part = part.format(w="Not the article. " + WORDS * 3)
    article = f"<h1>Head</h1>{P}{P}"
    page = {"inside": f"<article>{article}{part}</article>", "behind": f"<article>{article}</article><div>{part}</div>",
            "before": f"<div>{part}</div><article>{article}</article>"}[place]
    assert text_of(page) == ["Head", WORDS, WORDS]


def test_blocks_between_and_behind_a_headline_in_the_body():
    assert text_of(
        f"<div><a href=/a>Menu</a></div><h1>Head</h1><div class=lead>Short lead.</div><div class=text>{P * 5}</div><div>End.</div>"
        "<div>© 2024 Someone</div><div><a href=/>Home</a></div>"
    ) == ["Head", "Short lead.", *[WORDS] * 5, "End."]


def test_the_only_article_stays_whatever_holds_it():
    for holder in ('<div class="widget">', '<div id="sidebar">', '<div role="dialog">', '<section id="comments">'):
        assert text_of(f"{holder}<article><h1>Head</h1>{P}</article></div>") == ["Head", WORDS], holder
    assert text_of(f'<div class="header"><h1>Head</h1></div><div>{P * 4}</div>') == ["Head", *[WORDS] * 4]
    assert text_of(f'<div class="header"><h1>The site</h1></div><article><h1>Head</h1>{P * 4}</article>') == ["Head", *[WORDS] * 4]


def test_quotes_outside_values_are_characters():
    assert text_of("<p title=it's>a</p><p \"x>b</p><p title='x>y'>c</p><p x=\"un>d</p>") == ["a", "b", "c", "d"]


def test_data_frames(spark, odd, none):  # noqa: F811
    page = f"<body><article>{P}</article></body>"
    pages = spark.createDataFrame(
        [(1, page, "x", 5), (1, page, "x", 5), (2, None, None, None), (3, "", "", 0), (None, page * 200, "y", 1)],
        "page_id long, html string, text string, n_chars long",
    )
    got = pages.withColumn("main", html_text.extract("html"))
    assert got.columns == ["page_id", "html", "text", "n_chars", "main"]
    assert [len(r["main"].split("\n")) if r["main"] else 0 for r in got.collect()] == [1, 1, 0, 0, 200]
    assert pages.where("false").select(html_text.extract("html")).count() == 0
    assert odd.select(html_text.extract("text")).count() == 10 and none.select(html_text.extract("text")).count() == 0


def test_long_pages_take_time_in_proportion():
    import time

    def took(n):
        page = "<body><article>" + "<div class='x y'><p>It's <b>a</b> line = \"of\" words" * n + "</article>"
        start = time.process_time()
        assert html_text.main_text(page).count("\n") == n - 1
        return time.process_time() - start

    took(500)
    assert took(16_000) < 12 * took(4_000)
