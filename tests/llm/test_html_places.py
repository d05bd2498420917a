"""Which places of a page hold its text: class words, deep pages, templates of neutral class names."""

import time

import pytest

from paritas.llm import html_template

LONE = {"main": [">div[class=layout with-sidebar]>article", ">article", ">html>body>article"], "parts": [], "constant": []}


def text_of(spark, pages):
    rows = [(k, f"http://h{k % 1}.org/{k}", p) for k, p in enumerate(pages)]
    got = html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in got}


@pytest.mark.parametrize("page, text", [
    ('<div class="layout with-sidebar"><article><p>One.</p></article></div>', "One."),
    ('<article><h1>H</h1><div class="alert-story"><p>Two.</p></div><p class="share">Three.</p></article>', "H Two. Three."),
    ('<article><p>A</p><div class="ad-slot">buy</div><div class="share-buttons">f t</div><ol class="comments"><li>me too</li></ol></article>', "A"),
    ('<article><p>A</p><div id="newsletter"><p>join</p></div><section class="breaking-notice-board"><p>B</p></section></article>', "A B"),
    ('<div class="related"><article>teaser</article></div><article>Story</article>', "Story"),
    ('<nav><article>menu</article></nav><article>Story</article>', "Story"),
    ('<div class="menu">m</div><div class="post-body"><p>Plain &amp; simple</p></div><footer>f</footer>', "Plain & simple"),
])
def test_class_words_never_cost_the_article(spark, page, text):
    assert text_of(spark, [page]) == {0: text}


def test_neutral_class_names_without_article(spark):
    """The template, not any word, tells the frame from the text."""
    page = lambda k: (f'<div class="x1"><a href="/">Home</a> <a href="/b">World news of today</a></div><div class="x2"><p>Story {k} begins here.</p><p>And ends {k * k}.</p></div>'
                      f'<div class="x3">All rights with the house of x</div>')
    got = text_of(spark, [page(k) for k in range(12)])
    assert got == {k: f"Story {k} begins here. And ends {k * k}." for k in range(12)}


@pytest.mark.parametrize("name", ["div", "font", "li", "p", "article"])
def test_deep_pages(spark, name):
    page = f"<{name}>" * 20_000 + "in the deep" + "<p>more</p>" * 3
    start = time.process_time()
    assert html_template.main_text(page, html_template.deduce([])) == "in the deep more more more"
    tokens = html_template.page_tokens(page)
    assert len(tokens) < 3000 and time.process_time() - start < 20
    assert text_of(spark, [page]) == {0: "in the deep more more more"}


def test_time_is_linear_in_open_elements():
    took = []
    for n in (4_000, 16_000):
        page = "<font>".join(f"word {k} " for k in range(n))
        start = time.process_time()
        html_template.page_tokens(page)
        html_template.main_text(page, html_template.deduce([]))
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0] + 1


def test_long_page(spark):
    page = "<article>" + "".join(f"<p>Line {k} of the page.</p>" for k in range(60_000)) + "</article>"
    assert text_of(spark, [page])[0].count("Line") == 60_000
