"""Pages nested without bound, and paragraphs with telling names."""

import pytest

from staylink.llm.extract import DEEP, main_text


@pytest.mark.parametrize("n", [DEEP - 2, DEEP, DEEP + 1, 2000, 100_000])
def test_deep_pages_keep_their_text(n):
    assert main_text("<div>" * n + "x") == "x"
    assert main_text("<article>" + "<div>a" * 3 + "<div>" * n + "<p>b</p>c<nav>menu <p>item</p></nav><p>d <b>e</b> f</p>" + "</div>" * n + "</article>") == "a a a b c d e f"


def test_order_of_deep_text():
    assert main_text("<div>" * 1000 + "<p>one <b>two</b> three</p><p>four</p> five") == "one two three four five"


def test_compound_names_of_paragraphs():
    page = '<article><p class="share-price">The price rose.</p><p class="social-history">They met.</p><p class="share">Tweet</p></article>'
    assert main_text(page) == "The price rose. They met."
    assert main_text('<div><p class="share-bar">Tweet</p><p>Text</p></div>') == "Text"
