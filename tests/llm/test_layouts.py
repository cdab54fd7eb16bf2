"""Page layouts of which a container's name says boilerplate and its text says article, and the other way round."""

from __future__ import annotations

import pytest

from tidemark.llm import html_text

PARTS = [f"Paragraph {i} tells at some length what happened on day {i} of the journey, and who was there to see it." for i in range(5)]
BODY = "".join(f"<p>{x}</p>" for x in PARTS)
NAV = "<nav><a href=/a>Home</a> <a href=/b>News</a></nav>"
FOOT = "<footer><p>All rights reserved by the owners of this site, who wrote a footer that is long enough to surge on its own.</p></footer>"
WRAPPERS = [
    '<div class="content-sidebar-wrap"><main>{}</main></div>',
    '<form id="aspnetForm"><div>{}</div></form>',
    '<div class="right-sidebar"><article>{}</article></div>',
    '<div class="ad-free reader">{}</div>',
    '<div class="search-engine-history">{}</div>',
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_article_in_a_container_with_a_boilerplate_name(wrapper):
    page = f"<html><body>{NAV}{wrapper.format(BODY)}{FOOT}</body></html>"
    assert html_text.main_text(page) == "\n".join(PARTS)
    inner = f"{NAV}{BODY}<div class=sidebar><p>Short notes beside the text.</p></div>{FOOT}"
    assert html_text.main_text(f"<html><body>{wrapper.format(inner)}</body></html>") == "\n".join(PARTS)


@pytest.mark.parametrize("name", ["comments", "sidebar", "newsletter"])
def test_long_boilerplate_beside_a_short_article(name):
    long = "".join(f"<p>{x} And more of it, and more.</p>" for x in PARTS * 4)
    page = f"<html><body>{NAV}<div id=content>{BODY}</div><div class={name}>{long}</div>{FOOT}</body></html>"
    assert html_text.main_text(page) == "\n".join(PARTS)
    comment = "".join(f"<article class=comment-body><p>{x}</p></article>" for x in PARTS * 4)
    page = f"<html><body><article>{BODY}</article><div class=comments>{comment}</div></body></html>"
    assert html_text.main_text(page) == "\n".join(PARTS)


def test_hidden_text_is_never_kept():
    page = f'<html><body><div style="display: none">{BODY}{BODY}</div><p>Short.</p></body></html>'
    assert html_text.main_text(page) == "Short."


def test_surge_and_dive_decide_beside_an_article():
    """Text beside the article is kept if it surges; a short line there is not, and links dive."""
    links = "".join(f"<div><a href=/{i}>link {i}</a></div>" for i in range(6))
    page = f"<html><body><div>Too short to surge</div>{links}<article>{BODY}</article>{links}<div><div>{PARTS[0]} Beside the article.</div></div>{links}</body></html>"
    text = html_text.main_text(page)
    assert "Too short" not in text and "link 1" not in text and text.endswith("Beside the article.") and PARTS[4] in text


def test_article_weight_decides_for_a_short_article():
    links = "".join(f"<div><a href=/{i}>link {i}</a></div>" for i in range(6))
    page = f"<html><body><div><article><p>A short piece.</p></article></div>{links}<div id=x><p>{PARTS[0]}</p></div></body></html>"
    assert html_text.main_text(page).startswith("A short piece.")
    assert html_text.main_text(page.replace("article>", "section>")) == PARTS[0]
