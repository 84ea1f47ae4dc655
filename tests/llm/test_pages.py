"""Pages whose wrappers carry the names of frames."""

import pytest

from tapedeck.llm import html_text

ARTICLE = (
    "<h1>Title of it</h1><p>This is the first paragraph of a story, and it says something long enough to be read.</p>"
    "<p>Here is a second one, which goes on in the same way, with commas and an end.</p>"
)
TEXT = [
    "Title of it", "This is the first paragraph of a story, and it says something long enough to be read.",
    "Here is a second one, which goes on in the same way, with commas and an end.",
]
NAV, FOOT = "<nav><a href=x>Home</a> <a href=y>About us</a></nav>", "<footer>Copyright 2024 Site. <a href=z>Terms of use</a></footer>"
COMMENTS = '<div class="comments"><h3>Comments</h3><div class="comment"><p>Great article, thanks a lot for it, I really liked to read it.</p></div><p>Me too.</p></div>'
RELATED = '<aside class="related"><ul><li><a href=a>One other story of ours</a></li><li><a href=b>Two other stories of ours</a></li></ul></aside>'


def text_of(body):
    return html_text.main_text(f"<html><body>{body}</body></html>", html_text.PRIOR).split("\n")


@pytest.mark.parametrize("wrapper", ['form id="aspnetForm"', 'div id="top"', 'div class="sidebar-layout"', 'div class="comments-open"', 'section class="form ads"'])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrappers_with_the_names_of_frames_keep_their_article(wrapper, inner):
    tag = wrapper.split()[0]
    assert text_of(f"<{wrapper}>{NAV}<{inner}>{ARTICLE}</{inner}>{RELATED}{FOOT}</{tag}>") == TEXT


def test_frames_beside_and_inside_an_article_go():
    assert text_of(f"{NAV}<article>{ARTICLE}{RELATED}</article>{COMMENTS}{FOOT}") == TEXT
    assert text_of(f"{NAV}<article><header>{ARTICLE[:20]}</header>{ARTICLE[20:]}<div class='newsletter'>Subscribe to our letter now.</div></article>{FOOT}") == TEXT
    longer = "<p>Nobody but me has seen, I think, that this is a story without an end, and I say so at length.</p>" * 9
    assert text_of(f"<article>{ARTICLE}</article><div class='comments'>{longer}</div>{FOOT}") == TEXT
    cards = "<article class='teaser'><a href=c>Another story that you may like</a></article>" * 3
    assert text_of(f"<article>{ARTICLE}</article><aside>{cards}</aside>") == TEXT


def test_a_section_on_related_work_is_text_and_a_list_of_related_links_is_not():
    work = '<section class="related-work"><h2>Related work</h2><p>Others have written about this before, at some length, and with other ends.</p></section>'
    assert text_of(f"<article>{ARTICLE}{work}{RELATED}</article>") == [*TEXT, "Related work", "Others have written about this before, at some length, and with other ends."]
