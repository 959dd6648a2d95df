"""Parsing of awkward pages: no main text lost by a name, and time in proportion to the page."""

import time

import pytest

from tidegate.llm.html_extract import main_text, outline


def text(page, gone=()):
    return main_text(*outline(page), set(gone))


@pytest.mark.parametrize(("page", "wanted"), [
    ('<div class="content has-sidebar"><p>Whole story.</p></div>', "Whole story."),
    ('<div id="page" class="no-sidebar"><p>Story.</p></div>', "Story."),
    ('<body class="comments-open"><p>Story.</p></body>', "Story."),
    ('<div class="comments-open"><p>Story.</p></div>', "Story."),
    ('<h2 class="section-header">Part</h2><p>Story.</p>', "Part\nStory."),
    ('<p class="notice-board">Board.</p><p>Story.</p>', "Board.\nStory."),
    ("<article><header><h1>Title</h1></header><p>Story.</p></article>", "Title\nStory."),
    ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>", "So x=2 holds."),
    ('<div class="sidebar"><p>All there is of the story.</p></div>', "All there is of the story."),
    ('<div class="ad">Buy</div><p>A longer story.</p>', "A longer story."),
    ('<header>Site</header><nav>Menu</nav><p>Story.</p><div role="banner">B</div><footer>F</footer>', "Story."),
    ('<p>a &lt;b&gt; <b>c</b><br>d</p><script>var x = "<p>no</p>";</script>', "a <b> c d"),
    ("<p>1 < 2 and <unclosed", "1 < 2 and <unclosed"),
    ("<p title='it>x</p><p>y</p>", "x\ny"),
    ("", ""),
])
def test_fragments(page, wanted):
    assert text(page) == wanted


def test_deleted_subtrees_take_what_is_inside(page="<div><section><p>gone</p></section></div><p>left</p>"):
    subtrees, parents, blocks = outline(page)
    assert parents == [-1, 0, 1, -1]
    assert main_text(subtrees, parents, blocks, {subtrees[1]}) == "left"


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "deep", "<" + "a" * 1_000_000, "<a \"" * 100_000, "<a '\"" * 100_000, "<a \">\" " * 100_000,
    "<b>" * 100_000 + "<p>" * 1_000, "<div>" * 50_000 + "</span>" * 50_000, "<p>x" * 100_000, "<" * 500_000, "<!--" * 100_000,
])
def test_time_in_proportion(page):
    started = time.monotonic()
    outline(page)
    assert time.monotonic() - started < 10
