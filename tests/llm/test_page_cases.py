"""Pages that earlier rules got wrong, and pages that took more than linear time."""

import time

import pytest

from roadlens.llm import html_text as H

PROSE = "It is the end of the story and there is a moral that the reader has to find on his own in the text."
OTHER = "The words of the page are here and they are long enough to be a block of the text on its own."


def test_a_page_without_a_decided_block_keeps_its_text():
    assert H.main_text("<div><h1>Head</h1><p>Short one.</p></div>") == "Head\nShort one."
    assert H.main_text("<nav><a href=x>Home</a></nav><p>Short one.</p>") == ""


def test_comments_and_notices_inside_the_main_element():
    page = f"<main><p>{PROSE}</p><ul class=\"comment-thread\"><li>{OTHER}</li></ul><div class=alert>{OTHER}</div><p>End.</p></main>"
    assert H.main_text(page) == f"{PROSE}\nEnd."


def test_an_advert_inside_a_line_leaves_the_line_whole():
    page = f"<article><p>One <span class=\"ad\">buy <b>now</b></span>two.</p><p>x <math><mi>a</mi><mo>+</mo><mi>b</mi></math></p><p>{PROSE}</p></article>"
    assert H.main_text(page) == f"One two.\nx a+b\n{PROSE}"
    page = f"<article><p>One <span class=ad>buy<div>more</div></span></p><p>{PROSE}</p></article>"
    assert PROSE in H.main_text(page)


@pytest.mark.parametrize("page", [
    "<option>" * 64_000, "<video>" * 64_000, '<div><span class="x">' * 40_000 + PROSE, "<div>" * 40_000 + PROSE + "</div>" * 40_000,
    "</b></span></div>" * 40_000, '<nav class="menu">' * 20_000 + "<article>" * 20_000 + PROSE, "<li>" * 60_000 + PROSE, "<p>" * 60_000,
    f"<article><p>{PROSE} </p>" * 20_000, f"<p>{PROSE} <a href=x>{OTHER}</a></p>\n" * 25_000,
], ids=range(10))
def test_long_pages_in_linear_time(page):
    begun = time.process_time()
    H.main_text(page)
    assert time.process_time() - begun < 10
