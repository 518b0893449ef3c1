"""op10: names of ids and headings drop nothing inside an article."""

from roadlens.llm import html_text as H

PROSE = "It is the end of the story and there is a moral that the reader has to find on his own in the text."
OTHER = "The words of the page are here and they are long enough to be a block of the text on its own."


def test_article_keeps_parts_named_by_words():
    page = f"""<article><p>{PROSE}</p><h2 id="discussion">Discussion</h2><p>{PROSE}</p><section id="discussion"><p>{OTHER}</p></section>
    <section class="related-work"><h2 class="social">Work</h2><p>{OTHER}</p><p><a href=1>{OTHER}</a></p></section><div class="legal notice"><p>{OTHER}</p></div>
    <div id="search"><p>Short</p></div><div class="related-posts"><p>{OTHER}</p></div><ul class="comments"><li>{OTHER}</ul><div class="ad">{OTHER}</div></article>"""
    assert H.main_text(page).split("\n") == [PROSE, "Discussion", PROSE, OTHER, "Work", OTHER, OTHER, "Short"]
