"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags.  Pass 1 decides blocks: menus,
headers, footers, asides, forms, notices, adverts and comments (by element,
role or class) are bad; blocks of links are bad; in the article or main
element other blocks are good; elsewhere long blocks with stop words are good,
long ones without are bad, and short ones stay open.  Pass 2 gives each open
block the label of its nearest decided neighbours in the page (good when both
sides or the nearer side are good; a page without any decided block keeps
its text).  If a page names an article or main
element with text, blocks outside it are bad.

Per-page work only: Spark partitions the pages, no shuffle.  The scanner is
linear in the length of a page; a page is held once, as its blocks.

Defined results: null or empty html gives an empty text; markup cut off at the
end of a page is dropped; null ids and urls pass through; repeated rows give
repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

SHORT = 60            # characters: shorter blocks outside an article stay open
STOP_DENSITY = 0.12   # share of stop words from which a long block is prose
LINK_DENSITY = 0.5    # share of characters in links from which a block is a menu

#: Frequent function words of the languages of the corpus.
STOP_WORDS = frozenset((
    "a an and are as at be by for from has he in is it not of on or that the this to was were which with you "
    "au aux avec ce dans de des du elle en est et il la le les mais ne ou par pas pour que qui se sur un une "
    "als auf aus bei das dem den der des die ein eine er es für im ist mit nicht sich sie sind und von zu zum "
    "al como con del el en es la las lo los más no para pero por que se si sin su un una y"
).split())
RAW = {"script", "style", "template", "noscript", "iframe", "svg", "canvas", "object", "textarea", "title", "select", "option", "button", "video", "audio", "head"}
SKIPPED = {"nav", "footer", "aside", "form", "menu", "dialog"}
CONTENT = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar"}
#: Class and id words of parts that are never the article ...
FIRM = frozenset((
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr comment comments commentlist "
    "respond replies disqus related recommended recommendations newsletter subscribe signup login popup modal breadcrumb breadcrumbs pagination pager "
    "share sharing social copyright hidden responses discussion reactions reply guestbook subscription paywall partner partners tracking"
).split())
#: ... and of parts that may still wrap it.
LOOSE = frozenset("nav navbar navigation menu sidebar header footer masthead topbar toolbar notice notices alert banner widget legal disclaimer search".split())
#: Inside an article whole class names count, ids do not: parts that are dropped there ...
INSIDE = frozenset((
    "ad ads adbox advert adverts advertisement advertising adsbygoogle ad-banner ad-container ad-slot ad-unit ad-wrapper sponsor sponsored promo "
    "cookie-banner cookie-notice cookies comment comments commentlist comment-list comments-list comment-thread comment-section comments-section "
    "comments-area post-comments respond replies disqus alert "
    "related-articles related-links related-posts recommended recommendations newsletter newsletter-signup subscribe signup login popup modal "
    "breadcrumb breadcrumbs pagination pager share sharing share-buttons social-links social-share hidden paywall guestbook "
    "nav navbar navigation menu sidebar footer masthead topbar toolbar site-notice"
).split())
#: ... and of parts that are the article where no such element is used.
GOOD = frozenset("article articlebody content entry main post story".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME = re.compile(r"[a-z0-9]+")


@dataclass
class Frame:
    tag: str
    drop: bool = False   # its text is not the article
    firm: bool = False   # ... whatever it wraps
    content: bool = False
    doubt: bool = False  # named like another part inside the article: its blocks decide

    @property
    def loose(self) -> bool:
        """Dropped for its name alone: an article inside shows that it is none."""
        return self.drop and not self.firm and self.tag not in SKIPPED


@dataclass
class Block:
    text: str
    link_chars: int
    dropped: bool
    inside: bool
    doubt: bool = False
    label: bool | None = None


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    frames: list[Frame] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    in_link: int = 0
    # frames that are open: by tag, and how many drop, loosely drop, hold the article, are in doubt, mute
    tags: Counter = field(default_factory=Counter)
    marks: Counter = field(default_factory=Counter)

    def count(self, frame: Frame, by: int) -> None:
        self.tags[frame.tag] += by
        self.marks["drop"] += by * frame.drop
        self.marks["loose"] += by * frame.loose
        self.marks["content"] += by * frame.content
        self.marks["doubt"] += by * frame.doubt
        self.marks["mute"] += by * (frame.drop and frame.tag == "span")  # inside a line: left out without ending the block

    def cut(self, at: int) -> None:
        """Close the frames from place ``at`` on."""
        for frame in self.frames[at:]:
            self.count(frame, -1)
        del self.frames[at:]

    def add(self, raw: str) -> None:
        if self.marks["mute"]:
            return
        text = _html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.in_link:
            self.link_chars += len(text)

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, self.link_chars, *(self.marks[m] > 0 for m in ("drop", "content", "doubt"))))
            self.parts, self.link_chars = [], 0

    def open(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.in_link = 1
        elif tag == "br":
            self.parts.append(" ")
        if tag not in BLOCKS:
            if attributes and tag not in VOID and tag == "span":
                self.push(tag, attributes)
            return
        self.end_block()
        if self.frames and self.frames[-1].tag == "p":
            self.cut(len(self.frames) - 1)  # a block ends an open paragraph
        if tag == "li":
            for k in range(len(self.frames) - 1, -1, -1):
                if self.frames[k].tag in ("ul", "ol", "menu"):
                    break
                if self.frames[k].tag == "li":
                    self.cut(k)
                    break
        if tag not in VOID:
            self.push(tag, attributes)

    def push(self, tag: str, attributes: str) -> None:
        frame = Frame(tag, drop=tag in SKIPPED, content=tag in CONTENT)
        if tag == "header" and not self.marks["content"]:
            frame.drop = True
        if attributes.strip(" /"):
            self.hints(frame, attributes)
        if frame.content and not frame.drop and self.marks["loose"]:
            for f in self.frames:  # what wraps the article was named for another part
                if f.loose:
                    self.count(f, -1)
                    f.drop = False
                    self.count(f, 1)
        self.count(frame, 1)
        self.frames.append(frame)

    def hints(self, frame: Frame, attributes: str) -> None:
        names: set[str] = set()
        classes: set[str] = set()
        for m in _ATTR.finditer(attributes):
            key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
            if key == "class":
                classes.update(value.split())
            if key in ("class", "id"):
                for token in value.split():
                    words = set(_NAME.findall(token))
                    if words & GOOD and not words & (LOOSE | FIRM):
                        names.add("")  # a name of the article itself
                    elif not words & {"has", "with", "no", "without"}:
                        names |= words
            elif key == "role":
                frame.drop |= value in ROLES
                frame.content |= value == "main"
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
                frame.drop = frame.firm = True
            elif key == "itemprop" and value == "articlebody":
                frame.content = True
        if frame.tag in ("html", "body"):
            frame.drop = frame.firm = False
        elif self.marks["content"]:
            if classes & INSIDE:
                frame.drop = frame.firm = True
            elif not frame.drop and frame.tag[0] != "h":
                frame.doubt = any(words & (FIRM | LOOSE - {"header"}) for words in (set(_NAME.findall(c)) for c in classes))
        elif names & FIRM:
            frame.drop = frame.firm = True
        elif "" in names and frame.tag in ("div", "section", "td"):
            frame.content = True
        elif names & LOOSE and frame.tag not in CONTENT:
            frame.drop = True

    def close(self, tag: str) -> None:
        if tag == "a":
            self.in_link = 0
        if tag not in BLOCKS and tag != "span":
            return
        if tag in BLOCKS:
            self.end_block()
        if not self.tags[tag] or tag == "span" and self.frames[-1].tag != "span":
            return  # never opened, or a block stands open inside
        self.cut(next(k for k in range(len(self.frames) - 1, -1, -1) if self.frames[k].tag == tag))


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, with what pass 1 needs."""
    out, at, n = Page(), 0, len(page)
    unclosed: set[str] = set()  # elements without a closing tag further on: searched for once
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            out.add(page[at:])
            break
        if lt > at:
            out.add(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page[lt + 1:lt + 2] in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt)
        if m is None:
            if page[lt + 1:lt + 2].isalpha() or page[lt + 1:lt + 2] == "/" or lt + 1 == n:
                end = page.find(">", lt)  # a quote that never closes, or a page cut off in a tag
                at = n if end < 0 else end + 1
            else:
                out.add("<")
                at = lt + 1
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            out.close(tag)
        elif tag in RAW and not m[3].endswith("/"):
            end = None if tag in unclosed else re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
            if end is None:
                unclosed.add(tag)
            if tag == "title" or tag == "head" or end is None and tag in ("script", "style"):
                at = (at if tag == "head" else n) if end is None else at if tag == "head" else end.end()
            else:
                at = at if end is None else end.end()
        else:
            out.open(tag, m[3])
    out.end_block()
    return out.blocks


def decide(found: list[Block]) -> None:
    """Pass 1: label what can be decided from the block itself."""
    article = any(b.inside and not b.dropped for b in found)
    for b in found:
        links = b.link_chars / len(b.text)
        if b.dropped or article and not b.inside:
            b.label = False
        elif links > LINK_DENSITY and (not b.inside or links > 0.9 and len(b.text) < SHORT):
            b.label = None if b.inside else False
        elif b.doubt and (links > LINK_DENSITY or len(b.text) < SHORT):
            b.label = False if links > LINK_DENSITY else None
        elif b.inside:
            b.label = True
        elif len(b.text) >= SHORT:
            words = re.findall(r"\w+", b.text.lower())
            stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
            b.label = stops >= STOP_DENSITY or len(b.text) >= 4 * SHORT and links < 0.1 and b.text[-1] in ".!?\"'»”"


def inherit(found: list[Block]) -> None:
    """Pass 2: open blocks take the label of the nearest decided neighbours."""
    n = len(found)
    before: list[tuple[int, bool | None]] = []
    last: tuple[int, bool | None] = (-1, None)
    for i, b in enumerate(found):
        before.append(last)
        if b.label is not None:
            last = (i, b.label)
    after: tuple[int, bool | None] = (n, None)
    for i in range(n - 1, -1, -1):
        b = found[i]
        if b.label is not None:
            after = (i, b.label)
            continue
        (left, left_label), (right, right_label) = before[i], after
        if left_label is None and right_label is None:
            b.label = True  # nothing on the page could be decided: its text is all there is
        elif left_label is None or right_label is None:
            b.label = bool(left_label or right_label)
        else:
            b.label = left_label if i - left < right - i else right_label if right - i < i - left else left_label or right_label


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    decide(found)
    inherit(found)
    return "\n".join(b.text for b in found if b.label)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
