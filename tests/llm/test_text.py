import hashlib
import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from roadlens.llm import html_text as H
from roadlens.llm import line_dedup as L
from roadlens.llm import pii as P

from .test_lines_whole import without_copies


def plain_spans(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], P.KINDS.index(s[0])))


def test_base_spans():
    r = random.Random(2)
    parts = list("ab1234567890@..+-() ") + ["a.b@c.d", "+1 (743) 555-3824", "10.0.0.1", "4111 1111 1111 1111", "é"]
    for _ in range(8000):
        t = "".join(r.choice(parts) for _ in range(r.randint(1, 40)))
        assert P.base_spans(t) == plain_spans(t), t


def test_base_spans_are_linear_in_hard_texts():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 200_000, "+" * 200_000, "a@" * 200_000, "1 " * 200_000):
        P.base_spans(t)


def test_gradient():
    draw = np.random.default_rng(0)
    ids, tags = draw.integers(0, 130, (3, 6)), np.array([[0, 1, 2, 2, 0, 0], [0, 0, 3, 4, 4, 0], [5, 6, 0, 7, 8, 8]])
    t = P.Tagger.fresh()
    t.params = {k: v.astype(np.float64) for k, v in t.params.items()}
    _, g = t.gradient(ids, tags)
    for name, v in g.items():
        at = (ids[0, 1], 3) if name == "embed" else (0, 0) if name == "trans" else tuple(draw.integers(0, s) for s in v.shape)
        kept, diff = t.params[name][at], []
        for e in (1e-5, -1e-5):
            t.params[name][at] = kept + e
            diff.append(t.gradient(ids, tags)[0])
        t.params[name][at] = kept
        assert abs((diff[0] - diff[1]) / 2e-5 - v[at]) < 1e-5, name


def test_large_groups_inside_a_row(spark):
    r = random.Random(8)
    sets = [sorted(r.sample(range(40), r.randint(8, 12))) for _ in range(120)]
    sets += [sorted(set(s) ^ {s[0], 50 + k % 7}) for k, s in enumerate(sets)]
    df = spark.createDataFrame([(1, k, s) for k, s in enumerate(sets)], "key long, lid long, set array<long>")
    up = list(range(len(sets)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            both = len(set(sets[a]) & set(sets[b]))
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    assert {(x.a, x.b) for x in L._within(df).collect()} == {(k, find(k)) for k in range(len(up)) if find(k) != k}


@pytest.fixture(scope="module")
def tagger(spark):
    return P.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_tagger_adds_rewritten_spans_and_spares_other_numbers(tagger):
    texts = ["call me at (743) 555-3824 today", "or 743-555-3824 now", "in 2024-01-02 10:11:12 the 3 men",
             'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" and', "pages 100 200 300 400", "version 4.0 of 1999"]
    base, both = P.all_spans(texts, tagger)
    assert base == [[]] * 6
    assert [[(k, t[a:b]) for k, a, b in s] for t, s in zip(texts, both)] == [[("phone", "(743) 555-3824")], [("phone", "743-555-3824")], [], [], [], []]


def test_region_scores_do_not_depend_on_window_borders(tagger):
    text = "er in the " * 9 + "call (743) 555-3824 " + "on to the " * 9
    for shift in range(0, 40, 5):
        t = "x" * shift + " 1 " + text
        assert ("phone", "(743) 555-3824") in [(k, t[a:b]) for k, a, b in P.all_spans([t], tagger)[1][0]]


def test_documents_with_personal_data(spark, odd, odd_rows, empty, tagger):
    got = P.detected(odd, tagger).collect()
    want = []
    for i, t in odd_rows:
        s = plain_spans(t or "")
        n = Counter(k for k, _, _ in s)
        want.append((i, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(P.written(s).encode()).hexdigest()))
    assert sorted([tuple(r)[:6] for r in got], key=str) == sorted(want, key=str)
    assert P.detected(empty, tagger).count() == 0 and P.fit(empty) is None
    assert all(set(r.spans.split(",")) >= set(x for x in q.spans.split(",")) for r, q in zip(sorted(got, key=str), sorted(P.detected(odd, None).collect(), key=str)))


def article(page):
    m = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    out = []
    for part in re.split(r"</?(?:p|h1)>", m[1] if m else ""):
        text = " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", part.replace("<br>", " "))).split())
        out += [text] * bool(text)
    return "\n".join(out)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in H.extracted(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id] == (r.url, article(r.html), len(article(r.html)))


PROSE = "It is the end of the story and there is a moral that the reader has to find on his own in the text."
OTHER = "The words of the page are here and they are long enough to be a block of the text on its own."


def test_page_without_an_article_element():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <div id="cookie-notice"><p>{OTHER}</p></div><nav><a href=/>Home</a></nav>
    <h2>Story</h2><p>{PROSE}</p><p>Short.</p><ul><li>one<li>two</ul><p>{PROSE} &amp; &eacute;&#33;</p>
    <div class="links"><a href=1>{OTHER}</a></div>
    <aside>{OTHER}</aside><section class="comments"><article class="comment"><p>{OTHER}</p></article></section>
    <form><p>{OTHER}</p></form><footer><p>{OTHER}</p></footer><script>var a = '<p>{OTHER}</p>';</script></body></html>"""
    assert H.main_text(page) == f"Story\n{PROSE}\nShort.\none\ntwo\n{PROSE} & é!"


def test_page_with_wrappers_named_like_other_parts():
    page = f"""<div class="page-header with-sidebar"><main><p>{PROSE}<p>Short <b>bold</b><br>line</p><div class="ad">{OTHER}</div>
    <p class="share">{OTHER}</p><div class="entry-header"><h2>Part</h2></div><div class="site-notice">{OTHER}</div><div class="menu">{OTHER}</div><p>Last</p></main><div id="sidebar"><p>{OTHER}</p></div></div>"""
    assert H.main_text(page) == f"{PROSE}\nShort bold line\nPart\nLast"


def test_short_blocks_follow_the_nearest_decided_block():
    page = f"<p>a</p><div><a href=x>{OTHER}</a></div><p>near the menu</p><p>x</p><p>y</p><p>near the prose</p><p>{PROSE}</p><p>after</p>"
    assert H.main_text(page).split("\n")[-3:] == ["near the prose", PROSE, "after"]
    assert "near the menu" not in H.main_text(page)


def test_broken_pages(spark):
    assert H.main_text(None) == H.main_text("") == H.main_text("<p") == H.main_text("<!--") == H.main_text("<script>x") == ""
    assert H.main_text(f"<article><p>{PROSE}</p><p>{OTHER[:20]}") == f"{PROSE}\n{OTHER[:20]}"
    assert H.main_text(f"<article><p>1 < 2 & 3 &am</p><p title=\"a > b\">{PROSE}</p></articl") == f"1 < 2 & 3 &am\n{PROSE}"
    H.main_text("<" * 100_000)
    H.main_text('<p a="' * 20_000)
    pages = spark.createDataFrame([(1, None, None, 5), (None, "u", f"<article>{PROSE}", 6), (1, None, None, 5)], "page_id long, url string, html string, text long")
    assert sorted(map(tuple, H.extracted(pages).collect()), key=str) == sorted([(1, None, "", 0), (None, "u", PROSE, len(PROSE)), (1, None, "", 0)], key=str)
    assert H.extracted(pages.where("false")).count() == 0


def test_lines(odd, odd_rows, empty, small):
    for df, rows in ((odd, odd_rows), (small, [(r.doc_id, r.text) for r in small.collect()])):
        got = L.deduplicated(df).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=str) == without_copies(rows)
        assert all(r.n_lines - r.n_dropped == (len(r.text.split("\n")) if r.text or not r.n_dropped else 0) for r in got)
    assert L.deduplicated(empty).count() == 0


def test_lines_in_large_bands(spark, monkeypatch):
    """Many near copies of few lines: bands above SMALL are dealt into blocks."""
    monkeypatch.setattr(L, "SMALL", 4)
    monkeypatch.setattr(L, "FINE", 6)
    r = random.Random(6)
    names = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    passage, rows = [r.choice(names) for _ in range(150)], []
    for k in range(60):
        line = list(passage)
        line[r.randrange(150)] = r.choice(names)  # a near copy
        rows.append((k, " ".join(line)))
    for k in range(60, 120):  # the same passage between words of its own: not alike
        rows.append((k, " ".join([r.choice(names) for _ in range(60)] + passage + [r.choice(names) for _ in range(60)])))
    got = L.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == without_copies(rows)
