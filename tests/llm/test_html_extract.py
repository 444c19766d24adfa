"""HTML extraction: exhaustive minimum cuts, parsing cases, and pages of several makes."""

import random
from itertools import product

import pytest

from tripmart.llm import html_extract as hx


def cost(scores, edges, labels):
    return sum(abs(s) for s, x in zip(scores, labels, strict=True) if (s > 0) != x and s) + sum(w for a, b, w in edges if labels[a] != labels[b])


def test_minimum_cut():
    r = random.Random(9)
    for _ in range(400):
        n = r.randint(0, 9)
        scores = [r.randint(-6, 6) for _ in range(n)]
        edges = [(*r.sample(range(n), 2), r.randint(0, 5)) for _ in range(r.randint(0, 14))] if n > 1 else []
        got = hx.minimum_cut(scores, edges)
        assert cost(scores, edges, got) == min(cost(scores, edges, x) for x in product((False, True), repeat=n))


def test_long_chain():
    scores = [(-1) ** i * (i % 7) for i in range(20000)]
    assert len(hx.minimum_cut(scores, [(i, i + 1, 3) for i in range(19999)])) == 20000


LONG = "Some running prose that goes on for quite a while, with enough words in it to look like a paragraph of an article and not like a button or a label."

PAGE = f"""<!DOCTYPE html><html><head><title>No title</title><meta charset=utf-8><style>p{{x}}</style></head><body class="has-sidebar">
<header class=site><a href=/>Site</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div id="cookie-notice">We use cookies. {LONG}</div><div class="layout">
<article><header><h1>The&nbsp;title</h1></header><p>First &amp; {LONG}<p>Second<br>line <b>bold <i>both</b></i> end.<div class="ad">Buy now! {LONG}</div>
<script>var t="</p>";document.write("<p>no</p>")</script><!-- <p>no</p> --><ul><li>item one<li>item two</ul>
<form action=x><label>Name <input name=a></label><button>Go</button></form><p hidden>unseen</p><p>Third &#x41;&#66;.</p>
<section class="comments"><h2>Comments</h2><p>{LONG} said a reader</p></section></article>
<aside><p>{LONG}</p></aside></div><footer>&copy; 2020 {LONG}</footer></body></html>"""


def test_page():
    assert hx.main_text(PAGE)[0] == f"The title First & {LONG} Second line bold both end. item one item two Third AB."


def test_page_without_semantic_elements():
    page = f'<div id="menu"><a href=1>Home</a> <a href=2>About us</a></div><div><div>{LONG}</div><div>Short.</div><div>{LONG}</div></div><div class="footer-links"><a href=3>Terms</a></div>'
    assert hx.main_text(page)[0] == f"{LONG} Short. {LONG}"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("<nav>only</nav>", ""),
    ("<article>a<br>b<p>c<p cla", "a b c"), ("<article><p>x &lt; y &unknown; 1 < 2 <3</p>", "x < y &unknown; 1 < 2 <3"),
    ("<ARTICLE><P>Up</P></ARTICLE></div></p>after", "Up"), ("<article><p title='a>b' data-x=\"<p>\">ok</p>", "ok"),
    ("<article><p>cut <script>never closed <p>no", "cut"), ("<article>a<!-- open comment <p>no", "a"), ("<article>a<!-->b<!--->c", "abc"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"), ("<article>in<b>li</b>ne &eacute;&#233;", "inline éé"),
    ("<article><template><p>no</p></template><noscript>no</noscript><p style='display: none'>no</p>yes", "yes"),
])
def test_cases(page, text):
    assert hx.main_text(page)[0] == text


def test_unclosed_quotes_are_linear():
    assert isinstance(hx.main_text('<a title="x ' * 3000)[0], str)
    assert isinstance(hx.main_text("<" * 50000 + "<p>" * 20000)[0], str)


def test_frames(spark):
    rows = [(1, "u", PAGE, "x"), (None, None, None, "y"), (1, "u", PAGE, "x"), (2 ** 60 + 1, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((x.page_id or 0, x.url, x.text, x.n_chars) for x in hx.extract(pages).collect()), key=str)
    text = hx.main_text(PAGE)[0]
    assert got == sorted([(0, None, "", 0), (1, "u", text, len(text)), (1, "u", text, len(text)), (2 ** 60 + 1, "v", "", 0)], key=str)
    assert hx.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("start", [
    "<html><head><title>x</title>", "<html><head><meta charset=utf-8><style>p{}</style><script>var a</script>\n<link rel=x>\n", "<head>\n<!-- c --><template><p>no</p></template><noscript>no</noscript>",
    "<html><head hidden><title>x</title>", "<!DOCTYPE html><html><head><title>x</title></head>", "<html><head><title>x</title><body>", "<head><title>x</title></head><body>",
])
def test_head_without_end_tag(start):
    for body in (f"<p>{LONG}</p><p>{LONG}</p>", f"<article><p>{LONG}<p>{LONG}</article>", f"{LONG}<p>{LONG}", f"<span>{LONG}</span> <p>{LONG}", f"<img src=a>{LONG}<hr>{LONG}"):
        assert hx.main_text(start + body)[0] == f"{LONG} {LONG}", body


WORDS = " ".join(f"word{i}" for i in range(40))
SAID = " ".join(f"said{i}" for i in range(25))


@pytest.mark.parametrize("page, want", [
    # Comments inside the article's own element.
    (f"<main id=main><article class=post><h1>Title</h1><p>{WORDS}</p><div id=comments class=comments><p>{SAID}</p><p>{SAID}</p></div></article></main>", f"Title {WORDS}"),
    # Advert and newsletter between the paragraphs of good containers.
    (f"<main class=content><article class=post><div class=entry-content><p>{WORDS}</p><div class=advert><p>{SAID}</p></div><p>{WORDS}</p>"
     f"<div class=newsletter-signup><p>{SAID}</p></div><p>{WORDS}</p></div></article></main>", f"{WORDS} {WORDS} {WORDS}"),
    # A form around the whole page; one inside it is still a form.
    (f"<form id=aspnetForm><div class=nav><a href=/>Home</a></div><div id=main><p>{WORDS}</p><p>{WORDS}</p></div><div class=footer>{SAID}</div></form>", f"{WORDS} {WORDS}"),
    (f"<div id=main><p>{WORDS}</p><form><p>{SAID}</p></form></div>", WORDS),
    # The article's own list of links.
    (f"<div class=entry-content><p>{WORDS}</p><ul><li><a href=a>first link</a></li><li><a href=b>second link</a></li></ul><p>{WORDS}</p></div>", f"{WORDS} first link second link {WORDS}"),
    # A wrapper named after the sidebar that it holds.
    (f"<div class=sidebar-layout><main><h1>Title</h1><p>{WORDS}</p><p>{WORDS}</p></main><aside>{SAID}</aside></div>", f"Title {WORDS} {WORDS}"),
    # More comments than article.
    (f"<article><h1>Title</h1><p>{WORDS}</p></article><section class=comments>" + f"<article class=comment><p>{SAID}</p></article>" * 12 + "</section>", f"Title {WORDS}"),
    # A header inside the article is its heading, outside it is the site's.
    (f"<header><p>{SAID}</p></header><main><header><h1>Title</h1></header><p>{WORDS}</p></main>", f"Title {WORDS}"),
])
def test_layouts(page, want):
    assert hx.main_text(f"<html><body>{page}</body></html>")[0] == want


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "x", "<div>a" * 20_000, "<b>" * 50_000 + "a" + "<p>b" * 1000, "<ul>" + "<div>" * 20_000 + "<li>x" * 5000, ("<p>" + "<i>" * 5000) * 20])
def test_time_grows_with_length_however_deep(page):
    import time
    begin = time.perf_counter()
    hx.main_text(page)
    assert time.perf_counter() - begin < 5
