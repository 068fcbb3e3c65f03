import random
import time

import numpy as np
import pytest

from tallycheck.llm.html_blocks import extract, main_text, stretches

LONG = "This paragraph has quite a few words, so that its line is long enough to be text of an article and not of a menu. "

CASES = [
    ("", ""),
    ("plain text only", "plain text only"),
    ("<article><p>Tiny.</p></article>", "Tiny."),
    ("<article><h1>A &amp; B</h1><p>x\n\t y&nbsp;z<p>caf&eacute; &#8364;</article>", "A & B\nx y z\ncafé €"),
    ("<nav><a href=/>Home</a></nav><article><p>Body <b>bold</b><br>next</p></article><footer>&copy; me</footer>", "Body bold next"),
    ('<div class="ad">Buy this now</div><article><p>One</p><aside>Side</aside><p>Two</p></article>', "One\nTwo"),
    ('<script>var t="</p><article>no</article>";</script><style>p{}</style><article>yes</article>', "yes"),
    ("<article><p>Keep</p><!-- <p>not this</p> --><form><input><label>Mail</label></form></article>", "Keep"),
    ('<article><p>Text</p></article><section id="comments"><article class="comment"><p>First!</p></article></section>', "Text"),
    ('<div class="with-sidebar"><article><p>In layout</p></article></div>', "In layout"),
    ('<article><p>a</p><div class="cookie-notice"><div>We use <b>cookies</b></div></div><p>b</p></article>', "a\nb"),
    ("<main><p>Main part</p></main><footer>f</footer>", "Main part"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("<article><p>open <b>never closed", "open never closed"),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a</td><td>b</td></tr></table></article>", "one\ntwo\na b"),
    ("<title>T</title><h1>Only a heading</h1>", "Only a heading"),
    ('<article><p hidden>no</p><p>yes</p><p style="display:none">no</p></article>', "yes"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_pages(page, text):
    assert main_text(page) == text


def test_pages_without_marks():
    menu = "".join(f"<li><a href='/{k}'>Menu entry {k}</a></li>" for k in range(20))
    page = f"<html><body><ul>{menu}</ul><h2>Title</h2>" + f"<p>{LONG}</p>" * 3 + f"<p>Short.</p><p>{LONG}</p><ul>{menu}</ul></body></html>"
    text = main_text(page).split("\n")
    assert text == ["Title", *[LONG.strip()] * 3, "Short.", LONG.strip()]


def test_many_short_paragraphs_stay():
    page = "<article>" + "".join(f"<p>{k}</p><div class='ad'>x</div><aside>y</aside><nav>z</nav><form>w</form>" for k in range(300)) + "</article>"
    assert main_text(page) == "\n".join(map(str, range(300)))


def test_stretches():
    sizes = np.array([0, 1, 0, 50, 40, 0, 3, 0, 0, 0, 5, 0])
    assert stretches(sizes, 80).tolist() == [False, False, True, True, True, True, True, False, False, False, False, False]


def test_table(spark):
    rows = [(1, "u", CASES[3][0], "t"), (None, None, None, "t"), (3, "v", "", "t"), (1, "u", CASES[3][0], "t"), (4, "w", "<article><p>" + "word " * 200_000 + "</p></article>", "t")]
    df = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r.page_id or 0, r.n_chars) for r in df.collect())
    assert got == [(0, 0), (1, 18), (1, 18), (3, 0), (4, 999_999)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


MENU = "<nav><a href=/>Home</a> <a href=/x>More</a>"


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<div class='page has-sidebar'><div class='content'><p>{LONG}</p></div><div class='sidebar'><p>Side</p></div></div>", LONG.strip()),
        (f"<article class='post comments-open'><h1>Title</h1><p>{LONG}</p></article>", f"Title\n{LONG.strip()}"),
        (f"<article><div class='article-header'><h1>Title</h1></div><p>{LONG}</p></article>", f"Title\n{LONG.strip()}"),
        (f"<form id='aspnetForm'>{MENU}</nav><article><p>{LONG}</p></article></form>", LONG.strip()),
        (f"<form id='aspnetForm'><div><p>{LONG}</p></div></form>", LONG.strip()),
        (f"<div>{MENU}<div><main><p>Short.</p></main></div>", "Short."),
        ("<div class='comments-on'><article><p>Short.</p></article></div>", "Short."),
        (f"<head><meta name=a><body><p>{LONG}</p></body>", LONG.strip()),
        (f"<p>{LONG}</p><p><a href=/s>See the other page</a></p><p>{LONG}</p>", f"{LONG.strip()}\nSee the other page\n{LONG.strip()}"),
        (f"<article><p>{LONG * 2}</p></article><aside class='related'><article><p>{LONG}</p></article></aside>", (LONG * 2).strip()),
        (f"<article><p>{LONG * 2}</p></article><section id='comments'><article class='comment'><p>{LONG}</p></article></section>", (LONG * 2).strip()),
        ("<div class='ad'>" * 30 + f"<p>{LONG}</p>", LONG.strip()),
    ],
)
def test_elements_around_the_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p>One</p><p class='reply'>Two</p></article>", "One\nTwo"),
        ("<article><p>One</p><section id='search'><p>Two</p></section></article>", "One\nTwo"),
        ("<article><p>One</p><p class='social-history'>Two</p></article>", "One\nTwo"),
        ("<article><p>One</p><div class='tags-note'>Two</div></article>", "One\nTwo"),
        ("<article><p>One</p><ul class='tags'><li><a href=/a>a</a><li><a href=/b>b</a></ul><p>Two</p></article>", "One\nTwo"),
        ("<form><article><p>One</p><p class='reply'>Two</p></article></form>", "One\nTwo"),
        (f"<article><p title=\"x>{LONG}</p><p>Two <a href=\"/y\">y</a></p></article>", f"{LONG.strip()}\nTwo y"),
        ("<article><p title='a > b'>One</p><p data-x=\"<b>x</b>\">Two</p></article>", "One\nTwo"),
        ("<article><p>One<![CDATA[ hid > den ]]></p></article>", "One"),
        (f"<article><p>Short.</p></article><div id='comments'><p>{LONG * 9}</p></div>", "Short."),
        (f"<article><p>Short.</p></article><section class='comments'><article class='comment'>{LONG * 9}</article></section>", "Short."),
        (f"<div><p>{LONG}</p></div><div class='comment-list'><p>{LONG * 9}</p></div>", LONG.strip()),
        ("<article><p>One</p>" + "<div class='related'>" * 12 + "<a href=/x>Read this</a>" + "</div>" * 12 + "</article>", "One"),
        (f"<p>{LONG}</p>" + "<div class='related'>" * 12 + "Read this" + "</div>" * 12, LONG.strip()),
        ("<article><p>a <span class='ad'>Buy</span> b</p></article>", "a b"),
        ("<article><ul><li>one<ul><li>two<li>three</ul><li>four</ul></article>", "one\ntwo\nthree\nfour"),
        ("<article><div><nav>Home</div><p>One</p></article>", "One"),
        ("<article><p>One <b>two<p>three</b> four</article>", "One two\nthree four"),
        ("<article><p>a < b <3 </3 c</p></article>", "a < b <3 </3 c"),
        ("<article>x</article><p>1 <b and", "x"),
        ("<!-- <article>no</article> --><article>yes<!-- open", "yes"),
        ("<head><title>T</title><p>" + LONG, LONG.strip()),
    ],
)
def test_what_counts_as_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("unit", ["<a b=\"", "<a b='>", "<a b=\"'>", "<a b=\"\" x=\">\" ", "<!-- x", "<![CDATA[ x>", "<", "</", "<p class=ad>", "<nav><b>", "<li><span>", "&amp", "<a b"])
def test_a_megabyte_of_broken_markup(unit):
    began = time.perf_counter()
    main_text("<article><p>text</p>" + unit * (1_000_000 // len(unit)) + ">")
    assert time.perf_counter() - began < 8


def plain_stretches(sizes, surge, window):
    """Line blocks as said: a line is kept from a window that reaches the surge until the first empty window."""
    keep, on = [], False
    for k in range(len(sizes)):
        block = sum(sizes[k : k + window])
        if block >= surge:
            on = True
        elif block == 0:
            on = False
        keep.append(on)
    return keep


def test_line_blocks_against_brute_force():
    rng = random.Random(9)
    for _ in range(300):
        lines = [rng.choice([0, 0, 0, 3, 12, 45, 90]) for _ in range(rng.randint(0, 25))]
        window, surge = rng.randint(1, 5), rng.choice([1, 40, 80])
        assert stretches(np.array(lines, np.int64), surge, window).tolist() == plain_stretches(lines, surge, window)
        # as a page without marks: an advert is an empty line, link text has no size
        page = "".join(f"<p>{'x' * n}</p>" if n else "<div class='ad'>y</div>" for n in lines)
        level = max(1, min(surge, max((sum(lines[k : k + window]) for k in range(len(lines))), default=0)))
        want = ["x" * n for n, on in zip(lines, plain_stretches(lines, level, window)) if on and n]
        if any(lines):
            assert main_text(page, window, surge) == "\n".join(want)
