import html
import re

import pytest

from emberline.llm import htmltext
from emberline.llm.queries import op5_main_text
from tests.llm.conftest import texts

CASES = [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a &lt;b&gt; c<br>d</p>", "a <b> c d"),
    ("<p>un<b>bold</b>ed", "unbolded"), ("<script>a<b</script>", ""), ("<p>a</p", "a"), ('<div class="ad', ""),
    ("a < b and 3<4", "a < b and 3<4"), ("<ul><li>x<li>y</ul>", "x y"), ("<p>a&nbsp;b&#233;&amp;amp;</p>", "a bé&amp;"),
    ("<div class='sidebar'>x</div><div><p>Main text here, long.</p><p>Second <a href=x>one</a>.</p></div>", "Main text here, long. Second one."),
    (
        "<body><header>H</header><nav>n</nav><article><header><h1>T</h1></header><p>A</p><form>f</form>"
        "<section id=comments><p>c</p></section></article><aside>z</aside><footer>f</footer></body>", "T A",
    ),
    (
        "<body><div><a href=a>one</a> <a href=b>two</a> <a href=c>three</a></div><div><h2>Title</h2><p>Long words of the "
        "main part of it.</p><p>More words of the main part of it.</p></div></body>",
        "Title Long words of the main part of it. More words of the main part of it.",
    ),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<p hidden>x</p><p>y</p>", "y"),
    ("<!-- <p>a</p> --><p>b<!-- c", "b"), ("<p title='a>b'>c</p>", "c"), ("</div></p>x", "x"),
    ("<textarea>t</textarea><title>t</title>z", "z"), ("<p>" * 3000 + "deep", "deep"), ("<div>" * 3000 + "deep", "deep"),
]


@pytest.mark.parametrize(("page", "wanted"), CASES)
def test_pages(page, wanted):
    assert htmltext.main_text(page) == wanted


LONG = "Long words of the main part of it, and more of them."


@pytest.mark.parametrize(
    "tag", ['style="overflow:hidden"', 'title="a hidden path"', "data-hidden='false'", "title='id=sidebar class=ad'", "data-id=menu", 'x="role=menu"'],
)
def test_attributes_are_read_with_their_quoting(tag):
    assert htmltext.main_text(f"<body><div {tag}><p>{LONG}</p></div><p>End.</p></body>") == f"{LONG} End."
    assert htmltext.main_text(f"<body><div {tag} HIDDEN><p>{LONG}</p></div><p>End.</p></body>") == "End."


def test_names_do_not_cut_what_holds_the_text():
    for name in ("content has-sidebar", "post-header", "widget", "sidebar", "main-with-menu"):
        assert htmltext.main_text(f"<div class='{name}'><article><h1>T</h1><p>{LONG}</p></article></div><p>x</p>") == f"T {LONG}"
        assert htmltext.main_text(f"<div class='{name}'><h1>T</h1><p>{LONG}</p></div><p class=ad>x</p>") == f"T {LONG}"
    assert htmltext.main_text(f"<article><div class=post-header><h1>T</h1></div><p>{LONG}</p></article>") == f"T {LONG}"
    assert htmltext.main_text(f"<div><div class=post-header><h1>T</h1></div><p>{LONG}</p></div>") == f"T {LONG}"
    assert htmltext.main_text(f"<p class=text-widget>{LONG}</p><p class=text-widget>{LONG}</p>") == f"{LONG} {LONG}"


def test_names_still_cut_what_stands_beside_the_text():
    thread = f"<div id=comments>{'<article>c</article>' * 90}</div>"
    assert htmltext.main_text(f"<main><article>{LONG}</article>{thread}</main>") == LONG
    assert htmltext.main_text(f"<article><p>{LONG}</p><div class=ad>{LONG * 3}</div></article>") == LONG
    assert htmltext.main_text(f"<div class=ad>{LONG * 3}</div><article>{LONG}</article>") == LONG
    assert htmltext.main_text(f"<div class=wrap><p>{LONG}</p><div class='site-footer'><a class=share>f</a> g</div>h</div>") == f"{LONG} h"


def test_elements_without_an_end_hide_nothing():
    for tag in ("<svg class='icon'/>", "<svg/>", "<math/>", "<video src=x>", "<audio>", "<object>", "<canvas>", "<noscript>", "<svg><path d='M0'/>"):
        assert htmltext.main_text(f"<article><h1>T</h1>{tag}<p>{LONG}</p></article>") == f"T {LONG}", tag
        assert htmltext.main_text(f"<p>T</p>{tag}<p>{LONG}</p>") == f"T {LONG}", tag
        assert htmltext.main_text(f"<div><div>T {tag}</div><p>{LONG}</p></div>") == f"T {LONG}", tag
    for tag in ("video", "audio", "object", "canvas", "noscript", "template", "svg"):
        inner = f"<p>x<b>y</p><{tag}>z</{tag}>" + "<i/>w" * (tag == "svg")
        assert htmltext.main_text(f"<article>a<{tag} class=k>{inner}</{tag}>b<p>{LONG}</p></article>") in (f"a b {LONG}", f"ab {LONG}"), tag
        assert htmltext.main_text("<div>" * 600 + f"a<{tag}>x</{tag}>b") == "ab", tag
    assert htmltext.main_text("<p>As <math><mi>x</mi><mo>=</mo><mn>2</mn></math> shows") == "As x=2 shows"
    assert htmltext.main_text("<p>a</p><script>b<p>c</p>") == "a"
    assert len(htmltext.main_text("<video>w" * 100_000).replace(" ", "")) == 100_000


def test_hostile_pages_take_linear_time():
    assert htmltext.main_text("<a " * 200_000) == ""
    assert htmltext.main_text("<p a='" * 100_000) == ""
    assert len(htmltext.main_text("<p>word</p>" * 50_000)) == 5 * 50_000 - 1


def test_table(spark):
    rows = [(i, page, "x") for i, (page, _) in enumerate(CASES)] * 2
    found = htmltext.extract(texts(spark, rows, "page_id long, html string, text string"))
    assert found.columns == ["page_id", "html", "text", "n_chars"]
    got = found.collect()
    assert len(got) == 2 * len(CASES) and all(r["text"] == CASES[r["page_id"]][1] and r["n_chars"] == len(r["text"]) for r in got)
    assert htmltext.extract(texts(spark, [], "page_id long, html string")).count() == 0


def test_registered_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    rows = op5_main_text(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(pages)
    for r in rows:
        part = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S)[1]
        plain = re.sub(r"<[^>]*(>|\Z)", "", re.sub(r"</?(?:h1|p|br)\b[^>]*>", " ", part))
        assert r["text"] == " ".join(html.unescape(plain).split())
