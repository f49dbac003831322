import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arrears.llm import queries
from arrears.llm.html_text import blocks_of, extracted, main_text

LONG = "The river rises in the hills and it runs to the sea through a valley that is known for its old mills. "
PAGE = f"""<!DOCTYPE html><html><head><title>Site</title><style>p{{}}</style></head><body class="has-sidebar-left">
<header><a href="/">Home</a><p>{LONG}</p></header><nav><ul><li><a href="/a">News</a><li><a href="/b">Sport</a></ul></nav>
<div id="cookie-notice"><p>{LONG}</p></div>
<form><main><article class="post"><header><h1>The &quot;river&quot; &amp; the sea</h1></header>
<p>{LONG}<br>And&nbsp;so
 on.<p>Short.</p><aside><p>{LONG}</p></aside><script>if (a < b) {{ "</p>" }}</script><!-- <p>no</p> -->
<ul><li>First point</li><li>Second point</li></ul><p><a href="/x">Read more about all of these rivers here</a></p>
<div class="advert">{LONG}</div><blockquote>{LONG}</blockquote><p>Last &lt;b&gt; words&#33;</p></article>
<section id="comments"><article><p>{LONG}</p></article></section></main></form>
<div class="sidebar"><p>{LONG}</p></div><footer>&copy; {LONG}</footer></body></html>"""
KEPT = ['The "river" & the sea', LONG.strip() + " And so on.", "Short.", "First point", "Second point", LONG.strip(), "Last <b> words!"]


def test_the_article_without_everything_around_it():
    assert main_text(PAGE)[0].split("\n") == KEPT


def test_without_semantic_tags_stop_words_decide():
    page = (
        f"<div>Buy now</div><div><h2>Title</h2><p>{LONG}</p><p>Brief.</p><p>{LONG}</p></div>"
        f"<div>{'Shoes Bags Hats Coats Belts ' * 5}</div><div>Imprint</div>"
    )
    assert main_text(page)[0].split("\n") == ["Title", LONG.strip(), "Brief.", LONG.strip()]


def test_an_article_of_short_blocks_only_is_kept():
    assert main_text("<nav>Menu</nav><article><p>Be.</p><p>Erin.</p></article><footer>x</footer>")[0] == "Be.\nErin."


def test_a_nav_that_is_never_closed_does_not_swallow_the_article():
    assert main_text(f"<nav><a href=x>Menu</a><article><p>{LONG}</p></article>")[0] == LONG.strip()


@pytest.mark.parametrize("value", [None, "", "   ", "<p></p>", "<", "</", "<!--", "<script>x"])
def test_pages_without_text(value):
    assert main_text(value)[0] == ""


@pytest.mark.parametrize("part", [
    '<a "', "<a '", "<", "<!--", "<script>", "<p>", "<nav>", '<div class="ad">', "&", "<b>", "</b>", "<article>", "<b></i>",
    '<form><article>', "<!", "<a>x", "x</p>",
])
def test_very_long_pages_take_linear_time(part):
    begin = time.perf_counter()
    main_text(part * (400_000 // len(part)))
    assert time.perf_counter() - begin < 8


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<article>", "</article>", "<b>", "<nav>", "</nav>", "<a href='>'>", "</a>", "one two",
                                 "&lt;", "&amp", "<", ">", '"', "<br/>", "<div class=ad>", "</div>", "\xa0", "é", LONG]), max_size=40))
def test_any_markup_gives_trimmed_lines_in_page_order(parts):
    page = "".join(parts)
    blocks = [b.text for b in blocks_of(page)]
    text, n, good = main_text(page)
    lines = text.split("\n") if text else []
    assert n == len(blocks) and good == len(lines)
    assert all(line == " ".join(line.split()) and line for line in lines)
    rest = iter(blocks)
    assert all(line in rest for line in lines)


def test_rows_of_every_kind(spark):
    rows = [(1, PAGE, "x", 1), (1, PAGE, "x", 1), (2, None, None, 2), (None, "", "", 3), (3, f"<p>{LONG * 20_000}</p>", "y", 4)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, `n.good` int").repartition(3)
    got = sorted(((r.page.page_id or 0, r.page["n.good"], r.text) for r in extracted(pages).collect()))
    kept = "\n".join(KEPT)
    assert got == [(0, 3, ""), (1, 1, kept), (1, 1, kept), (2, 2, ""), (3, 4, (LONG * 20_000).strip())]
    assert extracted(pages.where("page_id = 99")).count() == 0


def test_whole_table_against_the_article_elements(spark, sf_dir):
    """The given pages hold the article in one element: a plain reading of that element must give the same text."""
    got = {r.page_id: (r.text, r.n_chars) for r in queries.op11_html_text(spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        article = re.search("<article>(.*)</article>", page.html, re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>|<br>", "", article))
        text = "\n".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))
        assert got[page.page_id] == (text, len(text))
