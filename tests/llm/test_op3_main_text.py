import html as entities
import itertools
import random
import re

import pytest

from tallyhouse.llm.op3_main_text import extract, main_text, minimum_cut, op3_min_cut_text
from tallyhouse.llm.tables import read

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></li></ul></nav><div class="cookie-notice">We use cookies on this site, as all do.</div>
<main><article><h1>A &amp; B</h1><p>First   para<b>graph</b> is long enough to be text.<p>Second&nbsp;one,<br>with a break. <script>var x="<p>no</p>";</script>
<div class="ad">Buy this now, it is very cheap today.</div><ul><li>Item one</li><li>Item two</li></ul><blockquote>Quoted.</blockquote>
<form><label>Name</label><input></form></article></main><aside>Read other things that we wrote last year.</aside>
<section id="comments"><p>I liked this article very much, thanks for it.</p></section><footer>&copy; Us</footer></body></html>"""


def test_a_page_with_all_kinds_of_boilerplate():
    assert main_text(PAGE) == "A & B\nFirst paragraph is long enough to be text.\nSecond one, with a break.\nItem one\nItem two\nQuoted."


def test_minimum_cut_equals_brute_force():
    r = random.Random(1)
    for _ in range(60):
        n = r.randrange(1, 8)
        lean = [r.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, r.random()) for i in range(n) for j in range(i) if r.random() < 0.5]

        def cost(side):
            return sum(abs(x) for x, k in zip(lean, side, strict=True) if (x > 0) != k) + sum(c for a, b, c in edges if side[a] != side[b])  # noqa: B023

        best = min(map(cost, itertools.product([True, False], repeat=n)))
        assert abs(cost(minimum_cut(lean, edges)) - best) < 1e-9


def test_given_pages_give_their_article(spark):
    """The given pages keep their text in one article: all its blocks, and nothing else."""
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in read(spark, folder, "pages").collect()}
    for r in op3_min_cut_text(spark, folder).collect():
        body = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", re.sub(r"<br>", " ", body))
        want = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in parts]
        assert r.text == "\n".join(x for x in want if x), r.page_id
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", None), (None, "<p>" + "A long paragraph of words. " * 9, "k"), (3, "<div " * 50, "b"), (4, "no tags at all, but a sentence of text that is long enough to count.", "")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    assert got[1] == got[2] == "" and got[None].startswith("A long paragraph")
    assert got[4].startswith("no tags")
    assert extract(pages.limit(0)).count() == 0


STORY = "The first paragraph of the story is long enough to be text. It goes on for a while."


@pytest.mark.parametrize("attribute", ['style="overflow:hidden"', 'title="the hidden city"', "data-hidden=1", 'style="display:none;display:block"', 'data-style="display:none"'])
def test_the_word_hidden_elsewhere_hides_nothing(attribute):
    for tag in ("article", "main", "div", "body"):
        assert main_text(f"<{tag} {attribute}><article><p>{STORY}</p></article></{tag}>") == STORY


@pytest.mark.parametrize("attribute", ["hidden", "HIDDEN=hidden", 'hidden=""', "aria-hidden='true'", 'style="color:red; display : none"'])
def test_hidden_elements_stay_out(attribute):
    assert main_text(f"<article><p>{STORY}</p><div {attribute}><p>{STORY} Not shown.</p></div></article>") == STORY


@pytest.mark.parametrize(
    "opening",
    [
        '<body class="right-sidebar"><article>', '<body><div class="content no-sidebar"><article>', '<body><div class="page hidden-nav"><article>',
        '<body><article class="post tags-news comments-open">', '<body><div class="sidebar menu"><article>', '<body class="ads"><main id="search">',
        '<body><div class="content sidebar">', '<body><div class="page hidden-nav">', '<body><article class="overflow-hidden">', '<html class="no-js modal-open"><article>',
    ],
)
def test_names_on_wrappers_do_not_lose_the_article(opening):
    page = f"{opening}<h1>Heading</h1><p>{STORY}</p><p>{STORY} Again.</p><div class='share-links'>Tell all your friends about it today.</div>"
    assert main_text(page) == f"Heading\n{STORY}\n{STORY} Again."


@pytest.mark.parametrize("name", ["comments", "site-footer", "nav-menu", "left-sidebar", "ad-box", "post-comments", "widget-3", "cookie_notice"])
def test_boilerplate_names_still_drop_their_elements(name):
    story = f"<article><p>{STORY}</p></article>"
    for inner in (f"<p>{STORY}</p>" * 9, f"<article class='comment'><p>{STORY} Mine.</p></article>" * 3):
        assert main_text(f"<body class='right-sidebar'>{story}<div class='{name}'>{inner}</div>") == STORY
    assert main_text(f"<div><p>{STORY}</p></div><div class='comments'>" + f"<p>{STORY} Mine.</p>" * 9 + "</div>") == STORY


def test_a_list_of_articles_below_bad_names():
    page = "".join(f"<div class='share'><article><p>{STORY} {k}.</p></article></div>" for k in "abc")
    assert main_text(f"<body>{page}") == "\n".join(f"{STORY} {k}." for k in "abc")
