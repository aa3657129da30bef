import html
import itertools
import random
import re

import pytest
from conftest import SF_DIR

from tideline.llm import queries
from tideline.llm.mincut_html import blocks, extract, main_text, minimum_cut


def article(page):
    """The article of a page whose only mark-up inside is p, b, br and headings."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = [html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split(r"</?(?:p|h1|article)>|<br>", inside)]
    return " ".join(" ".join(x.split()) for x in parts if x.split())


def test_query_finds_every_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = queries.QUERIES["op7_mincut_html"](spark, "/root/testdata/sf0.01").collect()
    assert {r.page_id for r in got} == set(pages)
    for r in got:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def loss(source, sink, edges, labels):
    apart = sum(c for i, j, c in edges if labels[i] != labels[j])
    return apart + sum(b if keep else a for a, b, keep in zip(source, sink, labels))


def test_cut_is_minimal():
    draw = random.Random(1)
    for _ in range(300):
        n = draw.randint(0, 9)
        source, sink = ([draw.randint(0, 12) for _ in range(n)] for _ in "ab")
        edges = [(i, j, draw.randint(0, 9)) for i in range(n) for j in range(i) if draw.random() < 0.4]
        best = min(loss(source, sink, edges, x) for x in itertools.product([False, True], repeat=n))
        assert loss(source, sink, edges, minimum_cut(source, sink, edges)) == best


LONG = "It was a long day at the harbour, and nobody could say when the last boat would come back from the islands."


@pytest.mark.parametrize(
    "around",
    [
        "<nav><a href=x>Home</a> <a href=y>News and more of them</a></nav>{}",
        "<header><p>The Daily Paper of the town and its people, since 1901.</p></header>{}",
        "{}<footer><p>All rights reserved by the paper and its owners, 2020.</p></footer>",
        "<aside><p>Read this other story about boats and about the sea.</p></aside>{}",
        '<div class="cookie-notice"><p>We use cookies to make the site better for you, dear reader.</p></div>{}',
        '<div id="ad-top">Buy a new boat today, cheaper than ever before in this town.</div>{}',
        "<form><p>Sign up for our letter and get news every day.</p><input><button>Send</button></form>{}",
        '{}<section class="comments"><h3>Comments</h3><p>I saw it too, it was a long and sad day for all.</p></section>',
        '{}<div class="sidebar"><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>',
        "<script>var a = '<p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> -->{}",
        "<ul><li><a href=1>One thing</a></li><li><a href=2>Two things</a></li><li><a href=3>Three</a></li></ul>{}",
    ],
)
@pytest.mark.parametrize("body", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', "<div>{}</div>"])
def test_boilerplate_goes(around, body):
    inside = f"<h1>The last boat</h1><p>{LONG}<p>So it went.</p><p>{LONG} &amp <b>more</b>&nbsp;of\n it&#33;</p>"
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{around.format(body.format(inside))}</body></html>"
    assert main_text(page) == f"The last boat {LONG} So it went. {LONG} & more of it!"


@pytest.mark.parametrize("name", ["content has-sidebar", "post no-comments", "layout with-header", "page-with-ads", "search", "share-page", "legal"])
@pytest.mark.parametrize("body", ["<article>{}</article>", "<main>{}</main>"])
def test_names_around_the_article_do_not_take_it(name, body):
    inside = f"<h1>The last boat</h1><p>{LONG}<p>{LONG}"
    assert main_text(f'<body><div class="{name}">{body.format(inside)}</div></body>') == f"The last boat {LONG} {LONG}"


def test_articles_of_listings_go():
    for name in ("comments", "sidebar", "related"):
        other = f'<div class="{name}"><article><p>{LONG}</p></article></div>'
        assert main_text(f"<body><article><p>{LONG} Mine.</p></article>{other}</body>") == f"{LONG} Mine."


def test_comments_inside_the_article_go():
    page = f"<article><p>{LONG}</p><div class='ad'>Buy now, it is cheap and good.</div><p>{LONG}</p><div id=comments><p>{LONG}</p></div></article>"
    assert main_text(page) == f"{LONG} {LONG}"


def test_broken_pages():
    for page in ("", "<", "<p", "<p class='x", "a < b", "</p></div>", "<!--", "<script>", "<p>a<p", "<a href=\"x>", "<ul><li>a<li>b"):
        main_text(page)
    assert [b.text for b in blocks("<ul><li>a &lt;b&gt;<li>c</ul>d<br>e <b>f</b>g")] == ["a <b>", "c", "d e fg"]
    assert main_text(f"<article><p>{LONG}") == LONG


def test_edges(spark):
    big = "<article>" + f"<p>{LONG}</p>" * 3000
    rows = [(1, None, "a"), (2, "", "b"), (3, big, None), (3, big, None), (None, "<nav>x</nav>", "c")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, html string, url string, text string")
    got = [(r.page_id, r.url, r.text) for r in extract(df).collect()]
    assert got == [(1, "a", ""), (2, "b", ""), *[(3, None, " ".join([LONG] * 3000))] * 2, (None, "c", "")]
    assert extract(df.limit(0)).collect() == []
    assert queries.QUERIES["op7_mincut_html"](spark, SF_DIR).columns == ["page_id", "url", "text", "n_chars"]


@pytest.mark.parametrize(
    ("inside", "text"),
    [
        ("Energy is <math><mi>E</mi><mo>=</mo><mrow><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow></math> always.", "Energy is E=mc2 always."),
        ("See <video src=x>the film</video>, <object>the chart</object> and <canvas>the map</canvas> here.", "See the film, the chart and the map here."),
        ("Open <span hidden>the rest</span> now.", "Open the rest now."),
    ],
)
def test_embedded_and_folded_text_of_an_article_stays(inside, text):
    for page in (f"<article><p>{LONG}</p><p>{inside}</p></article>", f"<main><p>{LONG}</p><p hidden>{inside}</p></main>"):
        assert main_text(page) == f"{LONG} {text}"


def test_hidden_parts_beside_an_article_go():
    page = f"<div hidden><p>{LONG}</p></div><article><p>{LONG}</p><script>x</script><form><textarea>mine</textarea></form></article>"
    assert main_text(page) == LONG
