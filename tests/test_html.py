from conftest import rows
from pyspark.sql import functions as F

from tideline.functions import text as T
from tideline.plans import ingest
from tideline.sources import html

LIST_PAGE = """<html><!-- <li class="cl-static-search-result"><a href="c">hidden</a></li> --><ol>
<li class="cl-static-search-result" title="unused"><a href="https://x/1?a=1&amp;b=2">
<div class="title"> Nice <b> two </b> </div>
<div class="details"><div class="price">$1,250.50</div><div class="location"> NE &nbsp;</div></div></a></li>
<li class='wide cl-static-search-result odd' title='T &amp;lt; "q" &#8364;&#x20AC;'><ul><li>nested</li></ul><a class=q HREF=https://x/2></a></li>
<li class="cl-static-search-result-ad"><a href="no"></a></li>
<li class="cl-static-search-result"><span>no anchor</span></li>
<li class="cl-static-search-result"><a href="">empty link</a></li>
<li class="cl-static-search-result"><a href="https://x/3"><div class="price">call</div></a>
</ol>"""

DETAIL_PAGE = """<time class="date timeago" datetime="2024-01-02T03:04:05-0800">x</time>
<p class="attrgroup"><span class="attr">2BR / 1Ba</span><span class="attr important">1,200ft<sup>2</sup></span></p>
<div class="attrgroup"><span class="attr"> 3 br</span><span>9ft</span></div><span class="attr">77ft</span>
<div id="map" data-latitude="45.5" data-longitude="-122.5"></div><div class="mapaddress"> 1 Main <br> St </div>
<section id="postingbody"><div class="note print-qrcode-container"><p>QR</p><div class="print-qrcode"></div></div>
Hello <b>big</b> world<script>var t = "</p>";</script><br>line &amp;amp; 2</section><p>after</p>"""


def pages(spark):
    cards = spark.createDataFrame([("r1", LIST_PAGE), ("r2", "<p>nothing</p>"), ("r3", None)], "region string, html string")
    details = spark.createDataFrame(
        [("https://x/1?a=1&b=2", DETAIL_PAGE), ("https://x/2", None), ("https://x/3", '<div id=map data-latitude=1.5>')],
        "url string, html string",
    )
    return cards, details


def test_cards(spark):
    got = rows(html.listing_cards(pages(spark)[0]), "url")
    assert got == [
        ("r1", "https://x/1?a=1&b=2", "Nicetwo", 125050, "NE"),
        ("r1", "https://x/2", 'T &lt; "q" €€', None, None),
        ("r1", "https://x/3", "", None, None),
    ]


def test_cap_counts_positions_before_invalid_cards_go(spark):
    assert html.listing_cards(pages(spark)[0], max_records=4).count() == 2


def test_details_are_extracted_independently(spark):
    got = {r.url: r for r in html.listing_details(pages(spark)[1]).collect()}
    full = got["https://x/1?a=1&b=2"]
    assert (full.posted, full.bedrooms, full.sqft) == ("2024-01-02T03:04:05-0800", 3.0, 200.0)
    assert (full.latitude, full.longitude, full.address) == (45.5, -122.5, "1 MainSt")
    assert full.post_description == "Hello big world line &amp; 2"
    assert tuple(got["https://x/2"])[1:] == (None,) * 7
    assert got["https://x/3"].latitude == 1.5 and got["https://x/3"].longitude is None


def test_rows_without_detail_page_stay(spark):
    cards, details = pages(spark)
    out = ingest.listing_rows(cards, details.where("url <> 'https://x/3'"))
    assert out.columns == [spec.name for spec in ingest.LISTING_COLUMNS]
    assert out.count() == 3 and out.where("sqft = 200").count() == 1


def test_number_parsing(spark):
    frame = spark.createDataFrame([("$1,250.50",), ("none",), (None,), ("99999999999",)], "x string")
    assert rows(frame.select(T.digits_int(F.col("x")))) == [(125050,), (None,), (None,), (99999999999,)]
    frame = spark.createDataFrame([("900ft²",), ("1,200 FT",), ("ft",)], "x string")
    assert rows(frame.select(T.number_before(F.col("x"), "ft"))) == [(900.0,), (200.0,), (None,)]


def test_names_match_whole_and_nesting_is_counted(spark):
    markup = "<DIV-x>no</DIV-x><div id=\"a\">1<DIV>2<div>3</div></div>4</Div><div>5</div>"
    frame = spark.createDataFrame([(markup,)], "x string")
    inner = T.first_element(F.col("x"), T.start_tag("div", id_="a"))
    assert rows(frame.select(T.text_of(inner, "|"))) == [("1|2|3|4",)]
    assert rows(frame.select(F.size(T.elements(F.col("x"), T.start_tag("div", id_="a"))))) == [(1,)]
    rest = T.without_elements(F.col("x"), T.start_tag("div", id_="a"))
    assert rows(frame.select(T.text_of(rest, "|"))) == [("no|5",)]


def test_attribute_is_not_read_out_of_another_value(spark):
    frame = spark.createDataFrame([('<a title="x href=no" data-href=n2 href = \'yes&#33;\'>',), ("<a hrefx=1>",), ('<a href="">',)], "x string")
    assert rows(frame.select(T.attribute(F.col("x"), "href"))) == [("yes!",), (None,), ("",)]


def test_very_long_tags_do_not_exhaust_the_stack(spark):
    quotes = '"x" ' * 200000
    attributes = " ".join(f'data-{i}="{i}"' for i in range(50000))
    frame = spark.createDataFrame([(f"<p>one</p><b {quotes}", f"<a {attributes} href='u'>two</a>")], "x string, y string")
    got = frame.select(
        F.length(T.text_of(F.col("x"))), T.attribute(F.col("y"), "href"), T.text_of(F.col("y"))
    ).first()
    assert got[0] > 3 and tuple(got)[1:] == ("u", "two")


def test_unclosed_markup_runs_to_the_end(spark):
    frame = spark.createDataFrame([("<div class='a'>one<p>two",)], "x string")
    pattern = T.start_tag("div", class_="a")
    assert rows(frame.select(T.text_of(T.first_element(F.col("x"), pattern), " "))) == [("one two",)]


def test_whole_long_texts_are_kept(spark):
    body = "word " * 40000
    frame = spark.createDataFrame([(f'<section id="postingbody">{body}<br>end</section>',)], "html string")
    text = frame.select(T.text_of(T.first_element(T.visible_markup(F.col("html")), html.DETAIL_BODY), " ")).first()[0]
    assert text == body.strip() + " end"
