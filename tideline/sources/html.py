"""Landed HTML pages to rows: listing cards and their detail pages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import text as T

# The markup of the landed listing and detail pages.
CARD = T.start_tag("li", class_="cl-static-search-result")
CARD_LINK = T.start_tag("a")
CARD_TITLE = T.start_tag("div", class_="title")
CARD_PRICE = T.start_tag("div", class_="price")
CARD_LOCATION = T.start_tag("div", class_="location")
DETAIL_TIME = T.start_tag("time", class_="date", has="datetime")
DETAIL_GROUP = T.start_tag(class_="attrgroup")
DETAIL_ATTR = T.start_tag("span", class_="attr")
DETAIL_MAP = T.start_tag("div", id_="map")
DETAIL_ADDRESS = T.start_tag(class_="mapaddress")
DETAIL_BODY = T.start_tag(id_="postingbody")
DETAIL_BODY_EXCLUDED = T.start_tag(class_="print-qrcode-container")


def linked_rows(
    pages: DataFrame, pattern: str, fields: Callable[[Column], list[Column]], html: str = "html", cap: int | None = None
) -> DataFrame:
    """One row per element matching ``pattern`` that has a link: the page's other columns,
    the element's position and its ``fields``, one of which is ``url``.

    ``cap`` keeps the first positions of every page, before elements without a link go.
    Fields are built inside the page's row and filtered there, so nothing is parsed twice
    and no markup is copied into the rows.
    """
    found = T.elements(T.visible_markup(F.col(html)), pattern)
    if cap is not None:
        found = F.slice(found, 1, cap)
    built = F.transform(found, lambda element, position: F.struct(position.alias("position"), *fields(element)))
    keep = [F.col(name) for name in pages.columns if name != html]
    return pages.select(*keep, F.inline(F.filter(built, lambda row: row["url"] != "")))


def link_fields(element: Column) -> list[Column]:
    """Address and text of the element's first anchor."""
    anchor = T.first_element(element, CARD_LINK)
    return [T.attribute(anchor, "href").alias("url"), T.text_of(anchor).alias("link_text")]


def card_fields(card: Column) -> list[Column]:
    title = T.text_of(T.first_element(card, CARD_TITLE))
    return [
        T.attribute(T.first_element(card, CARD_LINK), "href").alias("url"),
        F.coalesce(title, T.attribute(card, "title"), F.lit("")).alias("title"),
        T.digits_int(T.raw_text_of(T.first_element(card, CARD_PRICE))).alias("price"),
        T.text_of(T.first_element(card, CARD_LOCATION)).alias("neighborhood"),
    ]


def listing_cards(list_pages: DataFrame, max_records: int | None = None) -> DataFrame:
    """``(region, html)`` pages to ``(region, url, title, price, neighborhood)`` rows."""
    return linked_rows(list_pages.select("region", "html"), CARD, card_fields, cap=max_records).drop("position")


def _attr_texts(html: Column) -> Column:
    groups = T.elements(html, DETAIL_GROUP)
    spans = F.flatten(F.transform(groups, lambda group: T.elements(group, DETAIL_ATTR)))
    return F.transform(spans, T.raw_text_of)


def listing_details(detail_pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(url, html)`` pages to one row of detail fields each, with the columns ``keep``; what is not found is null."""
    pages = detail_pages.select("url", *keep, T.visible_markup(F.col("html")).alias("html"))
    html = F.col("html")
    place = T.first_element(html, DETAIL_MAP)
    body = T.without_elements(T.first_element(html, DETAIL_BODY), DETAIL_BODY_EXCLUDED)
    # The attribute texts feed two columns, so they are computed in a step of their own.
    pages = pages.select(
        "url",
        *keep,
        T.attribute(T.first_element(html, DETAIL_TIME), "datetime").alias("posted"),
        _attr_texts(html).alias("_attrs"),
        place.alias("_map"),
        T.text_of(T.first_element(html, DETAIL_ADDRESS)).alias("address"),
        T.text_of(body, " ").alias("post_description"),
    )
    return pages.select(
        "url",
        *keep,
        "posted",
        T.last_number_before(F.col("_attrs"), "BR").alias("bedrooms"),
        T.last_number_before(F.col("_attrs"), "ft").alias("sqft"),
        T.attribute(F.col("_map"), "data-latitude").try_cast("double").alias("latitude"),
        T.attribute(F.col("_map"), "data-longitude").try_cast("double").alias("longitude"),
        "address",
        "post_description",
    )


def with_details(rows: DataFrame, details: DataFrame, on: str = "url") -> DataFrame:
    """Left join by ``on``: rows without a detail page stay, with nulls.

    ``details`` holds one row per key, so no row is multiplied; a hot key on the row
    side is split by adaptive skew handling, which a left join allows.
    """
    return rows.join(details, on, "left")
