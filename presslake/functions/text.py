"""Scalar expressions over articles, bills and markets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.html import BILL_PATH, TAG, decode_text

# Addresses of markets and bill packages.
MARKET_BASE = "https://polymarket.com/event"
BILL_PACKAGES = "https://www.govinfo.gov/content/pkg"

# The source label of each origin.
SOURCE_LABELS = {
    "rss": "RSS Feed",
    "direct": "Direct Scraping",
    "legislation": "Legislation Feed",
    "historical": "Legislation Feed",
    "market": "Polymarket",
}


def article_id(url: Column) -> Column:
    return F.md5(url)


def content_length(content: Column) -> Column:
    """Length in characters."""
    return F.char_length(content)


def tag_text(*parts: Column) -> Column:
    """Parts joined by one blank; a missing part counts as empty."""
    return F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])


def has_text(column: Column) -> Column:
    return F.coalesce(column, F.lit("")) != ""


def clean_description(column: Column, limit: int = 300) -> Column:
    """The text without markup, scripts and styles, its entities decoded, cut at `limit` characters with ``...``
    if anything was cut. A ``<`` that opens no tag is text."""
    kept = F.regexp_replace(F.coalesce(column, F.lit("")), r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "")
    plain = decode_text(F.regexp_replace(kept, TAG, ""))
    return F.when(F.char_length(plain) > limit, F.concat(F.substring(plain, 1, limit), F.lit("..."))).otherwise(plain)


def market_description(column: Column) -> Column:
    return F.coalesce(F.substring(column, 1, 500), F.lit(""))


def bill_id(url: Column) -> Column:
    """The bill id of a details link (after the last details path, up to the next slash), else NULL."""
    found = F.regexp_extract(url, r"^.*/app/details/([^/]*)", 1)
    return F.when(url.contains(BILL_PATH) & (found != ""), found)


def bill_xml_url(bill: Column) -> Column:
    return F.concat(F.lit(BILL_PACKAGES + "/"), bill, F.lit("/xml/"), bill, F.lit(".xml"))


def bill_html_url(bill: Column) -> Column:
    return F.concat(F.lit(BILL_PACKAGES + "/"), bill, F.lit("/html/"), bill, F.lit(".htm"))


def govinfo_links(url: Column) -> Column:
    """struct<bill_id, xml_url, html_url>, all NULL for other links."""
    bill = bill_id(url)
    return F.struct(
        bill.alias("bill_id"),
        bill_xml_url(bill).alias("xml_url"),
        bill_html_url(bill).alias("html_url"),
    )


def content_path(origin: Column, article: Column) -> Column:
    folder = F.when(origin.isin("rss", "direct"), F.concat(origin, F.lit("/"))).otherwise("")
    return F.concat(folder, F.lit("content/"), article, F.lit(".html"))


def source_label(origin: Column) -> Column:
    label = None
    for name, text in SOURCE_LABELS.items():
        label = F.when(origin == name, text) if label is None else label.when(origin == name, text)
    return label


def number_or_zero(column: Column) -> Column:
    """A number from text or number; missing or empty counts as 0."""
    return F.coalesce(column.try_cast("double"), F.lit(0.0))


def dollars(column: Column) -> Column:
    """``$1,234``"""
    return F.concat(F.lit("$"), F.format_number(column, 0))


def title_case(column: Column) -> Column:
    """Every run of letters capitalised, also behind a hyphen or an apostrophe."""
    runs = F.split(column, r"(?<=[^\p{L}])(?=\p{L})")
    capital = F.transform(
        runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.lower(F.substr(run, F.lit(2))))
    )
    return F.array_join(capital, "")


def first_keywords(keywords: Column, n: int = 3) -> Column:
    return F.array_join(F.slice(keywords, 1, n), " ")


def joined(tags: Column) -> Column:
    return F.array_join(F.coalesce(tags, F.array().cast("array<string>")), " ")
