"""Legislation feeds: no keyword gate; daily runs keep the last day, historical ones everything."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions import dates, html, tagging, text
from presslake.operators import joins
from presslake.plans.news import feed_items, first_items
from presslake.plans.records import tag_struct, to_articles


def _attach_pages(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds the page of each item and, for bills, their XML and HTML versions."""
    bill = text.govinfo_links(F.col("url"))
    # Items that are no bills have keys of their own that no package has, so they do not meet at NULL. The feeds behind
    # the items are parsed once; the joins with packages come first, while rows are narrow.
    own = F.concat(F.lit("-"), F.col("url"))
    keyed = items.withColumns({"xml_key": F.coalesce(bill["xml_url"], own), "html_key": F.coalesce(bill["html_url"], own)})
    page = pages.select("url", "html")
    # Only bill packages can be a bill's XML or HTML version.
    package = page.where(F.col("url").startswith(text.BILL_PACKAGES))
    xml = package.select(F.col("url").alias("xml_key"), F.col("html").alias("bill_xml"))
    version = package.select(F.col("url").alias("html_key"), F.col("html").alias("bill_html"))
    with_bills = keyed.join(xml, "xml_key", "left").join(version, "html_key", "left").drop("xml_key", "html_key")
    return with_bills.join(page, "url", "left")


def legislation_articles(
    documents: DataFrame,
    pages: DataFrame,
    as_of: datetime,
    seen: DataFrame | None = None,
    fresh: bool = False,
    days: int | None = 1,
    rule: html.TextRule = html.LEGISLATION_RULE,
    origin: str = "legislation",
) -> DataFrame:
    """All items of legislation feeds not older than `days`, with the text of their pages."""
    items = feed_items(documents)
    if days is not None:
        items = items.where(dates.recent(F.col("pub_date"), as_of, days))
    items = first_items(items)
    if seen is not None and not fresh:
        items = joins.drop_seen(items, seen)
    read = html.extract_content(_attach_pages(items, pages), rule).drop("html", "bill_xml", "bill_html")
    read = read.where(text.has_text(F.col("content")))
    all_text = text.tag_text(F.col("title"), F.col("description"), F.col("content"))
    tags = tag_struct(tagging.continents(all_text), special_tags=F.array(F.lit("legislation")))
    return to_articles(read.withColumn("tags", tags), origin, as_of)


def historical_articles(documents: DataFrame, pages: DataFrame, as_of: datetime, seen: DataFrame | None = None) -> DataFrame:
    """Legislation of any date, keeping the pages' markup."""
    return legislation_articles(
        documents, pages, as_of, seen, days=None, rule=html.HISTORICAL_RULE, origin="historical"
    )
