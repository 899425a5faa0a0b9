"""News from feeds and from section pages.

Cheap row filters run before any join; copies of a URL are settled while rows
are still narrow; page text is joined last and dropped as soon as it is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions import dates, html, predicates, tagging, text
from presslake.functions import lexicons as lex
from presslake.operators import dedup, joins
from presslake.operators.shape import compute_once
from presslake.plans.records import tag_struct, to_articles
from presslake.sources import feeds


def feed_items(documents: DataFrame) -> DataFrame:
    """Items with a link, as (feed_url, feed_pos if given, item_pos, title, url, pub_date, description)."""
    given = [c for c in ("feed_url", "feed_pos", "xml") if c in documents.columns]
    items = feeds.normalize_items(feeds.explode_feed(documents.select(*given)))
    return items.where(predicates.has_link(F.col("link"))).withColumnRenamed("link", "url")


def first_items(items: DataFrame) -> DataFrame:
    """Each URL once: its first item by the feeds' order (`feed_pos`, else the feeds' URLs) and position."""
    order = [c for c in ("feed_pos", "feed_url", "item_pos") if c in items.columns]
    return dedup.dedupe_urls(items.withColumn("place", F.struct(*order)), "place").drop("place", "item_pos", "feed_pos")


def _with_stored(items: DataFrame, stored: DataFrame | None, as_of: datetime) -> DataFrame:
    """Items not stored on the day of the run. Without a column collection_date, `stored` is that day's."""
    if stored is None:
        return items
    if "collection_date" in stored.columns:
        stored = stored.where(F.col("collection_date") == F.lit(as_of.date()))
    keyed = items.withColumn("article_id", text.article_id(F.col("url")))
    return keyed.join(stored.select("article_id"), "article_id", "left_anti").drop("article_id")


def tag_news(df: DataFrame, all_text, special, keywords: Sequence[str]) -> DataFrame:
    tags = {
        "found_continents": tagging.continents(all_text),
        "found_keywords": tagging.matched_keywords(all_text, keywords),
    }
    return (
        compute_once(df, **tags)
        .withColumn(
            "tags",
            tag_struct(
                F.col("found_continents"),
                matched_keywords=F.col("found_keywords"),
                core_topics=tagging.core_topics(F.col("found_keywords")),
                special_tags=special,
            ),
        )
        .drop("found_continents", "found_keywords")
    )


def rss_articles(
    documents: DataFrame,
    pages: DataFrame,
    as_of: datetime,
    seen: DataFrame | None = None,
    stored: DataFrame | None = None,
    fresh: bool = False,
    keywords: Sequence[str] = lex.NEWS_KEYWORDS,
    strict_year: bool = False,
) -> DataFrame:
    """Relevant feed items with the text of their pages.

    `documents` (feed_url, xml and, for the feeds' order, feed_pos), `pages` (url, html) each URL once, or
    with fetched_at the latest counts, `seen` (url) collected that day, `stored`
    (article_id, collection_date) stored in full.
    """
    items = feed_items(documents)
    items = items.where(
        dates.year_filter(F.col("pub_date"), strict=strict_year)
        & predicates.rss_gate(F.col("title"), F.col("description"), keywords)
    )
    items = first_items(items)
    if not fresh:
        items = _with_stored(items if seen is None else joins.drop_seen(items, seen), stored, as_of)
    read = html.extract_news(joins.attach_content(items, pages)).drop("html")
    read = read.where(predicates.has_content(F.col("content")))
    all_text = text.tag_text(F.col("title"), F.col("description"), F.col("content"))
    return to_articles(tag_news(read, all_text, tagging.special_tags(F.col("feed_url")), keywords), "rss", as_of)


def direct_articles(
    sections: DataFrame,
    pages: DataFrame,
    as_of: datetime,
    seen: DataFrame | None = None,
    stored: DataFrame | None = None,
    fresh: bool = False,
    keywords: Sequence[str] = lex.NEWS_KEYWORDS,
    max_links: int = 50,
    strict_year: bool = False,
) -> DataFrame:
    """Relevant pages linked from section pages. `sections` (base_url, html), `pages` (url, html)."""
    found = html.discover_links(F.col("base_url"), F.col("html"), max_links)
    links = sections.select("base_url", F.explode_outer(found).alias("url")).where(F.col("url").isNotNull())
    links = dedup.dedupe_urls(links, "base_url")
    if not fresh:
        links = _with_stored(links if seen is None else joins.drop_seen(links, seen), stored, as_of)
    page = joins.attach_content(links, pages)
    page = compute_once(page, title=html.page_title(F.col("html")))
    page = page.where(predicates.matches_keywords(F.col("title"), keywords))
    page = compute_once(page, date=html.page_date(F.col("html")))
    page = page.where(dates.year_filter(F.col("date"), strict=strict_year))
    read = html.extract_news(page).drop("html")
    read = read.where(predicates.matches_keywords(F.col("content"), keywords))
    all_text = text.tag_text(F.col("title"), F.col("content"))
    return to_articles(tag_news(read, all_text, F.array().cast("array<string>"), keywords), "direct", as_of)
