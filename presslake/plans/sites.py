"""Grading of sites from their section pages: links are discovered, their pages read, and all of it counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions import predicates as P
from presslake.operators import health
from presslake.operators.shape import compute_once


def section_links(sections: DataFrame, max_links: int = health.LINK_HEAD) -> DataFrame:
    """(source, link): the article links of each section page (source, url, html), the first ones by URL."""
    links = H.discover_article_links(F.col("url"), F.col("html"), max_links)
    return sections.select("source", F.explode(links).alias("link")).distinct()


def checked_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """What the pages (url, html) behind the links gave: `ok` answered, `extracted`, and the `text` they are judged by."""
    fetched = links.join(pages.select(F.col("url").alias("link"), "html"), "link", "left")
    read = H.extract_site_text(H.extract_text(fetched, H.SITE_CHECK_RULE, into="main_text"), into="text")
    return read.select(
        "source", "link", F.col("html").isNotNull().alias("ok"),
        (F.col("main_text").isNotNull() & ~P.is_blocked(F.col("html"))).alias("extracted"),
        "text",
    )


def check_sites(sections: DataFrame, pages: DataFrame, fetch_log: DataFrame, sources: DataFrame) -> DataFrame:
    """The grade of every fetched site.

    `sections` holds one section page per site (source, url, html; html is null if it could not be read), `pages` the pages
    that answered, each URL once, `fetch_log` (source, http_status, response_time) and `sources` (source, region).
    """
    seen = compute_once(sections.select("source", "html"), blocked=P.is_blocked(F.coalesce("html", F.lit(""))))
    seen = seen.select("source", "blocked", F.col("html").isNotNull().alias("parsed"))
    sites = fetch_log.join(sources.select("source", "region"), "source").join(seen, "source", "left")
    sites = sites.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("blocked", "parsed")})
    return health.site_health(sites, checked_links(section_links(sections), pages))
