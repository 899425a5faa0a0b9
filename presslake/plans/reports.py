"""Index build, source-health report, detection evaluation and content backfill."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions import html, tagging
from presslake.operators import dedup, evaluation, health, index, joins, rollups
from presslake.sources import store


class Index(NamedTuple):
    articles: DataFrame  # display rows, newest first
    header: DataFrame  # counts of the date
    facets: DataFrame
    master: DataFrame  # one card per date
    totals: DataFrame


def build_index(table: DataFrame, date: str, master: DataFrame | None = None) -> Index:
    """The index of one date and the master list, once all origins of the date are stored."""
    day = store.articles_for_date(table, date)
    card = rollups.card_stats(day)
    return Index(
        articles=dedup.newest_first(index.daily_index(day), F.col("sort_ts"), "article_id"),
        header=rollups.daily_stats(day),
        facets=rollups.facets(day),
        master=rollups.upsert_master(card.limit(0) if master is None else master, card),
        totals=rollups.archive_totals(table),
    )


class HealthReport(NamedTuple):
    feeds: DataFrame
    sites: DataFrame
    feed_tiers: DataFrame
    site_tiers: DataFrame
    report: DataFrame


def health_report(feeds: DataFrame, sites: DataFrame, detection: DataFrame | None = None) -> HealthReport:
    """Tiers and master report of graded feeds and sites."""
    return HealthReport(
        feeds, sites, health.deploy_tier(feeds, "rss"), health.deploy_tier(sites, "site"),
        health.master_report(feeds, sites, detection),
    )


class Evaluation(NamedTuple):
    results: DataFrame
    accuracy: DataFrame
    patterns: DataFrame


def evaluate_detection(cases: DataFrame, lexicon=None) -> Evaluation:
    """Region detection over labelled cases (name, text, expected)."""
    results = evaluation.evaluate(cases, tagging.regions(F.col("text"), lexicon))
    return Evaluation(results, evaluation.region_accuracy(results), evaluation.failure_patterns(results))


def backfill_bills(table: DataFrame, content: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bill articles with their content read again from the bill's XML or HTML version."""
    from presslake.functions.text import BILL_PATH
    from presslake.plans.legislation import _attach_pages

    bills = table.where(F.col("url").contains(BILL_PATH)).select("url").distinct()
    read = _attach_pages(bills, pages).select(
        "url", html.extract_bill(F.col("bill_xml"), F.col("bill_html")).alias("new_content")
    )
    return store.backfill_content(table, content, read, BILL_PATH)


def backfill_senate(table: DataFrame, content: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Senate articles with their content read again by the page rules."""
    part = "senado.leg.br"
    urls = table.where(F.col("url").contains(part)).select("url").distinct()
    read = html.extract_content(joins.attach_content(urls, pages.select("url", "html")), into="new_content")
    read = read.select("url", "new_content")
    return store.backfill_content(table, content, read, part)
