"""Grading of feeds and sites, deploy tiers and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions import dates
from presslake.functions.predicates import is_regional, is_relevant
from presslake.operators.dedup import head_per_source

# How many rows of a source each check looks at, and the limits
# of the deploy tiers (tests passed, seconds, extracted pages).
RECENT_HEAD, TEXT_HEAD = 10, 20
LINK_HEAD, EXTRACT_HEAD, PAGE_HEAD = 20, 10, 15
IMMEDIATE = {"rss": (6, 3.0, 0), "site": (7, 5.0, 7)}
MONITORED = {"rss": (5, 5.0, 0), "site": (6, 8.0, 5)}


def entry_text(*parts: Column) -> Column:
    """Texts run together without a separator, as the feed check reads them."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def feed_health(items: DataFrame, fetch_log: DataFrame, sources: DataFrame, as_of, order: str = "item_pos") -> DataFrame:
    """Counters and grade per feed.

    `items` (source, `order`, title, summary, description, pub_date),
    `fetch_log` (source, http_status, response_time) with one row per fetched
    source, `sources` (source, region).
    """
    totals = items.groupBy("source").agg(F.count("*").alias("article_count"))
    slim = items.select(
        "source", order, "pub_date",
        entry_text(F.col("title"), F.col("summary"), F.col("description")).alias("text"),
    )
    regional = is_regional(F.col("text"), F.col("region"))
    head = (
        head_per_source(slim, TEXT_HEAD, "source", [order])
        .join(sources.select("source", "region"), "source", "left")
        .groupBy("source")
        .agg(
            F.count_if(
                (F.col("head_rank") <= RECENT_HEAD) & dates.entry_recent(F.col("pub_date"), as_of)
            ).alias("recent_articles"),
            F.count_if(is_relevant(F.col("text"))).alias("relevant_articles"),
            F.count_if(F.coalesce(regional, F.lit(True))).alias("geographic_articles"),
        )
    )
    counts = ["article_count", "recent_articles", "relevant_articles", "geographic_articles"]
    joined = (
        sources.select("source", "region")
        .join(fetch_log, "source")
        .join(totals, "source", "left")
        .join(head, "source", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in counts})
    )
    return gate(joined, "rss")


def site_health(sites: DataFrame, links: DataFrame) -> DataFrame:
    """Counters and grade per site.

    `sites` (source, region, http_status, response_time, blocked, parsed) has a
    row per site; `links` (source, link, ok, extracted, text) has its discovered
    links, at most 20 a site, with what their pages gave: `ok` answered,
    `extracted` long enough and not blocked, `text` title and content.
    """
    ranked = head_per_source(links, LINK_HEAD, "source", ["link"]).join(
        sites.select("source", "region"), "source"
    )
    ok = F.coalesce("ok", F.lit(False))
    first_pages = (F.col("head_rank") <= PAGE_HEAD) & ok
    counted = ranked.groupBy("source").agg(
        F.count("*").alias("article_links_found"),
        F.count_if((F.col("head_rank") <= EXTRACT_HEAD) & ok & F.coalesce("extracted", F.lit(False))).alias(
            "content_extraction_success"
        ),
        F.count_if(first_pages & is_relevant(F.col("text"))).alias("relevant_articles"),
        F.count_if(first_pages & F.coalesce(is_regional(F.col("text"), F.col("region")), F.lit(True))).alias(
            "geographic_articles"
        ),
    )
    counts = ["article_links_found", "content_extraction_success", "relevant_articles", "geographic_articles"]
    joined = sites.join(counted, "source", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("long") for c in counts}
    )
    return gate(joined, "site")


def _stages(kind: str) -> list[tuple[int, Column, Column, str]]:
    """(tests gained, condition, error when it fails, counter the stage reports), in order; the first failure
    ends the grading."""
    status = F.col("http_status")
    no_regional = F.concat(F.lit("No "), "region", F.lit(" relevant articles found"))
    tail = [
        (1, F.col("relevant_articles") > 0, F.lit("No relevant articles found"), "relevant_articles"),
        (1, F.col("geographic_articles") > 0, no_regional, "geographic_articles"),
    ]
    if kind == "rss":
        return [
            (0, status == 200, F.concat(F.lit("HTTP "), status.cast("string")), ""),
            (2, F.col("article_count") > 0, F.lit("No entries found in feed"), ""),
            (1, F.col("recent_articles") > 0, F.lit("No recent articles found"), "recent_articles"),
            (1, F.col("article_count") >= 5, F.concat(F.lit("Too few articles: "), F.col("article_count").cast("string")), "article_count"),
            *tail,
        ]
    found, extracted = F.col("article_links_found"), F.col("content_extraction_success")
    return [
        (0, status == 200, F.concat(F.lit("HTTP "), status.cast("string")), ""),
        (2, ~F.col("blocked"), F.lit("Anti-bot measures detected"), ""),
        (1, F.col("parsed"), F.lit("HTML parsing failed"), ""),
        (1, found >= 5, F.concat(F.lit("Too few article links found: "), found.cast("string")), "article_links_found"),
        (
            1,
            extracted >= 3,
            F.concat(F.lit("Content extraction failed for most articles: "), extracted.cast("string"), F.lit("/10")),
            "content_extraction_success",
        ),
        *tail,
    ]


def gate(df: DataFrame, kind: str) -> DataFrame:
    """Adds tests_passed, total_tests, status and the first error; later stages count only if all
    earlier ones passed, and counters of stages never reached are 0."""
    passed, error, reached = F.lit(0), F.lit(None).cast("string"), F.lit(True)
    total, counters = 0, {}
    for gain, condition, message, counter in _stages(kind):
        if counter:
            counters[counter] = F.when(reached, F.col(counter)).otherwise(F.lit(0)).cast("long")
        condition = F.coalesce(condition, F.lit(False))
        error = F.when(reached & ~condition, message).otherwise(error)
        reached = reached & condition
        passed = passed + F.when(reached, gain).otherwise(0)
        total += gain
    status = F.when(passed == total, "PASSED").otherwise("FAILED")
    return df.withColumns(
        {
            **counters,
            "tests_passed": passed,
            "total_tests": F.lit(total),
            "status": status,
            "error": F.coalesce(error, F.lit("")),
        }
    )


def with_tier(df: DataFrame, kind: str) -> DataFrame:
    """Adds the deploy tier of passed sources: deploy_immediately, deploy_with_monitoring or
    do_not_deploy; NULL for failed ones."""

    def within(limits) -> Column:
        tests, seconds, extracted = limits
        test = (F.col("tests_passed") >= tests) & (F.col("response_time") < seconds)
        return test & (F.col("content_extraction_success") >= extracted) if extracted else test

    tier = (
        F.when(within(IMMEDIATE[kind]), "deploy_immediately")
        .when(within(MONITORED[kind]), "deploy_with_monitoring")
        .otherwise("do_not_deploy")
    )
    return df.withColumn("tier", F.when(F.col("status") == "PASSED", tier))


def deploy_tier(df: DataFrame, kind: str) -> DataFrame:
    """Passed sources with their tier."""
    return with_tier(df, kind).where(F.col("tier").isNotNull())


def ready_sources(tiered: DataFrame) -> DataFrame:
    return tiered.where(F.col("tier").isin("deploy_immediately", "deploy_with_monitoring"))


def _summary(passed: Column, total: Column) -> list[Column]:
    rate = F.coalesce(F.try_divide(passed * 100.0, total), F.lit(0.0))
    return [
        total.alias("total_tested"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.round(rate, 6).alias("success_rate"),
    ]


def health_summary(graded: DataFrame) -> DataFrame:
    """One row: tested, passed, failed, success rate in percent (0 when nothing was tested)."""
    return graded.agg(*_summary(F.count_if(F.col("status") == "PASSED"), F.count("*")))


def master_report(rss: DataFrame, site: DataFrame, geo: DataFrame | None = None) -> DataFrame:
    """Per kind and overall (`kind` = all): tests, rate and ready sources, with the detection
    accuracy of `geo` (status) on the overall row."""
    columns = ["kind", "status", "ready"]

    def flat(df: DataFrame, kind: str) -> DataFrame:
        ready = F.col("tier").isin("deploy_immediately", "deploy_with_monitoring")
        return with_tier(df, kind).select(
            F.lit(kind).alias("kind"), "status", F.coalesce(ready, F.lit(False)).alias("ready")
        )

    both = flat(rss, "rss").unionByName(flat(site, "site")).select(*columns)
    report = (
        both.rollup("kind")
        .agg(*_summary(F.count_if(F.col("status") == "PASSED"), F.count("*")), F.count_if("ready").alias("ready_sources"))
        .withColumn("kind", F.coalesce("kind", F.lit("all")))
    )
    if geo is None:
        return report
    accuracy = health_summary(geo).select(
        F.lit("all").alias("kind"), F.col("success_rate").alias("detection_accuracy")
    )
    # One row per kind, to which the accuracy is added as a row of its own.
    both = report.unionByName(accuracy, allowMissingColumns=True)
    others = [c for c in report.columns if c != "kind"]
    merged = both.groupBy("kind").agg(*(F.max(c).alias(c) for c in [*others, "detection_accuracy"])).where("total_tested IS NOT NULL")
    return merged.withColumn("detection_accuracy", F.coalesce("detection_accuracy", F.lit(0.0)))
