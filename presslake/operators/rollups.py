"""Counts, facets and rollups over articles.

Distinct counts that could meet one date with most of the rows go through a
distinct of the small key first, so no task sees more than the distinct keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from presslake.functions.text import title_case

UNKNOWN = "Unknown"


def _source(df: DataFrame):
    return F.coalesce("source", F.lit(UNKNOWN))


def daily_stats(df: DataFrame) -> DataFrame:
    """Per date: articles, distinct sources (missing ones count as one), thousands of characters."""
    return df.groupBy("collection_date").agg(
        F.count("*").alias("articles"),
        F.count_distinct(_source(df)).alias("sources"),
        F.floor(F.sum(F.coalesce("content_length", F.lit(0))) / 1000).cast("long").alias("length_k"),
    )


def card_stats(df: DataFrame) -> DataFrame:
    """Per date: articles and distinct sources, missing sources not counted."""
    return df.groupBy("collection_date").agg(
        F.count("*").alias("articles"), F.count_distinct("source").alias("sources")
    )


def date_rollup(df: DataFrame) -> DataFrame:
    """Per date, newest first: articles, total length, sources."""
    return (
        df.groupBy("collection_date")
        .agg(
            F.count("*").alias("article_count"),
            F.sum(F.coalesce("content_length", F.lit(0))).cast("long").alias("total_length"),
            F.count_distinct(_source(df)).alias("source_count"),
        )
        .orderBy(F.col("collection_date").desc())
    )


def archive_totals(df: DataFrame) -> DataFrame:
    """One row: dates, articles, thousands of characters, sources."""
    # One combining pass per (date, source); the counts of distinct dates and
    # sources are then taken over that small table.
    small = df.groupBy("collection_date", _source(df).alias("source")).agg(
        F.count("*").alias("n"), F.sum(F.coalesce("content_length", F.lit(0))).alias("chars")
    )
    return small.agg(
        F.count_distinct("collection_date").alias("total_days"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_articles"),
        F.coalesce(F.floor(F.sum("chars") / 1000), F.lit(0)).cast("long").alias("length_k"),
        F.count_distinct("source").alias("unique_sources"),
    )


def facets(df: DataFrame) -> DataFrame:
    """Sorted distinct values per facet: sources and matched keywords with their labels."""
    pairs = F.explode_outer(
        F.concat(
            F.array(F.struct(F.lit("source").alias("facet"), _source(df).alias("value"))),
            F.transform(
                F.coalesce("tags.matched_keywords", F.array().cast("array<string>")),
                lambda k: F.struct(F.lit("keyword").alias("facet"), k.alias("value")),
            ),
        )
    )
    return (
        df.select(pairs.alias("pair"))
        .select("pair.*")
        .distinct()
        .withColumn("label", F.when(F.col("facet") == "keyword", title_case(F.col("value"))).otherwise(F.col("value")))
        .orderBy("facet", "value")
    )


def keyword_count(df: DataFrame) -> DataFrame:
    """Unique matched keywords per date (dates without any count 0)."""
    pairs = df.select("collection_date", F.explode_outer("tags.matched_keywords").alias("keyword"))
    return pairs.groupBy("collection_date").agg(F.count_distinct("keyword").alias("keywords"))


def type_counts(df: DataFrame) -> DataFrame:
    """Per date: all, legislation and other articles."""
    is_legislation = F.coalesce(F.array_contains("tags.special_tags", "legislation"), F.lit(False))
    return df.groupBy("collection_date").agg(
        F.count("*").alias("total"),
        F.count_if(is_legislation).alias("legislation"),
        F.count_if(~is_legislation).alias("regular"),
    )


def ingest_counts(df: DataFrame) -> DataFrame:
    """Articles saved per feed, and over all feeds (feed_url NULL)."""
    return df.rollup("feed_url").agg(F.count("*").alias("saved"))


def market_yield(top: DataFrame, page_rows: int = 100) -> DataFrame:
    """Fetched and political markets per page of a top-k list (`rank` from 1, `political`)."""
    page = F.floor((F.col("rank") - 1) / page_rows).cast("long")
    return top.groupBy(page.alias("page")).agg(
        F.count("*").alias("fetched"), F.count_if("political").alias("political")
    )


def backfill_report(marked: DataFrame) -> DataFrame:
    """Updated and failed articles of a backfill, of all selected."""
    return marked.where(F.col("backfill").isNotNull()).agg(
        F.count_if(F.col("backfill") == "updated").alias("updated"),
        F.count_if(F.col("backfill") == "failed").alias("failed"),
        F.count("*").alias("total"),
    )


def geo_distribution(df: DataFrame, continents: str = "continents") -> DataFrame:
    """Articles per continent and their share of all continent tags."""
    # A text always has a continent tag, so no row comes out empty.
    counted = df.select(F.explode_outer(continents).alias("continent")).groupBy("continent").agg(
        F.count("*").alias("articles")
    )
    # The window runs over one row per continent of the lexicon.
    all_tags = F.sum("articles").over(W.partitionBy(F.lit(0)))
    return counted.select("continent", "articles", F.round(F.col("articles") / all_tags, 6).alias("share"))


def upsert_master(master: DataFrame, stats: DataFrame) -> DataFrame:
    """The master list with `stats` replacing cards of the same date, newest first."""
    kept = master.join(stats.select("collection_date"), "collection_date", "left_anti")
    return kept.unionByName(stats).orderBy(F.col("collection_date").desc())
