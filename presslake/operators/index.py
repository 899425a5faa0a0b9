"""The display-ready daily index and the union of origins it is built from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions import dates, text


def union_origins(*tables: DataFrame) -> DataFrame:
    """Articles of all origins; columns an origin lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def shown_date(df: DataFrame):
    """pub_date, else date: a present but empty pub_date is not replaced."""
    return F.coalesce(*[F.col(c) for c in ("pub_date", "date") if c in df.columns])


def sort_date(df: DataFrame):
    """Wall-clock time to sort by: a non-empty pub_date counts even if unreadable, else date."""
    chosen = F.nullif("pub_date", F.lit(""))
    if "date" in df.columns:
        chosen = F.coalesce(chosen, F.nullif("date", F.lit("")))
    return dates.parse_pub_date(chosen, keep_wall_clock=True)


def daily_index(df: DataFrame) -> DataFrame:
    """One display row per article."""
    continents, topics = F.col("tags.continents"), F.col("tags.core_topics")
    special, keywords = F.col("tags.special_tags"), F.col("tags.matched_keywords")
    article = F.md5("url")
    return df.select(
        "collection_date",
        article.alias("article_id"),
        F.coalesce("title", F.lit("No Title")).alias("title"),
        "url",
        F.coalesce("source", F.lit("Unknown")).alias("source"),
        dates.display_date(shown_date(df)).alias("shown_date"),
        sort_date(df).alias("sort_ts"),
        F.coalesce("content_length", F.lit(0)).alias("content_length"),
        text.clean_description(F.col("description")).alias("description"),
        text.joined(continents).alias("continents"),
        text.joined(topics).alias("topics"),
        text.joined(special).alias("special"),
        text.joined(keywords).alias("keywords"),
        text.first_keywords(F.coalesce(keywords, F.array().cast("array<string>"))).alias("first_keywords"),
        text.content_path(F.col("origin"), article).alias("content_path"),
    )
