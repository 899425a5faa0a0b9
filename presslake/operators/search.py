"""Faceted and archive search over articles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions import text
from presslake.functions.predicates import by_special

MARKUP = "<[^>]*>"


def _holds(column: Column | str, part: str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.lower(F.coalesce(column, F.lit(""))).contains(part.lower())


def _source_is(part: str) -> Column:
    return _holds(F.coalesce("source", F.lit("Unknown")), part)


def _text_has(term: str) -> Column:
    """Term in the title or in the description as displayed (markup dropped, cut)."""
    return _holds("title", term) | _holds(text.clean_description(F.col("description")), term)


def facet_test(
    source: str = "",
    continent: str = "",
    topic: str = "",
    special: str = "",
    keyword: str = "",
    term: str = "",
) -> Column:
    """Does an article pass every facet that is set? An empty facet passes all.

    As a column, so that several searches can share one pass over tagged articles.
    """
    tests = []
    if source:
        tests.append(_source_is(source))
    if continent:
        tests.append(F.array_contains("tags.continents", continent))
    if topic:
        tests.append(F.array_contains("tags.core_topics", topic))
    if special:
        tests.append(by_special(F.col("tags.special_tags"), special))
    if keyword:
        tests.append(F.exists("tags.matched_keywords", lambda k: F.lower(k).contains(keyword.lower())))
    if term:
        tests.append(_text_has(term))
    return reduce(Column.__and__, tests, F.lit(True))


def faceted_search(
    df: DataFrame,
    source: str = "",
    continent: str = "",
    topic: str = "",
    special: str = "",
    keyword: str = "",
    term: str = "",
) -> DataFrame:
    """Articles passing every facet that is set."""
    return df.where(facet_test(source, continent, topic, special, keyword, term))


def archive_search(df: DataFrame, date: str = "", source: str = "", term: str = "") -> DataFrame:
    """Articles of a date, of sources holding a text, with a term in title or description."""
    if date:
        df = df.where(F.col("collection_date") == F.lit(date).cast("date"))
    if source:
        df = df.where(_source_is(source))
    if term:
        df = df.where(_holds("title", term) | _holds("description", term))
    return df


def daily_search(df: DataFrame, source: str = "", keyword: str = "", term: str = "") -> DataFrame:
    """The daily page's search: its keyword is looked for in the joined keyword list."""
    if source:
        df = df.where(_source_is(source))
    if keyword:
        df = df.where(_holds(F.array_join("tags.matched_keywords", ","), keyword))
    if term:
        df = df.where(_holds("title", term) | _holds("description", term))
    return df


def date_search(stats: DataFrame, term: str) -> DataFrame:
    """Date cards whose date or article count holds the term."""
    term = term.lower()
    in_date = F.col("collection_date").cast("string").contains(term)
    return stats.where(in_date | F.col("article_count").cast("string").contains(term))
