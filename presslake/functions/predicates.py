"""Row filters as boolean columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions import lexicons as lex
from presslake.functions.match import WHOLE_WORD, TermScanner, any_contains
from presslake.functions.text import has_text, tag_text

MIN_NEWS_CHARS = 100


def _low(column: Column) -> Column:
    return F.lower(F.coalesce(column, F.lit("")))


def matches_keywords(column: Column, keywords: Sequence[str] = lex.NEWS_KEYWORDS) -> Column:
    """Any keyword as a whole word, ignoring case; an empty text has none."""
    if not keywords:
        return F.lit(False)
    return TermScanner({k.lower(): WHOLE_WORD for k in keywords}).matches(_low(column))


def rss_gate(title: Column, description: Column, keywords: Sequence[str] = lex.NEWS_KEYWORDS) -> Column:
    """Relevance of a feed item, decided before its content is read."""
    return matches_keywords(tag_text(title, description), keywords)


def direct_gate(title: Column, content: Column, keywords: Sequence[str] = lex.NEWS_KEYWORDS) -> Column:
    """A scraped page is relevant if its title and its content both are."""
    return matches_keywords(title, keywords) & matches_keywords(content, keywords)


def has_link(column: Column) -> Column:
    return has_text(column)


def has_content(column: Column, min_chars: int = 0) -> Column:
    """Not missing, not empty and longer than `min_chars` characters."""
    return F.coalesce(F.char_length(column) > min_chars, F.lit(False))


def is_political(
    category: Column,
    question: Column,
    description: Column,
    terms: Sequence[str] = lex.POLITICAL_TERMS,
    categories: Sequence[str] = lex.POLITICAL_CATEGORIES,
) -> Column:
    by_category = any_contains(_low(category), categories)
    return by_category | matches_keywords(tag_text(question, description), terms)


def url_contains(column: Column, part: str) -> Column:
    return column.contains(part)


def is_blocked(html: Column, terms: Sequence[str] = lex.BLOCKED_PAGE_TERMS) -> Column:
    """Does a page look like a bot check?"""
    return any_contains(_low(html), terms)


def is_article_url(
    url: Column,
    skip: Sequence[str] = lex.SKIP_URL_PARTS,
    want: Sequence[str] = lex.ARTICLE_URL_PARTS,
) -> Column:
    low = _low(url)
    return ~any_contains(low, skip) & any_contains(low, want)


def is_relevant(text: Column, terms: Sequence[str] = lex.RELEVANCE_TERMS) -> Column:
    """Any term as a substring."""
    return any_contains(_low(text), terms)


def is_regional(
    text: Column,
    region: Column,
    terms: Mapping[str, Sequence[str]] = lex.REGION_RELEVANCE_TERMS,
) -> Column:
    """Does the text name the source's region? Always true for regions without terms."""
    low = _low(text)
    test = None
    for name, listed in terms.items():
        hit = any_contains(low, listed)
        test = F.when(region == name, hit) if test is None else test.when(region == name, hit)
    return test.otherwise(True)


def by_special(tags: Column, tag: str) -> Column:
    """Articles of a type; articles without special tags are of none."""
    return F.coalesce(F.array_contains(tags, tag), F.lit(False))
