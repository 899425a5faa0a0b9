"""Array-valued tags of a text: continents, keywords, topics, countries, regions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions import lexicons as lex
from presslake.functions.match import (
    ANYWHERE,
    WHOLE_WORD,
    WORD_START,
    TermScanner,
    any_contains,
    bind,
    literal_table,
    no_strings,
)

SHORT_TERM = 3


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def continents(column: Column, lexicon: Mapping[str, Sequence[str]] = lex.CONTINENT_TERMS) -> Column:
    """Sorted continents of a text; ``Unclear`` without text, ``Global`` without a hit."""
    modes = {
        term: WHOLE_WORD if len(term) <= SHORT_TERM else ANYWHERE
        for terms in lexicon.values()
        for term in terms
    }
    scanner = TermScanner(modes)
    entries = [(name, lexicon[name]) for name in sorted(lexicon)]

    def tag(hits: Column) -> Column:
        named = scanner.values(hits, entries)
        return F.when(F.size(hits) == 0, F.array(F.lit("Global"))).otherwise(named)

    tagged = bind(scanner.hits(F.lower(_text(column))), tag)
    return F.when(_text(column) == "", F.array(F.lit("Unclear"))).otherwise(tagged)


def matched_keywords(column: Column, keywords: Sequence[str] = lex.NEWS_KEYWORDS) -> Column:
    """Whole-word keywords in lexicon order and spelling, repeats of the lexicon kept."""
    if not keywords:
        return no_strings()
    scanner = TermScanner({k.lower(): WHOLE_WORD for k in keywords})
    entries = [(k, [k.lower()]) for k in keywords]

    def tag(hits: Column) -> Column:
        return F.when(F.size(hits) == 0, no_strings()).otherwise(scanner.values(hits, entries))

    return bind(scanner.hits(F.lower(_text(column))), tag)


def core_topics(keywords: Column, lexicon: Mapping[str, Sequence[str]] = lex.TOPIC_TERMS) -> Column:
    """Sorted topics that list at least one of the matched keywords."""
    table = literal_table("topic", "terms", [(t, [k.lower() for k in lexicon[t]]) for t in sorted(lexicon)])

    def tag(lowered: Column) -> Column:
        found = F.filter(table, lambda entry: F.arrays_overlap(lowered, entry["terms"]))
        return F.when(F.size(lowered) == 0, no_strings()).otherwise(
            F.transform(found, lambda entry: entry["topic"])
        )

    return bind(F.transform(F.coalesce(keywords, no_strings()), F.lower), tag)


def countries(
    column: Column, lexicon: Mapping[str, Mapping[str, Sequence[str]]] = lex.COUNTRY_TERMS
) -> Column:
    """Sorted countries named in a text, ignoring case; empty without a hit."""
    kinds = {"word": WHOLE_WORD, "start": WORD_START, "anywhere": ANYWHERE}
    # A term listed under two modes keeps the wider one.
    width = {WHOLE_WORD: 0, WORD_START: 1, ANYWHERE: 2}
    modes: dict[str, str] = {}
    entries = []
    for country in sorted(lexicon):
        terms = []
        for kind, listed in lexicon[country].items():
            for term in listed:
                low, mode = term.lower(), kinds[kind]
                if low not in modes or width[mode] > width[modes[low]]:
                    modes[low] = mode
                terms.append(low)
        entries.append((country, terms))
    scanner = TermScanner(modes)

    def tag(hits: Column) -> Column:
        return F.when(F.size(hits) == 0, no_strings()).otherwise(scanner.values(hits, entries))

    return bind(scanner.hits(ignore_case(_text(column))), tag)


def ignore_case(column: Column) -> Column:
    """Lower case plus the three letters that equal i or s when case is ignored."""
    return F.lower(F.translate(column, "İıſ", "iis"))


def regions(column: Column, lexicon: Mapping[str, Sequence[str]] | None = None, block: int = 2_000) -> Column:
    """Sorted regions by whole-word place names; empty without a hit.

    The terms are taken in blocks of `block`, each compiled into one scan, so a lexicon of any size gives the same regions.
    """
    by_region = lex.region_lexicon(lex.REGION_TERMS) if lexicon is None else lexicon
    listed = [(region, term) for region in sorted(by_region) for term in by_region[region]]

    def found(low: Column, part: list[tuple[str, str]]) -> Column:
        scanner = TermScanner({t: WHOLE_WORD for _, t in part})
        entries = [(region, [t for r, t in part if r == region]) for region in sorted({r for r, _ in part})]

        def tag(hits: Column) -> Column:
            return F.when(F.size(hits) == 0, no_strings()).otherwise(scanner.values(hits, entries))

        return bind(scanner.hits(low), tag)

    low = F.lower(_text(column))
    parts = [listed[at : at + block] for at in range(0, len(listed), block)]
    if not parts:
        return no_strings()
    if len(parts) == 1:
        return found(low, parts[0])
    return bind(low, lambda text: F.array_sort(F.array_distinct(F.concat(*[found(text, part) for part in parts]))))


def tag_article(
    column: Column,
    keywords: Sequence[str] = lex.NEWS_KEYWORDS,
    geo: Mapping[str, Sequence[str]] = lex.CONTINENT_TERMS,
    topics: Mapping[str, Sequence[str]] = lex.TOPIC_TERMS,
) -> Column:
    """struct<continents, matched_keywords, core_topics> of a text."""
    return bind(
        matched_keywords(column, keywords),
        lambda found: F.struct(
            continents(column, geo).alias("continents"),
            found.alias("matched_keywords"),
            core_topics(found, topics).alias("core_topics"),
        ),
    )


def special_tags(feed_url: Column, domains: Sequence[str] = lex.LEGISLATIVE_DOMAINS) -> Column:
    """``[legislation]`` for feeds of legislative hosts, else empty."""
    hit = any_contains(F.coalesce(feed_url, F.lit("")), domains)
    return F.when(hit, F.array(F.lit("legislation"))).otherwise(no_strings())


def legislation_tags(column: Column) -> Column:
    """Tags of a legislation article: continents only, always marked as legislation."""
    return F.struct(
        continents(column).alias("continents"),
        no_strings().alias("matched_keywords"),
        no_strings().alias("core_topics"),
        F.array(F.lit("legislation")).alias("special_tags"),
    )
