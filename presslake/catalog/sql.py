"""SQL text for the lexicon operators, term by term, to check the Spark ones against."""

from __future__ import annotations

from collections.abc import Iterable

from presslake.catalog.corpus import quoted
from presslake.functions import lexicons as lex
from presslake.functions.match import ANYWHERE, WHOLE_WORD, WORD_START, term_pattern

AND_TEXT = "title || ' ' || description || ' ' || content"


def values(rows: Iterable[tuple]) -> str:
    def cell(v) -> str:
        return str(v) if isinstance(v, int) else quoted(v)

    return "VALUES " + ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def hit(low: str, term: str, pattern: str = "") -> str:
    """Condition that a term sits in the text; constant patterns, looked at only where needed."""
    test = f"contains({low}, {quoted(term)})"
    return test if not pattern else f"{test} AND regexp_matches({low}, {quoted(pattern)})"


def found_values(low: str, rows: Iterable[tuple[str, str, str]]) -> str:
    """List of the values whose term sits in the text, in row order, repeats kept."""
    cases = ", ".join(f"CASE WHEN {hit(low, term, pattern)} THEN {quoted(value)} END" for term, value, pattern in rows)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def continent_rows():
    for continent, terms in lex.CONTINENT_TERMS.items():
        for t in terms:
            yield t, continent, "" if len(t) > 3 else term_pattern(t)


def country_rows():
    kinds = {"word": WHOLE_WORD, "start": WORD_START, "anywhere": ANYWHERE}
    for country, by_kind in lex.COUNTRY_TERMS.items():
        for kind, terms in by_kind.items():
            for t in terms:
                pattern = "" if kind == "anywhere" else term_pattern(t.lower(), kinds[kind])
                yield t.lower(), country, pattern


def word_rows(pairs):
    for term, value in pairs:
        yield term.lower(), value, term_pattern(term.lower())


def found_list(name: str, source: str, key: str, low: str, rows) -> str:
    """CTE `name`(key, found): distinct values with a matching term, as a sorted list."""
    return f"{name} AS (SELECT {key}, list_sort(list_distinct({found_values(low, rows)})) AS found FROM {source})"


def keyword_list(name: str, source: str, key: str, low: str, keywords=lex.NEWS_KEYWORDS) -> str:
    """CTE `name`(key, found): matched keywords in lexicon order, repeats kept."""
    rows = [(k.lower(), k, term_pattern(k.lower())) for k in keywords]
    return f"{name} AS (SELECT {key}, {found_values(low, rows)} AS found FROM {source})"


def topic_list(name: str, keywords: str, key: str) -> str:
    """CTE `name`(key, found): topics of the keywords in CTE `keywords`."""
    rows = [(t.lower(), topic) for topic, terms in lex.TOPIC_TERMS.items() for t in terms]
    return f"""{name} AS (
  SELECT {key}, list(DISTINCT topic ORDER BY topic) AS found
  FROM (SELECT {key}, lower(unnest(found)) AS term FROM {keywords}) JOIN ({values(rows)}) AS topics(term, topic) USING (term)
  GROUP BY {key})"""


def any_word(low: str, terms) -> str:
    """Does any of the terms occur as a whole word?"""
    return "(" + " OR ".join(
        f"(contains({low}, {quoted(t.lower())}) AND regexp_matches({low}, {quoted(term_pattern(t.lower()))}))" for t in dict.fromkeys(terms)
    ) + ")"


def any_part(low: str, parts) -> str:
    return "(" + " OR ".join(f"contains({low}, {quoted(p)})" for p in parts) + ")"


# Articles with their tags as lists; needs the articles CTE.
TAGGED = ",\n".join(
    [
        f"texts AS (SELECT doc_id, lower({AND_TEXT}) AS low FROM articles)",
        found_list("tag_continents", "texts", "doc_id", "low", list(continent_rows())),
        keyword_list("tag_keywords", "texts", "doc_id", "low"),
        topic_list("tag_topics", "tag_keywords", "doc_id"),
        f"""tagged AS (
  SELECT a.*, CASE WHEN len(c.found) = 0 THEN ['Global'] ELSE c.found END AS continents, coalesce(k.found, []) AS keywords,
    coalesce(t.found, []) AS topics,
    CASE WHEN {any_part('feed_url', lex.LEGISLATIVE_DOMAINS)} THEN ['legislation'] ELSE [] END AS special
  FROM articles a LEFT JOIN tag_continents c USING (doc_id) LEFT JOIN tag_keywords k USING (doc_id)
  LEFT JOIN tag_topics t USING (doc_id))""",
    ]
)

# Parsing of the date shapes that occur in the derived articles.
DATE_FORMATS = "['%Y-%m-%d %H:%M:%S', '%Y-%b-%d %H:%M:%S']"
WALL = (
    "try_strptime(CASE"
    r" WHEN regexp_matches(pub_date, '^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}')"
    " THEN substr(pub_date, 1, 10) || ' ' || substr(pub_date, 12, 8)"
    r" WHEN regexp_matches(pub_date, '^[A-Z][a-z]{2}, \d{2} [A-Z][a-z]{2} \d{4} ')"
    " THEN substr(pub_date, 13, 4) || '-' || substr(pub_date, 9, 3) || '-' || substr(pub_date, 6, 2) || substr(pub_date, 17, 9)"
    f" ELSE 'none' END, {DATE_FORMATS})"
)
PARSED = f"({WALL} - INTERVAL (CASE WHEN pub_date LIKE '%+02:00' THEN 120 ELSE 0 END) MINUTE)"

