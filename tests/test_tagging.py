"""Tags against their stated rules, restated term by term."""

import random
import re

import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslake.functions import lexicons as lex
from presslake.functions import predicates as P
from presslake.functions import tagging as T
from presslake.functions.match import ANYWHERE, WHOLE_WORD, WORD_START, TermScanner

WORD = r"[\p{L}\p{N}_]"


def sits(term: str, mode: str, text: str) -> bool:
    """One term on its own, by the rules of whole words."""
    pattern = regex.escape(term)
    if mode != ANYWHERE:
        pattern = (f"(?<!{WORD})" if regex.match(WORD, term[0]) else f"(?<={WORD})") + pattern
    if mode == WHOLE_WORD:
        pattern += f"(?!{WORD})" if regex.match(WORD, term[-1]) else f"(?={WORD})"
    return regex.search(pattern, text) is not None


TERMS = st.text(alphabet="ab é.", min_size=1, max_size=4).filter(lambda t: t.strip())


@settings(max_examples=300, deadline=None)
@given(
    st.dictionaries(TERMS, st.sampled_from([WHOLE_WORD, WORD_START, ANYWHERE]), min_size=1, max_size=6),
    st.text(alphabet="ab é._1", max_size=16),
)
def test_one_scan_finds_what_single_terms_find(terms, text):
    scanner = TermScanner(terms)
    hits = {m.group(1) for p in scanner.patterns for m in regex.finditer(p, text)}
    for term, mode in terms.items():
        shown = any(e in hits for e in scanner.evidence(term))
        assert shown == sits(term, mode, text), (term, mode, text, hits)
    assert any(regex.search(p, text) for p in scanner.patterns) == any(sits(t, m, text) for t, m in terms.items())


def made_texts(n=600):
    rng = random.Random(7)
    words = [t for terms in lex.CONTINENT_TERMS.values() for t in terms] + lex.NEWS_KEYWORDS + lex.POLITICAL_TERMS
    words += [t for kinds in lex.COUNTRY_TERMS.values() for terms in kinds.values() for t in terms]
    glue = [" ", " ", "", ", ", "-", "_", "é", "²", "'s ", "\n", "x", "1", " (", "İ", "ſ"]
    texts = ["", "quarterly results improved", "a comparison of results"]
    for _ in range(n):
        part = ""
        for _ in range(rng.randint(1, 5)):
            word = rng.choice(words)
            part += rng.choice([word, word.upper(), word.title()]) + rng.choice(glue)
        texts.append(part)
    return texts


def test_all_tags_against_restatement(spark):
    texts = made_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(8)
    text = F.col("text")
    rows = df.select(
        "text",
        T.tag_article(text).alias("tags"),
        T.countries(text).alias("countries"),
        T.regions(text).alias("regions"),
        P.matches_keywords(text).alias("gate"),
        P.is_political(F.lit(""), text, F.lit(None).cast("string")).alias("political"),
    ).collect()
    regions = lex.region_lexicon(lex.REGION_TERMS)
    kinds = {"word": WHOLE_WORD, "start": WORD_START, "anywhere": ANYWHERE}
    assert len(rows) == len(texts)
    for row in rows:
        low = row.text.lower()
        found = sorted(
            c for c, terms in lex.CONTINENT_TERMS.items()
            if any(sits(t, WHOLE_WORD if len(t) <= 3 else ANYWHERE, low) for t in terms)
        )
        assert row.tags.continents == (["Unclear"] if not row.text else found or ["Global"]), row.text
        keywords = [k for k in lex.NEWS_KEYWORDS if sits(k.lower(), WHOLE_WORD, low)]
        assert row.tags.matched_keywords == keywords, row.text
        topics = sorted(t for t, terms in lex.TOPIC_TERMS.items() if {k.lower() for k in keywords} & set(terms))
        assert row.tags.core_topics == topics, row.text
        folded = row.text.replace("İ", "i").replace("ı", "i").replace("ſ", "s").lower()
        countries = sorted(
            c for c, by_kind in lex.COUNTRY_TERMS.items()
            if any(sits(t.lower(), kinds[k], folded) for k, terms in by_kind.items() for t in terms)
        )
        assert row.countries == countries, row.text
        assert row.regions == sorted(r for r, ts in regions.items() if any(sits(t, WHOLE_WORD, low) for t in ts))
        assert row.gate == bool(keywords)
        assert row.political == any(sits(t, WHOLE_WORD, low + " ") for t in lex.POLITICAL_TERMS), row.text


def test_known_answers(spark):
    cases = {
        None: (["Unclear"], [], []),
        "": (["Unclear"], [], []),
        "quarterly results improved": (["Global"], [], []),
        "a comparison of results": (["Europe"], [], []),
        "please tell us": (["Americas"], [], []),
        "climate risk rises": (["Global"], ["climate risk", "climate risk"], ["geopolitics", "insurance"]),
        "bitcoin rallies": (["Global"], [], []),
        "AI-led": (["Global"], ["AI"], ["ai"]),
        "AI's": (["Global"], ["AI"], ["ai"]),
        "he said": (["Global"], [], []),
        "éAI": (["Global"], [], []),
        "AI²": (["Global"], [], []),
        "١ai": (["Global"], [], []),
        "the world of gas in Peru": (["Americas", "Global"], ["gas"], ["energy"]),
    }
    df = spark.createDataFrame([(k,) for k in cases], "text string")
    for row in df.select("text", T.tag_article(F.col("text")).alias("t")).collect():
        assert (row.t.continents, row.t.matched_keywords, row.t.core_topics) == cases[row.text], row.text
    political = spark.createDataFrame([("the eu member",), ("the eu (x",), ("eu",)], "q string")
    none = F.lit(None).cast("string")
    got = political.select("q", P.is_political(none, F.col("q"), none).alias("p")).collect()
    assert {r.q: r.p for r in got} == {"the eu member": True, "the eu (x": False, "eu": False}


def test_short_lexicons_and_special_tags(spark):
    df = spark.createDataFrame([("https://www.congress.gov/rss/a.xml",), ("https://a.org",), (None,)], "u string")
    got = [r.s for r in df.select(T.special_tags(F.col("u")).alias("s")).collect()]
    assert got == [["legislation"], [], []]
    own = df.select(T.matched_keywords(F.lit("Gas and oil"), ["Oil", "coal", "oil"]).alias("k")).first().k
    assert own == ["Oil", "oil"]


def test_lexicon_lengths():
    assert {c: len(t) for c, t in lex.CONTINENT_TERMS.items()} == {
        "Americas": 50, "Europe": 46, "Asia": 45, "Africa": 17, "Oceania": 7, "Global": 8,
    }
    assert [len(t) for t in lex.TOPIC_TERMS.values()] == [27, 9, 7, 6, 14]
    assert (len(lex.NEWS_KEYWORDS), len(set(lex.NEWS_KEYWORDS))) == (63, 62)
    assert (len(lex.COUNTRY_TERMS), len(lex.POLITICAL_TERMS)) == (36, 46)
    assert re.fullmatch("[a-z -]+", "".join(lex.POLITICAL_TERMS))


def test_whole_region_lexicon(spark):
    assert len(lex.REGION_TERMS) == 342 and len({t for t, _ in lex.REGION_TERMS}) == 311
    places = {"Abuja": ["Africa"], "Cape Town": ["Africa"], "Dakar, Senegal": ["Africa"], "Cuenca": ["Latin America"], "Tripoli": ["MENA"], "Oslo": []}
    rows = spark.createDataFrame([(p,) for p in places], "text string").select("text", T.regions(F.col("text")).alias("found")).collect()
    assert {r.text: r.found for r in rows} == places


def test_region_lexicon_table_of_many_rows(spark):
    table = spark.range(21_000).selectExpr("concat('place', id) AS term", "concat('r', id % 3) AS region", "id AS position")
    regions = lex.region_lexicon(table)
    assert sum(map(len, regions.values())) == 21_000
    small = {r: terms[:7] for r, terms in regions.items()}
    df = spark.createDataFrame([("place20 and place1 or place0",), ("none",), (None,)], "text string")
    for block in (4, 2_000):
        found = [r[0] for r in df.select(T.regions(F.col("text"), small, block)).collect()]
        assert found == [["r0", "r1", "r2"], [], []]
