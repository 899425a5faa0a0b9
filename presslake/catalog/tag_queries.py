"""Queries over tags: continents, keywords, topics, countries, regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.catalog import sql as S
from presslake.catalog.corpus import ARTICLES, load, spread_articles
from presslake.catalog.registry import query
from presslake.functions import lexicons as lex
from presslake.functions import tagging as T
from presslake.functions import text as X
from presslake.functions.match import WORD
from presslake.operators import evaluation, joins, rollups
from presslake.operators.shape import compute_once


def all_text(df: DataFrame):
    return X.tag_text(df["title"], df["description"], df["content"])


def tagged(spark: SparkSession, sf_dir: str, *texts: str) -> DataFrame:
    """Articles with their tags; of the tags read from the text only those asked for (all if none)."""
    texts = texts or ("continents", "matched_keywords")
    df = spread_articles(spark, sf_dir)
    readers = {"continents": T.continents, "matched_keywords": T.matched_keywords}
    found = compute_once(df, **{f"found_{name}": readers[name](all_text(df)) for name in texts})
    tags = {name: F.col(f"found_{name}") for name in texts}
    if "matched_keywords" in tags:
        tags["core_topics"] = T.core_topics(tags["matched_keywords"])
    tags["special_tags"] = T.special_tags(F.col("feed_url"))
    struct = F.struct(*[column.alias(name) for name, column in tags.items()])
    return found.withColumn("tags", struct).drop(*[f"found_{name}" for name in texts])


def _join(column: str):
    return F.array_join(column, "|")


@query("tag_continents", "SELECT doc_id, array_to_string(continents, '|') AS continents FROM tagged", [ARTICLES, S.TAGGED])
def tag_continents(spark, sf_dir):
    return tagged(spark, sf_dir, "continents").select("doc_id", _join("tags.continents").alias("continents"))


@query("tag_keywords", "SELECT doc_id, array_to_string(keywords, '|') AS keywords FROM tagged", [ARTICLES, S.TAGGED])
def tag_keywords(spark, sf_dir):
    return tagged(spark, sf_dir, "matched_keywords").select("doc_id", _join("tags.matched_keywords").alias("keywords"))


@query("tag_topics", "SELECT doc_id, array_to_string(topics, '|') AS topics FROM tagged", [ARTICLES, S.TAGGED])
def tag_topics(spark, sf_dir):
    return tagged(spark, sf_dir, "matched_keywords").select("doc_id", _join("tags.core_topics").alias("topics"))


@query(
    "tag_struct_counts",
    """SELECT continent, coalesce(topic, 'none') AS topic, CAST(count(*) AS BIGINT) AS articles
FROM (SELECT doc_id, unnest(continents) AS continent, topics FROM tagged) c
LEFT JOIN (SELECT doc_id, unnest(topics) AS topic FROM tagged) t USING (doc_id)
GROUP BY ALL""",
    [ARTICLES, S.TAGGED],
)
def tag_struct_counts(spark, sf_dir):
    """Articles by continent and topic: the flagship query."""
    df = spread_articles(spark, sf_dir)
    tags = df.select(T.tag_article(all_text(df)).alias("tags"))
    each = tags.select(F.explode_outer("tags.continents").alias("continent"), "tags.core_topics").select(
        "continent", F.explode_outer("core_topics").alias("topic")
    )
    return each.groupBy("continent", F.coalesce("topic", F.lit("none")).alias("topic")).agg(
        F.count("*").alias("articles")
    )


@query(
    "tag_countries",
    "SELECT doc_id, coalesce(array_to_string(found, '|'), '') AS countries FROM articles LEFT JOIN tag_countries USING (doc_id)",
    [
        ARTICLES,
        f"texts AS (SELECT doc_id, lower(translate({S.AND_TEXT}, 'İıſ', 'iis')) AS low FROM articles)",
        S.found_list("tag_countries", "texts", "doc_id", "low", list(S.country_rows())),
    ],
)
def tag_countries(spark, sf_dir):
    df = spread_articles(spark, sf_dir)
    return df.select("doc_id", F.array_join(T.countries(all_text(df)), "|").alias("countries"))


REGIONS = lex.region_lexicon(lex.REGION_TERMS)
REGION_LIST = S.found_list(
    "found_regions", "texts", "doc_id", "low",
    list(S.word_rows((t, r) for r, terms in REGIONS.items() for t in terms)),
)
LOW_TEXTS = f"texts AS (SELECT doc_id, lower({S.AND_TEXT}) AS low FROM articles)"


@query(
    "tag_regions",
    "SELECT doc_id, coalesce(array_to_string(found, '|'), '') AS regions FROM articles LEFT JOIN found_regions USING (doc_id)",
    [ARTICLES, LOW_TEXTS, REGION_LIST],
)
def tag_regions(spark, sf_dir):
    df = spread_articles(spark, sf_dir)
    return df.select("doc_id", F.array_join(T.regions(all_text(df), REGIONS), "|").alias("regions"))


@query(
    "legislation_tags",
    """SELECT doc_id, array_to_string(continents, '|') AS continents, array_to_string(special, '|') AS special_by_feed,
  'legislation' AS special FROM tagged""",
    [ARTICLES, S.TAGGED],
)
def legislation_tags(spark, sf_dir):
    df = spread_articles(spark, sf_dir)
    return df.select(
        "doc_id", T.legislation_tags(all_text(df)).alias("tags"), T.special_tags(F.col("feed_url")).alias("by_feed")
    ).select(
        "doc_id",
        _join("tags.continents").alias("continents"),
        _join("by_feed").alias("special_by_feed"),
        _join("tags.special_tags").alias("special"),
    )


# Terms that occur in the supplied prose as it is, of several languages.
PROSE_TERMS = [
    ("that", "en"), ("was", "en"), ("from", "en"), ("que", "fr"), ("les", "fr"), ("der", "de"),
    ("nicht", "de"), ("para", "es"), ("supply chain", "news"), ("Moody's", "news"), ("U.S", "news"),
]


LEXICON_LABELS = " ".join(f"WHEN {S.quoted(t)} THEN {S.quoted(g)}" for t, g in PROSE_TERMS)


@query(
    "lexicon_join",
    f"""SELECT doc_id, term, CASE term {LEXICON_LABELS} END AS label FROM (
  SELECT doc_id, unnest({S.found_values('low', [(t.lower(), t, S.term_pattern(t.lower())) for t, _ in PROSE_TERMS])}) AS term
  FROM (SELECT doc_id, lower(text) AS low FROM documents UNION ALL
    SELECT conv_id * 1000 + turn + 1000000000, lower(text) FROM conversations))""",
)
def lexicon_join(spark, sf_dir):
    """Texts of both corpora with the terms of a lexicon table found in them."""
    texts = load(spark, sf_dir, "documents").select("doc_id", "text").unionByName(
        load(spark, sf_dir, "conversations").select(
            (F.col("conv_id") * 1000 + F.col("turn") + 1_000_000_000).alias("doc_id"), "text"
        )
    )
    lexicon = spark.createDataFrame(PROSE_TERMS, "term string, label string")
    return joins.explode_matches(texts, lexicon, "doc_id", "text")


ODD_TERMS = ["eu ", "u.s.", "c++", "&", "moody's", "supply chain"]


@query(
    "lexicon_join_large",
    f"""WITH texts AS (SELECT doc_id, lower(text || ' the eu_x, U.S.A & Moody''s supply chain') AS low FROM documents),
words AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(low, '[\\p{{L}}\\p{{N}}_]+'))) AS term FROM texts),
lexicon AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS term FROM benchmark)
SELECT doc_id, term, CAST(length(term) AS INTEGER) AS letters FROM words JOIN lexicon USING (term)
UNION ALL SELECT doc_id, term, CAST(length(term) AS INTEGER) FROM (SELECT doc_id,
  unnest({S.found_values('low', [(t, t, S.term_pattern(t)) for t in ODD_TERMS])}) AS term FROM texts)""",
)
def lexicon_join_large(spark, sf_dir):
    """All words of the benchmark, and terms with odd edges, taken as a lexicon in several blocks."""
    text = F.concat("text", F.lit(" the eu_x, U.S.A & Moody's supply chain"))
    texts = load(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    words = F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+")).alias("term")
    terms = load(spark, sf_dir, "benchmark").select(words).where("term <> ''").distinct()
    odd = spark.createDataFrame([(t,) for t in ODD_TERMS], "term string")
    lexicon = terms.unionByName(odd).withColumn("letters", F.char_length("term"))
    return joins.explode_matches(texts, lexicon, "doc_id", "text", block=256)


TOKENS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]"


@query(
    "lexicon_join_huge",
    f"""WITH texts AS (SELECT doc_id AS id, lower(text || ' the eu_x, U.S.A & Moody''s supply chain. ') AS low FROM documents
  UNION ALL SELECT -1 - conv_id * 1000 - turn, lower(text) FROM conversations),
cut AS (SELECT id, low, regexp_extract_all(low, '{TOKENS}') AS tokens FROM texts),
words AS (SELECT id, unnest(list_distinct(list_filter(tokens, lambda t: regexp_matches(t, '^[\\p{{L}}\\p{{N}}_]')))) AS term FROM cut),
runs AS (SELECT id, unnest(list_distinct(list_transform(list_filter(range(1, len(tokens) - 1),
    lambda i: regexp_matches(tokens[i], '^[\\p{{L}}\\p{{N}}_]') AND tokens[i + 1] = ' ' AND regexp_matches(tokens[i + 2], '^[\\p{{L}}\\p{{N}}_]')),
    lambda i: tokens[i] || ' ' || tokens[i + 2]))) AS term FROM cut),
pairs AS (SELECT DISTINCT term FROM runs WHERE id < 0)
SELECT term, CAST(count(*) AS BIGINT) AS texts, min(id) AS first_id, max(id) AS last_id FROM (
  SELECT id, term FROM words UNION ALL SELECT id, term FROM runs JOIN pairs USING (term)
  UNION ALL SELECT id, unnest({S.found_values('low', [(t, t, S.term_pattern(t)) for t in ODD_TERMS if t != "supply chain" ])}) FROM texts
  UNION ALL SELECT id, 'supply chain' FROM runs WHERE term = 'supply chain' AND 'supply chain' NOT IN (SELECT term FROM pairs))
GROUP BY term""".replace("\\\\", "\\"),
)
def lexicon_join_huge(spark, sf_dir):
    """A lexicon of all words of all texts, all pairs of words of the conversations and terms with odd edges, as a table."""
    odd_text = F.concat(F.lower("text"), F.lit(" the eu_x, U.S.A & Moody's supply chain. "))
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), odd_text.alias("text"))
    talks = load(spark, sf_dir, "conversations").select((-1 - F.col("conv_id") * 1000 - F.col("turn")).alias("id"), F.lower("text").alias("text"))
    texts = docs.unionByName(talks)
    parts = lambda df, pattern: df.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(pattern), F.lit(1))).alias("term"))
    words = parts(texts, f"({WORD}++)")
    pairs = parts(talks, f"(?<!{WORD})(?=({WORD}++ {WORD}++))")
    odd = spark.createDataFrame([(t,) for t in ODD_TERMS], "term string")
    lexicon = words.union(pairs).union(odd).distinct()
    found = joins.explode_matches(texts, lexicon, "id", "text")
    return found.groupBy("term").agg(F.count("*").alias("texts"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query(
    "keyword_topics",
    f"""SELECT keyword, topic, CAST(count(*) AS BIGINT) AS articles
FROM (SELECT DISTINCT doc_id, unnest(found) AS keyword FROM tag_keywords)
JOIN ({S.values((t.lower(), topic) for topic, terms in lex.TOPIC_TERMS.items() for t in terms)}) AS topics(term, topic)
ON lower(keyword) = term GROUP BY ALL""",
    [ARTICLES, LOW_TEXTS, S.keyword_list("tag_keywords", "texts", "doc_id", "low")],
)
def keyword_topics(spark, sf_dir):
    df = spread_articles(spark, sf_dir)
    keyed = df.select("doc_id", T.matched_keywords(all_text(df)).alias("keywords"))
    return (
        joins.keyword_topics(keyed, "keywords").groupBy("keyword", "topic").agg(F.count("*").alias("articles"))
    )


@query(
    "geo_distribution",
    """SELECT continent, CAST(n AS BIGINT) AS articles, round(n / (sum(n) OVER ()), 6) AS share
FROM (SELECT continent, count(*) AS n FROM (SELECT unnest(continents) AS continent FROM tagged) GROUP BY ALL)""",
    [ARTICLES, S.TAGGED],
)
def geo_distribution(spark, sf_dir):
    df = spread_articles(spark, sf_dir)
    return rollups.geo_distribution(df.select(T.continents(all_text(df)).alias("continents")))


# Detection cases: each article, expected to name the region of its phrase.
EXPECTED = {0: ["Africa"], 7: ["Latin America"], 8: ["MENA"], 10: ["Africa", "MENA"]}
NAMES = ["Africa desk", "Brazil desk", "Saudi desk", "Global desk", "Town desk"]


def detection_cases(spark, sf_dir):
    df = spread_articles(spark, sf_dir)
    kind = F.col("doc_id") % 13
    expected = F.array().cast("array<string>")
    for number, names in EXPECTED.items():
        expected = F.when(kind == number, F.array(*[F.lit(n) for n in names])).otherwise(expected)
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (F.col("doc_id") % 5 + 1).cast("int"))
    cases = df.select("doc_id", name.alias("name"), all_text(df).alias("text"), expected.alias("expected"))
    return evaluation.evaluate(cases, T.regions(F.col("text"), REGIONS))


def _sql_list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


CASES = f"""cases AS (
  SELECT doc_id, {_sql_list(NAMES)}[doc_id % 5 + 1] AS name, coalesce(found, []) AS detected,
    CASE {' '.join(f'WHEN doc_id % 13 = {k} THEN {_sql_list(v)}' for k, v in EXPECTED.items())} ELSE [] END AS expected
  FROM articles LEFT JOIN found_regions USING (doc_id)),
results AS (
  SELECT *, list_sort(list_filter(expected, lambda x: NOT list_contains(detected, x))) AS missing,
    list_sort(list_filter(detected, lambda x: NOT list_contains(expected, x))) AS extra FROM cases)"""


@query(
    "region_accuracy",
    """SELECT CASE WHEN contains(name, 'Africa') THEN 'Africa'
    WHEN contains(name, 'Latin America') OR contains(name, 'Brazil') OR contains(name, 'Mexico') THEN 'Latin America'
    WHEN contains(name, 'MENA') OR contains(name, 'Saudi') OR contains(name, 'UAE') THEN 'MENA'
    WHEN contains(name, 'Global') OR contains(name, 'International') THEN 'Multi-continent'
    ELSE 'Edge cases' END AS bucket,
  CAST(count(*) FILTER (len(missing) = 0) AS BIGINT) AS passed,
  CAST(count(*) FILTER (len(missing) > 0) AS BIGINT) AS failed, CAST(count(*) AS BIGINT) AS total
FROM results GROUP BY 1""",
    [ARTICLES, LOW_TEXTS, REGION_LIST, CASES],
)
def region_accuracy(spark, sf_dir):
    return evaluation.region_accuracy(detection_cases(spark, sf_dir))


@query(
    "failure_patterns",
    """SELECT kind, regions, CAST(count(*) AS BIGINT) AS cases FROM (
  SELECT 'missing' AS kind, array_to_string(missing, ', ') AS regions FROM results WHERE len(missing) > 0
  UNION ALL SELECT 'false_positive', array_to_string(extra, ', ') FROM results WHERE len(missing) > 0)
WHERE regions <> '' GROUP BY ALL""",
    [ARTICLES, LOW_TEXTS, REGION_LIST, CASES],
)
def failure_patterns(spark, sf_dir):
    return evaluation.failure_patterns(detection_cases(spark, sf_dir))
