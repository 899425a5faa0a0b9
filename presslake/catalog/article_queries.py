"""Queries over articles: filters, keys, dates, descriptions, searches and rollups."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.catalog import sql as S
from presslake.catalog.corpus import ARTICLES, AS_OF, articles, load, quoted, spread_articles
from presslake.catalog.registry import query
from presslake.catalog.tag_queries import tagged
from presslake.functions import dates as D
from presslake.functions import lexicons as lex
from presslake.functions import predicates as P
from presslake.functions import tagging as T
from presslake.functions import text as X
from presslake.operators import copies, dedup, index, joins, quality, rollup_store, rollups, search, search_index
from presslake.session import scratch_dir
from presslake.sources import store

NOW = datetime.fromisoformat(AS_OF)
NEWS_WORDS = list(lex.NEWS_KEYWORDS)


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------
@query(
    "keyword_gate",
    f"SELECT doc_id, url FROM (SELECT *, lower(title || ' ' || description) AS low FROM articles) WHERE {S.any_word('low', NEWS_WORDS)}",
    [ARTICLES],
)
def keyword_gate(spark, sf_dir):
    df = spread_articles(spark, sf_dir)
    return df.where(P.rss_gate(F.col("title"), F.col("description"))).select("doc_id", "url")


@query(
    "direct_gate",
    f"""SELECT doc_id, url FROM (SELECT *, lower(title) AS low_title, lower(content) AS low FROM articles)
WHERE {S.any_word('low_title', NEWS_WORDS)} AND {S.any_word('low', NEWS_WORDS)}""",
    [ARTICLES],
)
def direct_gate(spark, sf_dir):
    df = spread_articles(spark, sf_dir)
    return df.where(P.direct_gate(F.col("title"), F.col("content"))).select("doc_id", "url")


@query(
    "year_filter",
    r"""SELECT doc_id, 1 AS as_run, CAST(coalesce(try_cast(nullif(regexp_extract(pub_date, '(20\d\d)', 1), '') AS INTEGER) >= 2025, true) AS INTEGER) AS strict
FROM articles""",
    [ARTICLES],
)
def year_filter(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "doc_id",
        D.year_filter(F.col("pub_date")).cast("int").alias("as_run"),
        D.year_filter(F.col("pub_date"), strict=True).cast("int").alias("strict"),
    )


@query(
    "recent_filter",
    rf"""SELECT doc_id, CAST(CASE WHEN pub_date = '' THEN true
    WHEN parsed IS NOT NULL THEN parsed >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY
    WHEN regexp_extract(pub_date, '(\d{{4}})', 1) <> '' THEN CAST(regexp_extract(pub_date, '(\d{{4}})', 1) AS INTEGER) >= 2025
    ELSE true END AS INTEGER) AS recent,
  CAST(coalesce(parsed > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY, false) AS INTEGER) AS entry_recent
FROM (SELECT *, {S.PARSED} AS parsed FROM articles)""",
    [ARTICLES],
)
def recent_filter(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "doc_id",
        D.recent(F.col("pub_date"), NOW).cast("int").alias("recent"),
        D.entry_recent(F.col("pub_date"), NOW).cast("int").alias("entry_recent"),
    )


@query(
    "length_gate",
    "SELECT doc_id, length(content) AS chars FROM articles WHERE url <> '' AND length(content) > 100",
    [ARTICLES],
)
def length_gate(spark, sf_dir):
    df = articles(spark, sf_dir)
    kept = df.where(P.has_link(F.col("url")) & P.has_content(F.col("content"), P.MIN_NEWS_CHARS))
    return kept.select("doc_id", X.content_length(F.col("content")).cast("long").alias("chars"))


URL_FORMS = ["/news/2025/", "/tag/news/", "/about/", "/Story/", "/post/feed/"]


@query(
    "article_urls",
    f"""SELECT page_id, url FROM (SELECT page_id, url || ({'[' + ', '.join(S.quoted(u) for u in URL_FORMS) + ']'})[page_id % 5 + 1] AS url FROM pages)
WHERE NOT {S.any_part('lower(url)', lex.SKIP_URL_PARTS)} AND {S.any_part('lower(url)', lex.ARTICLE_URL_PARTS)}""",
)
def article_urls(spark, sf_dir):
    form = F.element_at(F.array(*[F.lit(u) for u in URL_FORMS]), (F.col("page_id") % 5 + 1).cast("int"))
    urls = load(spark, sf_dir, "pages").select("page_id", F.concat("url", form).alias("url"))
    return urls.where(P.is_article_url(F.col("url")))


REGION_TEST = "CASE region " + " ".join(
    f"WHEN '{name}' THEN {S.any_part('low', terms)}" for name, terms in lex.REGION_RELEVANCE_TERMS.items()
) + " ELSE true END"


@query(
    "relevant_sources",
    f"""SELECT doc_id, CAST({S.any_part('low', lex.RELEVANCE_TERMS)} AS INTEGER) AS relevant, CAST({REGION_TEST} AS INTEGER) AS regional
FROM (SELECT doc_id, lower(title || description) AS low, (['Africa', 'Latin America', 'MENA', 'Global'])[doc_id % 4 + 1] AS region FROM articles)""",
    [ARTICLES],
)
def relevant_sources(spark, sf_dir):
    regions = F.array(*[F.lit(r) for r in ("Africa", "Latin America", "MENA", "Global")])
    region = F.element_at(regions, (F.col("doc_id") % 4 + 1).cast("int"))
    text = F.concat("title", "description")
    return articles(spark, sf_dir).select(
        "doc_id",
        P.is_relevant(text).cast("int").alias("relevant"),
        P.is_regional(text, region).cast("int").alias("regional"),
    )


# ---------------------------------------------------------------------------
# Searches
# ---------------------------------------------------------------------------
SHOWN = "CASE WHEN length(plain) > 300 THEN substr(plain, 1, 300) || '...' ELSE plain END"


@query(
    "faceted_search",
    f"""SELECT doc_id, url FROM (SELECT *, regexp_replace(description, '<[^>]*>', '', 'g') AS plain FROM tagged)
WHERE contains(lower(coalesce(source, 'Unknown')), 'src1') AND list_contains(continents, 'Europe')
  AND list_contains(topics, 'energy') AND len(list_filter(keywords, lambda k: contains(lower(k), 'nucl'))) > 0
  AND (contains(lower(title), 'summit') OR contains(lower({SHOWN}), 'summit'))
UNION ALL SELECT doc_id, url FROM tagged WHERE list_contains(special, 'legislation') AND list_contains(topics, 'insurance')""",
    [ARTICLES, S.TAGGED],
)
def faceted_search(spark, sf_dir):
    df = tagged(spark, sf_dir)
    news = search.facet_test(source="src1", continent="Europe", topic="energy", keyword="nucl", term="Summit")
    bills = search.facet_test(special="legislation", topic="insurance")
    # Two searches in one pass: an article is listed once for each that it passes.
    passed = F.array_compact(F.array(F.when(news, F.lit("news")), F.when(bills, F.lit("bills"))))
    return df.select("doc_id", "url", F.explode(passed).alias("search")).drop("search")


SEARCH_TERMS = ["lithium and", "RESULTS", "ai", "ü", "e", "s: ", "not in any text", "project grows</p>", "in the "]


@query(
    "indexed_search",
    f"""SELECT terms.term, doc_id, title, CAST(collection_date AS VARCHAR) AS day FROM articles, (VALUES {', '.join(f"({quoted(t)})" for t in SEARCH_TERMS)}) AS terms(term)
WHERE contains(lower(title), lower(terms.term)) OR contains(lower(description), lower(terms.term))
UNION ALL SELECT 'on a day', doc_id, title, CAST(collection_date AS VARCHAR) FROM articles
WHERE collection_date = DATE '2025-11-04' AND (contains(lower(title), 'gas') OR contains(lower(description), 'gas'))""",
    [ARTICLES],
)
def indexed_search(spark, sf_dir):
    """All articles indexed in three batches, one of them sent twice, and searched for terms of all lengths."""
    path = scratch_dir(spark, "search-index")
    df = articles(spark, sf_dir).select("doc_id", "title", "description", "collection_date")
    for part in (0, 1, 1, 2):
        search_index.append(df.where(F.pmod("doc_id", F.lit(3)) == part), path, f"batch {part}")
    day = search_index.search(spark, path, "gas", date="2025-11-04").withColumn("term", F.lit("on a day"))
    rows = search_index.search_terms(spark, path, SEARCH_TERMS).unionByName(day)
    return rows.select("term", "doc_id", "title", F.col("collection_date").cast("string").alias("day"))


@query(
    "archive_search",
    """SELECT doc_id, url FROM articles WHERE collection_date = DATE '2025-11-04'
  AND contains(lower(coalesce(source, 'Unknown')), 'src')
  AND (contains(lower(title), 'results') OR contains(lower(description), 'results'))""",
    [ARTICLES],
)
def archive_search(spark, sf_dir):
    found = search.archive_search(articles(spark, sf_dir), date="2025-11-04", source="SRC", term="results")
    return found.select("doc_id", "url")


@query(
    "date_search",
    """SELECT CAST(collection_date AS VARCHAR) AS collection_date, n AS article_count
FROM (SELECT collection_date, CAST(count(*) AS BIGINT) AS n FROM articles GROUP BY 1)
WHERE contains(CAST(collection_date AS VARCHAR), '7') OR contains(CAST(n AS VARCHAR), '7')""",
    [ARTICLES],
)
def date_search(spark, sf_dir):
    found = search.date_search(rollups.date_rollup(articles(spark, sf_dir)), "7")
    return found.select(F.col("collection_date").cast("string").alias("collection_date"), "article_count")


@query(
    "daily_search",
    """SELECT doc_id FROM tagged WHERE contains(lower(coalesce(source, 'Unknown')), 'src')
  AND contains(lower(array_to_string(keywords, ',')), 'i,supply')
  UNION ALL SELECT doc_id FROM tagged WHERE contains(lower(array_to_string(keywords, ',')), 'power')
  AND (contains(lower(title), 'project') OR contains(lower(description), 'project'))""",
    [ARTICLES, S.TAGGED],
)
def daily_search(spark, sf_dir):
    df = tagged(spark, sf_dir, "matched_keywords")
    first = search.daily_search(df, source="Src", keyword="i,supply").select("doc_id")
    return first.unionByName(search.daily_search(df, keyword="power", term="Project").select("doc_id"))


@query(
    "type_counts",
    f"""SELECT CAST(collection_date AS VARCHAR) AS collection_date, CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (law) AS BIGINT) AS legislation, CAST(count(*) FILTER (NOT law) AS BIGINT) AS regular
FROM (SELECT *, {S.any_part('feed_url', lex.LEGISLATIVE_DOMAINS)} AS law FROM articles) GROUP BY 1""",
    [ARTICLES],
)
def type_counts(spark, sf_dir):
    df = articles(spark, sf_dir)
    tags = F.struct(T.special_tags(F.col("feed_url")).alias("special_tags"))
    return _dated(rollups.type_counts(df.withColumn("tags", tags)))


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------
PATH = "CASE WHEN origin IN ('rss', 'direct') THEN origin || '/' ELSE '' END || 'content/' || md5(url) || '.html'"
LABEL = """CASE origin WHEN 'rss' THEN 'RSS Feed' WHEN 'direct' THEN 'Direct Scraping'
  WHEN 'legislation' THEN 'Legislation Feed' WHEN 'market' THEN 'Polymarket' END"""


@query(
    "article_keys",
    f"SELECT doc_id, md5(url) AS article_id, length(content) AS chars, {PATH} AS content_path, {LABEL} AS label FROM articles",
    [ARTICLES],
)
def article_keys(spark, sf_dir):
    key = X.article_id(F.col("url"))
    return articles(spark, sf_dir).select(
        "doc_id",
        key.alias("article_id"),
        X.content_length(F.col("content")).cast("long").alias("chars"),
        X.content_path(F.col("origin"), key).alias("content_path"),
        X.source_label(F.col("origin")).alias("label"),
    )


@query(
    "clean_descriptions",
    f"""SELECT doc_id, {SHOWN} AS description, substr(description, 1, 500) AS market_description
FROM (SELECT *, regexp_replace(description, '<[^>]*>', '', 'g') AS plain FROM articles)""",
    [ARTICLES],
)
def clean_descriptions(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "doc_id",
        X.clean_description(F.col("description")).alias("description"),
        X.market_description(F.col("description")).alias("market_description"),
    )


SHOWN_DATE = f"coalesce(strftime({S.WALL}, '%B %d, %Y at %I:%M %p'), pub_date)"


@query(
    "pub_date_parse",
    f"""SELECT doc_id, strftime({S.PARSED}, '%Y-%m-%d %H:%M:%S') AS instant, strftime({S.WALL}, '%Y-%m-%d %H:%M:%S') AS wall,
  {SHOWN_DATE} AS shown, strftime(collection_date, '%B %d, %Y') AS day FROM articles""",
    [ARTICLES],
)
def pub_date_parse(spark, sf_dir):
    stamp = "yyyy-MM-dd HH:mm:ss"
    return articles(spark, sf_dir).select(
        "doc_id",
        F.date_format(D.parse_pub_date(F.col("pub_date")), stamp).alias("instant"),
        F.date_format(D.parse_pub_date(F.col("pub_date"), keep_wall_clock=True), stamp).alias("wall"),
        D.display_date(F.col("pub_date")).alias("shown"),
        D.display_day(F.col("collection_date")).alias("day"),
    )


# Further shapes a date is written in, each on every eighth document, with the hour that is meant.
DATE_SHAPES = [
    ("date_format(collection_date, 'MM/dd/yyyy') || ' 10:00'", 10),
    ("date_format(collection_date, 'yyyy/MM/dd')", 0),
    ("date_format(collection_date, 'dd MMM yy') || ' 10:00:00 GMT'", 10),
    ("date_format(collection_date, 'EEE MMM ') || lpad(day(collection_date), 2, ' ') || ' 10:00:00 2025'", 10),
    ("date_format(collection_date, 'yyyyMMdd') || 'T100000Z'", 10),
    ("date_format(collection_date, 'yyyy-MM-dd') || 'T10:00:00+02'", 8),
    ("day(collection_date) || CASE day(collection_date) WHEN 1 THEN 'st' WHEN 2 THEN 'nd' WHEN 3 THEN 'rd' ELSE 'th' END || ' November 2025'", 0),
    ("date_format(collection_date, 'EEEE, d MMMM yyyy') || ', 10:00'", 10),
]


@query(
    "date_shapes",
    f"""SELECT doc_id, strftime(CAST(collection_date AS TIMESTAMP) + to_hours(([{', '.join(str(h) for _, h in DATE_SHAPES)}])[doc_id % 8 + 1]),
  '%Y-%m-%d %H:%M:%S') AS instant FROM articles""",
    [ARTICLES],
)
def date_shapes(spark, sf_dir):
    """The instant of dates in the less usual shapes."""
    written = F.expr("element_at(array(" + ", ".join(shape for shape, _ in DATE_SHAPES) + "), cast(doc_id % 8 + 1 as int))")
    dated = articles(spark, sf_dir).select("doc_id", written.alias("written"))
    return dated.select("doc_id", F.date_format(D.parse_pub_date(F.col("written")), "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query(
    "bill_links",
    """SELECT doc_id, bill AS bill_id, 'https://www.govinfo.gov/content/pkg/' || bill || '/xml/' || bill || '.xml' AS xml_url,
  'https://www.govinfo.gov/content/pkg/' || bill || '/html/' || bill || '.htm' AS html_url
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'BILLS-119hr' || doc_id || 'ih' END AS bill FROM documents)""",
)
def bill_links(spark, sf_dir):
    doc = F.col("doc_id").cast("string")
    details = F.concat(F.lit("https://www.govinfo.gov/app/details/BILLS-119hr"), doc, F.lit("ih/summary"))
    url = F.when(F.col("doc_id") % 3 == 0, details).otherwise(F.concat(F.lit("https://example.org/app/details/"), doc))
    links = load(spark, sf_dir, "documents").select("doc_id", X.govinfo_links(url).alias("links"))
    return links.select("doc_id", "links.*")


# ---------------------------------------------------------------------------
# Deduplication, anti-joins, order
# ---------------------------------------------------------------------------
@query(
    "dedupe_urls",
    """SELECT url, min(doc_id) AS first_id, max(doc_id) AS last_id,
  arg_min(title, doc_id) AS first_title, arg_max(title, doc_id) AS last_title FROM articles GROUP BY url""",
    [ARTICLES],
)
def dedupe_urls(spark, sf_dir):
    """First save wins; in a fresh run the last one does."""
    df = articles(spark, sf_dir).select("url", "doc_id", "title")
    first = dedup.dedupe_urls(df, "doc_id").select("url", F.col("doc_id").alias("first_id"), F.col("title").alias("first_title"))
    last = dedup.dedupe_urls(df, "doc_id", keep="last").select("url", F.col("doc_id").alias("last_id"), F.col("title").alias("last_title"))
    return first.join(last, "url")


@query(
    "content_copies",
    """SELECT doc_id, min(doc_id) OVER same AS copy_of, CAST(count(*) OVER same AS BIGINT) AS copies
FROM (SELECT doc_id, trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS plain FROM documents)
WINDOW same AS (PARTITION BY plain)""",
)
def content_copies(spark, sf_dir):
    """Every text with the first one that has the same words."""
    return copies.exact_copies(load(spark, sf_dir, "documents"), "doc_id", "text")


@query("near_copies")
def near_copies(spark, sf_dir):
    """Every text with its SimHash and the first text nearly like it; SQL has no SimHash, the tests compare with all pairs."""
    return copies.near_copies(load(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    "quality_score_auc",
    f"""WITH texts AS (SELECT doc_id, text, lower(text) AS low, greatest(length(text), 1) AS chars FROM documents),
words AS (SELECT *, regexp_extract_all(low, '[\\p{{L}}\\p{{N}}]+') AS words FROM texts),
scored AS (SELECT doc_id, round(0.1 * round(ln(1 + length(text)), 9) + 0.3 * round(len(list_distinct(words)) / greatest(len(words), 1), 9)
  - 2 * round(len(regexp_extract_all(text, '\\p{{N}}')) / chars, 9) - round(len(regexp_extract_all(text, '[^\\p{{L}}\\p{{N}}\\s.,;:!?''"()-]')) / chars, 9), 4) AS score FROM words),
labelled AS (SELECT score, quality FROM scored JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
counted AS (SELECT score, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality <> 1) AS n FROM labelled GROUP BY score),
ranked AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM counted)
SELECT CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives, round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 6) AS auc FROM ranked""",
)
def quality_score_auc(spark, sf_dir):
    """How well a formula of text features ranks the labelled texts."""
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = quality.features(load(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    weights = {name: w for name, w in quality.WEIGHTS.items() if name != "keywords"}
    scored = rows.withColumn("score", F.round(quality.formula_score(weights), 4)).join(labels, "doc_id")
    return quality.auc(scored, label="quality")


@query("quality_model_auc")
def quality_model_auc(spark, sf_dir):
    """The same for a model fitted on three quarters of the labelled texts, over the others; copies of a text are on one side."""
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality")
    texts = load(spark, sf_dir, "documents").select("doc_id", "text").withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(4)))
    rows = quality.stage_features(quality.features(texts, "text").join(labels, "doc_id"), "doc_id", "fold", "quality")
    model = quality.fit_quality(rows.where("fold > 0"))
    return quality.auc(quality.model_score(rows.where("fold = 0"), model), label="quality")


@query(
    "drop_seen",
    """SELECT doc_id, url FROM articles a WHERE NOT EXISTS (
  SELECT 1 FROM articles s WHERE s.lang = 'en' AND s.url = a.url AND s.collection_date = a.collection_date)""",
    [ARTICLES],
)
def drop_seen(spark, sf_dir):
    """Articles whose URL was not collected on the same date by the English-language run."""
    df = articles(spark, sf_dir).select("doc_id", "url", "collection_date", "lang")
    seen = df.where("lang = 'en'")
    return joins.drop_seen(df, seen, keys=["collection_date", "url"]).select("doc_id", "url")


@query(
    "drop_stored",
    """SELECT doc_id, md5(url) AS article_id FROM articles WHERE md5(url) NOT IN (SELECT md5(url) FROM articles WHERE lang IN ('en', 'fr'))
  OR md5(url) NOT IN (SELECT md5(url) FROM articles WHERE lang IN ('en', 'de'))""",
    [ARTICLES],
)
def drop_stored(spark, sf_dir):
    df = articles(spark, sf_dir).select("doc_id", X.article_id(F.col("url")).alias("article_id"))
    ids = articles(spark, sf_dir).select(X.article_id(F.col("url")).alias("article_id"), "lang")
    return joins.drop_stored(df, ids.where("lang IN ('en', 'fr')"), ids.where("lang IN ('en', 'de')"))


@query(
    "pending_sources",
    """SELECT DISTINCT feed_url AS source_url FROM articles WHERE feed_url NOT IN (SELECT feed_url FROM articles WHERE host IN ('src1', 'src2', 'src10'))""",
    [ARTICLES],
)
def pending_sources(spark, sf_dir):
    df = articles(spark, sf_dir).select("host", F.col("feed_url").alias("source_url"))
    log = df.where(F.col("host").isin("src1", "src2", "src10")).select("source_url")
    return joins.pending_sources(df.select("source_url").distinct(), log)


@query(
    "attach_content",
    """SELECT doc_id, m.url, length(c.content) AS chars, CAST(0 AS INTEGER) AS orphan FROM articles m
JOIN (SELECT doc_id, content FROM articles WHERE lang <> 'de') c USING (doc_id) WHERE lang <> 'fr'
UNION ALL SELECT doc_id, 'content', 0, 1 FROM articles WHERE lang = 'de'
UNION ALL SELECT doc_id, 'metadata', 0, 1 FROM articles WHERE lang = 'fr'""",
    [ARTICLES],
)
def attach_content(spark, sf_dir):
    """Metadata with content by id, and what has only one of the two."""
    df = articles(spark, sf_dir)
    meta = df.where("lang <> 'fr'").select("doc_id", "url")
    content = df.where("lang <> 'de'").select("doc_id", "content")
    both = joins.with_content(meta, content, ["doc_id"]).select(
        "doc_id", "url", F.char_length("content").cast("long").alias("chars"), F.lit(0).alias("orphan")
    )
    lone = joins.orphans(meta.select("doc_id"), content.select("doc_id"), "doc_id").select(
        "doc_id", F.col("missing").alias("url"), F.lit(0).cast("long").alias("chars"), F.lit(1).alias("orphan")
    )
    return both.unionByName(lone)


def _dated(df):
    return df.withColumn("collection_date", F.col("collection_date").cast("string"))


@query(
    "dedupe_cards",
    """SELECT CAST(collection_date AS VARCHAR) AS date, min(doc_id) AS position, 'Daily News Collection - ' || CAST(collection_date AS VARCHAR) AS title
FROM articles WHERE lang <> 'es' GROUP BY collection_date""",
    [ARTICLES],
)
def dedupe_cards(spark, sf_dir):
    day = F.col("collection_date").cast("string")
    title = F.when(F.col("lang") != "es", F.concat(F.lit("Daily News Collection - "), day)).otherwise("About us")
    return dedup.dedupe_cards(articles(spark, sf_dir).select(title.alias("title"), F.col("doc_id").alias("position")))


@query(
    "upsert_master",
    """SELECT CAST(collection_date AS VARCHAR) AS collection_date, CAST(n AS BIGINT) AS articles, CAST(s AS BIGINT) AS sources FROM (
  SELECT collection_date, count(*) AS n, count(DISTINCT source) AS s FROM articles
  WHERE lang = 'en' AND collection_date < DATE '2025-11-09' GROUP BY 1
  UNION ALL SELECT collection_date, count(*), count(DISTINCT source) FROM articles WHERE collection_date >= DATE '2025-11-09' GROUP BY 1)""",
    [ARTICLES],
)
def upsert_master(spark, sf_dir):
    """Cards of a state with English articles only, with later dates replaced."""
    df = articles(spark, sf_dir)
    master = rollups.card_stats(df.where("lang = 'en'"))
    later = rollups.card_stats(df.where("collection_date >= DATE '2025-11-09'"))
    return _dated(rollups.upsert_master(master, later))


@query(
    "newest_first",
    f"SELECT doc_id, strftime({S.WALL}, '%Y-%m-%d %H:%M:%S') AS wall FROM articles ORDER BY 2 DESC NULLS LAST, 1",
    [ARTICLES],
)
def newest_first(spark, sf_dir):
    """All articles by the publication time they name, unreadable ones last."""
    df = articles(spark, sf_dir).select("doc_id", "pub_date")
    wall = F.date_format(index.sort_date(df), "yyyy-MM-dd HH:mm:ss")
    return dedup.newest_first(df.select("doc_id", wall.alias("wall")), F.col("wall"), "doc_id")


@query(
    "union_origins",
    """SELECT origin, CAST(count(*) AS BIGINT) AS articles, CAST(count(DISTINCT url) AS BIGINT) AS urls,
  CAST(count(description) AS BIGINT) AS described FROM (
  SELECT origin, url, description FROM articles WHERE origin <> 'direct'
  UNION ALL SELECT origin, url, NULL FROM articles WHERE origin = 'direct'
  UNION ALL SELECT 'conversation', 'conv/' || conv_id, text FROM conversations) GROUP BY 1""",
    [ARTICLES],
)
def union_origins(spark, sf_dir):
    """Corpus of all origins; scraped pages have no description column."""
    df = articles(spark, sf_dir)
    fed = df.where("origin <> 'direct'").select("origin", "url", "description", "pub_date")
    scraped = df.where("origin = 'direct'").select("origin", "url", F.col("pub_date").alias("date"))
    talks = load(spark, sf_dir, "conversations").select(
        F.lit("conversation").alias("origin"),
        F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("url"),
        F.col("text").alias("description"),
    )
    return index.union_origins(fed, scraped, talks).groupBy("origin").agg(
        F.count("*").alias("articles"), F.count_distinct("url").alias("urls"), F.count("description").alias("described")
    )


@query(
    "daily_index",
    f"""SELECT doc_id, title, coalesce(source, 'Unknown') AS source, {SHOWN_DATE} AS shown_date,
  {SHOWN} AS description, array_to_string(continents, ' ') AS continents, array_to_string(topics, ' ') AS topics,
  array_to_string(special, ' ') AS special, array_to_string(keywords, ' ') AS keywords,
  array_to_string(keywords[1:3], ' ') AS first_keywords, {PATH} AS content_path
FROM (SELECT *, regexp_replace(description, '<[^>]*>', '', 'g') AS plain FROM tagged)""",
    [ARTICLES, S.TAGGED],
)
def daily_index(spark, sf_dir):
    df = tagged(spark, sf_dir)
    shown = index.daily_index(df.withColumn("title", F.concat(F.col("doc_id").cast("string"), F.lit(chr(1)), "title")))
    parts = F.split("title", chr(1), 2)
    return shown.select(
        parts[0].cast("long").alias("doc_id"), parts[1].alias("title"), "source", "shown_date", "description",
        "continents", "topics", "special", "keywords", "first_keywords", "content_path",
    )


# ---------------------------------------------------------------------------
# Rollups
# ---------------------------------------------------------------------------
DAY = "CAST(collection_date AS VARCHAR) AS collection_date"


@query(
    "daily_stats",
    f"""SELECT {DAY}, CAST(count(*) AS BIGINT) AS articles, CAST(count(DISTINCT coalesce(source, 'Unknown')) AS BIGINT) AS sources,
  CAST(floor(sum(content_length) / 1000) AS BIGINT) AS length_k FROM articles GROUP BY 1""",
    [ARTICLES],
)
def daily_stats(spark, sf_dir):
    return _dated(rollups.daily_stats(articles(spark, sf_dir)))


@query(
    "card_stats",
    f"SELECT {DAY}, CAST(count(*) AS BIGINT) AS articles, CAST(count(DISTINCT source) AS BIGINT) AS sources FROM articles GROUP BY 1",
    [ARTICLES],
)
def card_stats(spark, sf_dir):
    return _dated(rollups.card_stats(articles(spark, sf_dir)))


@query(
    "date_rollup",
    f"""SELECT {DAY}, CAST(count(*) AS BIGINT) AS article_count, CAST(sum(content_length) AS BIGINT) AS total_length,
  CAST(count(DISTINCT coalesce(source, 'Unknown')) AS BIGINT) AS source_count FROM articles GROUP BY 1""",
    [ARTICLES],
)
def date_rollup(spark, sf_dir):
    return _dated(rollups.date_rollup(articles(spark, sf_dir)))


@query(
    "archive_totals",
    """SELECT CAST(count(DISTINCT collection_date) AS BIGINT) AS total_days, CAST(count(*) AS BIGINT) AS total_articles,
  CAST(floor(sum(content_length) / 1000) AS BIGINT) AS length_k,
  CAST(count(DISTINCT coalesce(source, 'Unknown')) AS BIGINT) AS unique_sources FROM articles""",
    [ARTICLES],
)
def archive_totals(spark, sf_dir):
    return rollups.archive_totals(articles(spark, sf_dir))


@query(
    "facets",
    """SELECT facet, value, CASE WHEN facet = 'source' THEN value
    ELSE array_to_string(list_transform(regexp_extract_all(value, '\\p{L}+|[^\\p{L}]+'), lambda w: upper(w[1]) || lower(w[2:])), '') END AS label
FROM (SELECT DISTINCT 'source' AS facet, coalesce(source, 'Unknown') AS value FROM tagged
  UNION ALL SELECT DISTINCT 'keyword', unnest(keywords) FROM tagged)""",
    [ARTICLES, S.TAGGED],
)
def facets(spark, sf_dir):
    return rollups.facets(tagged(spark, sf_dir, "matched_keywords"))


@query(
    "keyword_count",
    f"""SELECT {DAY}, CAST(count(DISTINCT keyword) AS BIGINT) AS keywords FROM (
  SELECT collection_date, unnest(keywords) AS keyword FROM tagged
  UNION ALL SELECT collection_date, NULL FROM tagged) GROUP BY 1""",
    [ARTICLES, S.TAGGED],
)
def keyword_count(spark, sf_dir):
    return _dated(rollups.keyword_count(tagged(spark, sf_dir, "matched_keywords")))


ROLLED = """known AS (SELECT *, coalesce(source, 'Unknown') AS named FROM articles),
days AS (SELECT collection_date AS d, count(*) AS n, count(DISTINCT named) AS s, count(DISTINCT source) AS c, floor(sum(content_length) / 1000) AS k FROM known GROUP BY 1),
words AS (SELECT collection_date AS d, count(DISTINCT keyword) AS w FROM (SELECT collection_date, unnest(keywords) AS keyword FROM tagged) GROUP BY 1)"""


@query(
    "rollup_incremental",
    """SELECT 'day' AS what, CAST(d AS VARCHAR) AS key, CAST(n AS BIGINT) AS a, CAST(s AS BIGINT) AS b, CAST(k AS BIGINT) AS c, CAST(coalesce(w, 0) AS BIGINT) AS d FROM days LEFT JOIN words USING (d)
UNION ALL SELECT 'card', CAST(d AS VARCHAR), n, c, NULL, NULL FROM days
UNION ALL SELECT 'all', '', count(DISTINCT collection_date), count(*), CAST(floor(sum(content_length) / 1000) AS BIGINT), count(DISTINCT named) FROM known
UNION ALL SELECT 'source', named, NULL, NULL, NULL, NULL FROM known GROUP BY named
UNION ALL SELECT 'keyword', keyword, NULL, NULL, NULL, NULL FROM (SELECT DISTINCT unnest(keywords) AS keyword FROM tagged)
UNION ALL SELECT 'keyword on a day', keyword, NULL, NULL, NULL, NULL FROM (SELECT DISTINCT unnest(keywords) AS keyword FROM tagged WHERE collection_date = DATE '2025-11-04')""",
    [ARTICLES, S.TAGGED, ROLLED],
)
def rollup_incremental(spark, sf_dir):
    """All rollups after three batches of articles, the second sent twice, from what each batch has counted."""
    path = scratch_dir(spark, "rollups")
    df = tagged(spark, sf_dir, "matched_keywords")
    for part in (0, 1, 1, 2):
        rollup_store.add_batch(df.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == part), path, f"part-{part}")
    none, text = F.lit(None).cast("long"), F.col("collection_date").cast("string")
    totals = rollup_store.archive_totals(spark, path)
    names = rollup_store.facets(spark, path).select("facet", "value")
    names = names.union(rollup_store.facets(spark, path, ["2025-11-04"]).where("facet = 'keyword'").select(F.lit("keyword on a day"), "value"))
    parts = [
        rollup_store.daily_stats(spark, path).select(F.lit("day").alias("what"), text.alias("key"), "articles", "sources", "length_k", "keywords"),
        rollup_store.card_stats(spark, path).select(F.lit("card"), text, "articles", "sources", none, none),
        totals.select(F.lit("all"), F.lit(""), "total_days", "total_articles", "length_k", "unique_sources"),
        names.select("facet", "value", none, none, none, none),
    ]
    return reduce(DataFrame.union, parts).toDF("what", "key", "a", "b", "c", "d")


@query(
    "ingest_counts",
    """SELECT coalesce(feed_url, 'all') AS feed_url, CAST(count(*) AS BIGINT) AS saved FROM (SELECT DISTINCT url, min(feed_url) AS feed_url FROM articles GROUP BY url)
GROUP BY ROLLUP (feed_url)""",
    [ARTICLES],
)
def ingest_counts(spark, sf_dir):
    saved = articles(spark, sf_dir).groupBy("url").agg(F.min("feed_url").alias("feed_url"))
    return rollups.ingest_counts(saved).withColumn("feed_url", F.coalesce("feed_url", F.lit("all")))


@query(
    "backfill",
    """SELECT CAST(count(*) FILTER (picked AND lang <> 'fr') AS BIGINT) AS updated,
  CAST(count(*) FILTER (picked AND lang = 'fr') AS BIGINT) AS failed, CAST(count(*) FILTER (picked) AS BIGINT) AS total,
  CAST(sum(CASE WHEN picked AND lang <> 'fr' THEN length(title) + 4 ELSE content_length END) AS BIGINT) AS chars
FROM (SELECT *, contains(url, 'src1') AS picked FROM articles WHERE doc_id = u)""",
    [ARTICLES],
)
def backfill(spark, sf_dir):
    """New content for the stored articles of some hosts; fetches in French fail."""
    df = dedup.dedupe_urls(articles(spark, sf_dir), "doc_id").withColumn("article_id", X.article_id(F.col("url")))
    new = F.when(F.col("lang") != "fr", F.concat("title", F.lit(" new")))
    table, _ = store.backfill_content(
        df.select("collection_date", "article_id", "url", "content_length"),
        df.select("collection_date", "article_id", "content"),
        df.select("url", new.alias("new_content")),
        "src1",
    )
    return table.agg(
        F.count_if(F.col("backfill") == "updated").alias("updated"),
        F.count_if(F.col("backfill") == "failed").alias("failed"),
        F.count("backfill").alias("total"),
        F.sum("content_length").cast("long").alias("chars"),
    )
