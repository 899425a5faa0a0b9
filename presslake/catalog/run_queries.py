"""Whole collection runs over feeds, pages and markets derived from the tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from presslake.catalog import sql as S
from presslake.catalog.corpus import ARTICLES, AS_OF, MARKETS, PAGES, PHRASES, articles, markets, pages, pick, spread, spread_articles, sql_pick
from presslake.catalog.page_queries import NEWS_TEXT, POLITICAL, SITE, TITLE, _xml, feed_documents
from presslake.catalog.registry import query
from presslake.functions import lexicons as lex
from presslake.functions.html import BLANK
from presslake.operators import dedup
from presslake.plans import legislation, news, records
from presslake.plans import markets as market_plan
from presslake.session import scratch_dir
from presslake.sources import store
from presslake.sources.tables import read_markets
from presslake.streaming import ingest

NOW = datetime.fromisoformat(AS_OF)
CONTROL = r"[\x00-\x1f]"


def _clean(expr: str) -> str:
    return f"regexp_replace({expr}, '{CONTROL}', ' ', 'g')"


def _documents(df):
    """One feed document per article, under a feed address of its own."""
    own = F.concat("feed_url", F.lit("?doc="), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    return feed_documents(df.withColumn("feed_url", own))


def _pages(df):
    """The page of each URL: that of its first article."""
    body = F.concat(F.lit("<html><body><article>"), _xml(F.col("content")), F.lit("</article></body></html>"))
    return df.where("doc_id = u").select("url", body.alias("html"))


RUN_ITEMS = f"""items AS (
  SELECT url, {_clean('title')} AS title, {_clean('description')} AS description, pub_date, lang,
    feed_url || '?doc=' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS feed_url FROM articles),
bodies AS (
  SELECT url, regexp_replace({_clean('content')}, '^{BLANK}+|{BLANK}+$', '', 'g') AS content FROM articles WHERE doc_id = u)"""


def _first(where: str) -> str:
    return f"""firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY feed_url) AS rn FROM items WHERE {where}) WHERE rn = 1)"""


GATED = S.any_word("lower(title || ' ' || description)", lex.NEWS_KEYWORDS)


@query(
    "rss_run",
    f"""SELECT url, title, feed_url, CAST(length(content) AS INTEGER) AS content_length,
  CASE WHEN len(g.found) = 0 THEN 'Global' ELSE array_to_string(g.found, '|') END AS continents,
  array_to_string(k.found, '|') AS keywords, coalesce(array_to_string(t.found, '|'), '') AS topics,
  CASE WHEN {S.any_part('feed_url', lex.LEGISLATIVE_DOMAINS)} THEN 'legislation' ELSE '' END AS special
FROM kept JOIN geo g USING (url) JOIN words k USING (url) LEFT JOIN topics t USING (url)""",
    [
        ARTICLES,
        RUN_ITEMS,
        _first(GATED),
        """kept AS (SELECT f.*, content FROM firsts f JOIN bodies USING (url)
  WHERE length(content) > 100 AND url NOT IN (SELECT url FROM articles WHERE lang = 'fr'))""",
        "texts AS (SELECT url, lower(title || ' ' || description || ' ' || content) AS low FROM kept)",
        S.found_list("geo", "texts", "url", "low", list(S.continent_rows())),
        S.keyword_list("words", "texts", "url", "low"),
        S.topic_list("topics", "words", "url"),
    ],
)
def rss_run(spark, sf_dir):
    """News run over feeds; URLs of French articles count as seen."""
    df = spread_articles(spark, sf_dir)
    seen = df.where("lang = 'fr'").select("url")
    out = news.rss_articles(_documents(df), _pages(df), NOW, seen=seen)
    return out.select(
        "url", "title", "feed_url", "content_length",
        F.array_join("tags.continents", "|").alias("continents"),
        F.array_join("tags.matched_keywords", "|").alias("keywords"),
        F.array_join("tags.core_topics", "|").alias("topics"),
        F.array_join("tags.special_tags", "|").alias("special"),
    )


RECENT = rf"""CASE WHEN pub_date = '' THEN true WHEN parsed IS NOT NULL THEN parsed >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY
  WHEN regexp_extract(pub_date, '(\d{{4}})', 1) <> '' THEN CAST(regexp_extract(pub_date, '(\d{{4}})', 1) AS INTEGER) >= 2025 ELSE true END"""
LAW_ITEMS = f"""law_items AS (
  SELECT url, title, description, pub_date, feed_url, {S.PARSED} AS parsed FROM items
  UNION ALL SELECT url || '?second', 'No Title', ' s ', '', feed_url, NULL FROM items WHERE lang = 'en'),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY feed_url) AS rn FROM law_items WHERE {RECENT}) WHERE rn = 1)"""


@query(
    "legislation_run",
    """SELECT url, title, feed_url, CAST(length(content) AS INTEGER) AS content_length,
  CASE WHEN len(g.found) = 0 THEN 'Global' ELSE array_to_string(g.found, '|') END AS continents, 'legislation' AS special
FROM kept JOIN geo g USING (url)""",
    [
        ARTICLES,
        RUN_ITEMS,
        LAW_ITEMS,
        "kept AS (SELECT f.*, content FROM firsts f JOIN bodies USING (url) WHERE content <> '')",
        "texts AS (SELECT url, lower(title || ' ' || description || ' ' || content) AS low FROM kept)",
        S.found_list("geo", "texts", "url", "low", list(S.continent_rows())),
    ],
)
def legislation_run(spark, sf_dir):
    """Legislation run over the same feeds: items of the last day and undated ones."""
    df = spread_articles(spark, sf_dir)
    out = legislation.legislation_articles(_documents(df), _pages(df), NOW)
    return out.select(
        "url", "title", "feed_url", "content_length",
        F.array_join("tags.continents", "|").alias("continents"),
        F.array_join("tags.special_tags", "|").alias("special"),
    )


def _linked_pages(df):
    """The pages behind the section pages' own links, about one phrase each."""
    phrase = pick(PHRASES, F.col("page_id") % len(PHRASES))
    host = F.regexp_extract("url", "^[a-zA-Z]+://[^/?#]*", 0)
    titled = F.replace("html", F.lit("<title>"), F.concat(F.lit("<title>"), phrase, F.lit(": ")))
    body = F.replace(titled, F.lit("</article>"), F.concat(phrase, F.lit("</article>")))
    return df.select(F.concat(host, F.lit("/news/2025/"), F.col("page_id").cast("string")).alias("url"), body.alias("html"))


@query(
    "direct_run",
    f"""SELECT url, title, base_url, CASE page_id % 4 WHEN 0 THEN '2025-11-03' WHEN 1 THEN '3 Nov 2025' WHEN 2 THEN '3 November' ELSE 'Unknown' END AS date,
  CAST(length(content) AS INTEGER) AS content_length,
  CASE WHEN len(g.found) = 0 THEN 'Global' ELSE array_to_string(g.found, '|') END AS continents, array_to_string(k.found, '|') AS keywords
FROM kept JOIN geo g USING (url) JOIN words k USING (url)""",
    [
        PAGES,
        f"""linked AS (SELECT page_id, url AS base_url, {SITE} || '/news/2025/' || page_id AS url,
  replace(replace(html, '<title>', '<title>' || phrase || ': '), '</article>', phrase || '</article>') AS html
  FROM (SELECT *, {sql_pick(PHRASES, f'page_id % {len(PHRASES)}')} AS phrase FROM pages_x))""",
        f"scraped AS (SELECT page_id, base_url, url, {TITLE} AS title, {NEWS_TEXT} AS content FROM linked)",
        f"""kept AS (SELECT *, lower(title || ' ' || content) AS low FROM scraped WHERE length(content) > 100
  AND {S.any_word('lower(title)', lex.NEWS_KEYWORDS)} AND {S.any_word('lower(content)', lex.NEWS_KEYWORDS)})""",
        S.found_list("geo", "kept", "url", "low", list(S.continent_rows())),
        S.keyword_list("words", "kept", "url", "low"),
    ],
)
def direct_run(spark, sf_dir):
    """Direct run: links of section pages, their pages, both keyword gates."""
    df = spread(pages(spark, sf_dir), "page_id")
    sections = df.select(F.col("url").alias("base_url"), "html")
    out = news.direct_articles(sections, _linked_pages(df), NOW)
    return out.select(
        "url", "title", "base_url", "date", "content_length",
        F.array_join("tags.continents", "|").alias("continents"),
        F.array_join("tags.matched_keywords", "|").alias("keywords"),
    )


@query(
    "market_run",
    f"""SELECT url, question AS title, pub_date, description, CASE WHEN len(g.found) = 0 THEN 'Global' ELSE array_to_string(g.found, '|') END AS continents,
  array_to_string(l.found, '|') AS countries, volume
FROM (SELECT id, question, try_cast(nullif(volume, '') AS DOUBLE) AS volume, coalesce(description, '') AS description, 'https://polymarket.com/event/' || coalesce(slug, id) AS url,
    coalesce(nullif(start_date, ''), created_at, '') AS pub_date FROM top_markets WHERE {POLITICAL})
JOIN geo g USING (id) JOIN lands l USING (id)""",
    [
        MARKETS,
        "texts AS (SELECT id, lower(question || ' ' || coalesce(description, '')) AS low FROM top_markets)",
        S.found_list("geo", "texts", "id", "low", list(S.continent_rows())),
        S.found_list("lands", "texts", "id", "low", list(S.country_rows())),
    ],
)
def market_run(spark, sf_dir):
    out = market_plan.market_articles(markets(spark, sf_dir), NOW)
    return out.select(
        "url", "title", "pub_date", "description",
        F.array_join("tags.continents", "|").alias("continents"),
        F.array_join("tags.countries", "|").alias("countries"),
        F.col("tags.market_data.volume").alias("volume"),
    )


@query(
    "store_run",
    """SELECT CAST(collection_date AS VARCHAR) AS collection_date, CAST(count(*) AS BIGINT) AS articles,
  CAST(sum(content_length) AS BIGINT) AS chars FROM articles WHERE doc_id = u GROUP BY 1""",
    [ARTICLES],
)
def store_run(spark, sf_dir):
    """Stores the articles twice; the second time adds nothing."""
    base = scratch_dir(spark, "store")
    df = articles(spark, sf_dir).withColumn("tags", records.tag_struct(F.array(F.lit("Global"))))
    batch = df.select("doc_id", "url", "title", "pub_date", "description", "feed_url", "tags", "content", "collection_date")
    batch = records.to_articles(batch, "rss", NOW, keep_date=True, extra=["doc_id"])
    dates = [f"2025-11-{day:02d}" for day in range(1, 15)]
    for _ in range(2):
        new = store.new_only(store.first_per_id(batch, "doc_id"), base)
        store.save_articles(new, base, dates)
    stored = store.articles(spark, base).join(store.contents(spark, base), store.KEY)
    return stored.groupBy(F.col("collection_date").cast("string").alias("collection_date")).agg(
        F.count("*").alias("articles"), F.sum(F.char_length("content")).cast("long").alias("chars")
    )


# ---------------------------------------------------------------------------
# The store read and repaired
# ---------------------------------------------------------------------------
DATES = [f"2025-11-{day:02d}" for day in range(1, 15)]
ONE_DATE = "2025-11-04"


def _batch(spark, sf_dir, end: str = ""):
    """Articles, of each URL its first document, with `end` behind their content."""
    df = articles(spark, sf_dir).withColumn("tags", records.tag_struct(F.array(F.lit("Global"))))
    df = df.withColumn("content", F.concat("content", F.lit(end)))
    batch = df.select("doc_id", "url", "title", "pub_date", "description", "feed_url", "tags", "content", "collection_date")
    batch = records.to_articles(batch, "rss", NOW, keep_date=True, extra=["doc_id"])
    return store.first_per_id(batch, "doc_id").drop("doc_id")


def _stored(spark, sf_dir, name: str) -> str:
    base = scratch_dir(spark, name)
    store.save_articles(_batch(spark, sf_dir), base, DATES)
    return base


def _by_date(spark, base: str):
    # Lengths, not texts, go through the join.
    lengths = store.contents(spark, base).select(*store.KEY, F.char_length("content").alias("chars"))
    pairs = store.articles(spark, base).join(lengths, store.KEY)
    return pairs.groupBy(F.col("collection_date").cast("string").alias("collection_date")).agg(
        F.count("*").alias("articles"),
        F.sum("chars").cast("long").alias("chars"),
        F.sum("content_length").cast("long").alias("stored_chars"),
    )


@query(
    "articles_for_date",
    f"""SELECT url, CAST(content_length AS BIGINT) AS chars FROM articles
WHERE doc_id = u AND collection_date = DATE '{ONE_DATE}'""",
    [ARTICLES],
)
def articles_for_date(spark, sf_dir):
    """One date of the store."""
    day = store.articles_for_date(store.articles(spark, _stored(spark, sf_dir, "store-date")), ONE_DATE)
    return day.select("url", F.col("content_length").cast("long").alias("chars"))


@query("seen_urls", f"SELECT DISTINCT url FROM articles WHERE collection_date = DATE '{ONE_DATE}'", [ARTICLES])
def seen_urls(spark, sf_dir):
    """URLs collected on one date."""
    return store.seen_urls(store.articles(spark, _stored(spark, sf_dir, "store-seen")), ONE_DATE)


@query(
    "dates_newest_first",
    """SELECT CAST(collection_date AS VARCHAR) AS collection_date, CAST(row_number() OVER (ORDER BY collection_date DESC) AS BIGINT) AS place
FROM (SELECT DISTINCT collection_date FROM articles)""",
    [ARTICLES],
)
def dates_newest_first(spark, sf_dir):
    """The dates in the order they come out in; as many as there are dates."""
    days = dedup.dates_desc(articles(spark, sf_dir).select("collection_date").distinct())
    numbered = days.withColumn("n", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("n")).cast("long")
    return numbered.select(F.col("collection_date").cast("string").alias("collection_date"), place.alias("place"))


STORED_SQL = """SELECT CAST(collection_date AS VARCHAR) AS collection_date, CAST(count(*) AS BIGINT) AS articles,
  CAST(sum(content_length + {more}) AS BIGINT) AS chars, CAST(sum(content_length + {more}) AS BIGINT) AS stored_chars
FROM articles WHERE doc_id = u GROUP BY 1"""


@query("store_fresh", STORED_SQL.format(more=6), [ARTICLES])
def store_fresh(spark, sf_dir):
    """A fresh run replaces what is stored."""
    base = _stored(spark, sf_dir, "store-fresh")
    store.save_articles(_batch(spark, sf_dir, " again"), base, DATES, fresh=True)
    return _by_date(spark, base)


@query("store_repair", STORED_SQL.format(more=0), [ARTICLES])
def store_repair(spark, sf_dir):
    """A run that was cut after the contents of every other article is completed by running it again."""
    base = scratch_dir(spark, "store-repair")
    batch = _batch(spark, sf_dir)
    half = batch.where(F.pmod(F.xxhash64("url"), F.lit(2)) == 0).select("article_id", "content", "collection_date")
    half.write.partitionBy("collection_date").parquet(f"{base}/content")
    store.save_articles(store.new_only(batch, base), base, DATES)
    return _by_date(spark, base)


@query(
    "stream_sink",
    """SELECT CAST(collection_date AS VARCHAR) AS collection_date, CAST(count(DISTINCT url) AS BIGINT) AS articles
FROM articles GROUP BY 1""",
    [ARTICLES],
)
def stream_sink(spark, sf_dir):
    """Articles of several batches into the store; the same files again, as a new run, add nothing."""
    work = scratch_dir(spark, "stream-sink")
    df = articles(spark, sf_dir).withColumn("tags", records.tag_struct(F.array(F.lit("Global"))))
    batch = df.select("doc_id", "url", "title", "pub_date", "description", "feed_url", "tags", "content", "collection_date")
    batch = records.to_articles(batch, "rss", NOW, keep_date=True, extra=["doc_id"])
    batch.repartition(3, "doc_id").write.parquet(f"{work}/in")
    for run in ("first", "again"):
        stream = ingest.ingest_stream(spark, f"{work}/in", batch.schema, max_files=1)
        ingest.run_to_end(ingest.sink_batches(stream, f"{work}/store", "doc_id"), f"{work}/{run}")
    pairs = store.articles(spark, f"{work}/store").join(store.contents(spark, f"{work}/store"), store.KEY)
    return pairs.groupBy(F.col("collection_date").cast("string").alias("collection_date")).agg(F.count("*").alias("articles"))


@query(
    "market_files",
    """SELECT id, question, volume, CAST(len(outcomes) AS INTEGER) AS outcomes, prices[1] AS first_price
FROM markets WHERE NOT closed""",
    [MARKETS],
)
def market_files(spark, sf_dir):
    """Open markets read from the JSON pages of an interface, a thousand to a page."""
    work = scratch_dir(spark, "market-files")
    table = markets(spark, sf_dir).withColumns({c: F.to_json(c) for c in ("outcomes", "outcomePrices")})
    page = (F.col("id").cast("long") / 1000).cast("long")
    pages_of = table.groupBy(page.alias("page")).agg(F.to_json(F.collect_list(F.struct(*table.columns))).alias("value"))
    pages_of.write.partitionBy("page").text(f"{work}/pages")
    read = read_markets(spark, f"{work}/pages")
    return read.select(
        "id", "question", "volume", F.size("outcomes").alias("outcomes"), F.get("outcomePrices", 0).alias("first_price")
    )
