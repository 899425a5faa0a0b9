"""Queries over pages, feeds, markets and source health."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from presslake.catalog import sql as S
from presslake.catalog.corpus import (
    ARTICLES,
    AS_OF,
    MARKETS,
    PAGES,
    PHRASES,
    SOURCES,
    articles,
    fetch_log,
    load,
    markets,
    pages,
    pick,
    sources,
    spread,
    sql_pick,
    spread_articles,
)
from presslake.catalog.registry import query
from presslake.functions import html as H
from presslake.functions import lexicons as lex
from presslake.functions import predicates as P
from presslake.operators import dedup, health, joins, rollups, streaks
from presslake.operators import markets as M
from presslake.sources import feeds
from presslake.sources.tables import open_markets

# ---------------------------------------------------------------------------
# SQL for the text of a page's article
# ---------------------------------------------------------------------------
BLANK, TAG = H.BLANK, H.TAG


def _sub(expr: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({expr}, {S.quoted(pattern)}, {to}, 'g')"


def sql_kept(html: str, tags: tuple[str, ...]) -> str:
    out = html
    for tag in tags:
        out = _sub(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "'<!>'")
    return _sub(out, r"(?s)<!--.*?-->", "'<!>'")


def sql_decode(expr: str) -> str:
    for entity, char in [*H.ENTITIES, ("&amp;", "&")]:
        expr = f"replace({expr}, {S.quoted(entity)}, {S.quoted(char)})"
    return expr


def sql_closed(expr: str) -> str:
    """Common entities written without their semicolon get it; twice, as matches may touch."""
    for _ in range(2):
        expr = _sub(expr, "&(amp|lt|gt|quot|nbsp)([^A-Za-z0-9;.-]|$)", r"'&\1;\2'")
    return expr


def sql_article(html: str, tags: tuple[str, ...], separator: str = "''") -> str:
    body = f"regexp_extract({sql_kept(html, tags)}, {S.quoted(r'(?is)<article\b[^>]*>(.*?)</article\s*>')}, 1)"
    body = f"replace({sql_closed(body)}, '&nbsp;', chr(160))"
    marked = _sub(body, f"{BLANK}*{TAG}{BLANK}*", "chr(1)")
    ends = _sub(marked, rf"^(?:{BLANK}|\x01)+|(?:{BLANK}|\x01)+$")
    return sql_decode(_sub(ends, r"\x01+", separator))


NEWS_TEXT = sql_article("html", H.NEWS_RULE.drop)
LAW_TEXT = sql_article("html", H.LEGISLATION_RULE.drop, "chr(10)")
RAW_TITLE = sql_closed(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")
TITLE = _sub(sql_decode(_sub(RAW_TITLE, TAG)), f"^{BLANK}+|{BLANK}+$")


def _spread_pages(spark, sf_dir):
    return spread(pages(spark, sf_dir), "page_id")


@query("blocked_pages", f"SELECT page_id, url FROM pages_x WHERE {S.any_part('lower(html)', lex.BLOCKED_PAGE_TERMS)}", [PAGES])
def blocked_pages(spark, sf_dir):
    return _spread_pages(spark, sf_dir).where(P.is_blocked(F.col("html"))).select("page_id", "url")


@query(
    "page_titles",
    f"""SELECT page_id, {TITLE} AS title, CASE page_id % 4 WHEN 0 THEN '2025-11-03' WHEN 1 THEN '3 Nov 2025'
  WHEN 2 THEN '3 November' ELSE 'Unknown' END AS page_date FROM pages_x""",
    [PAGES],
)
def page_titles(spark, sf_dir):
    return _spread_pages(spark, sf_dir).select(
        "page_id", H.page_title(F.col("html")).alias("title"), H.page_date(F.col("html")).alias("page_date")
    )


@query(
    "page_text",
    f"SELECT page_id, CASE WHEN length(body) > 100 THEN body ELSE '' END AS body FROM (SELECT page_id, {NEWS_TEXT} AS body FROM pages_x)",
    [PAGES],
)
def page_text(spark, sf_dir):
    read = H.extract_news(_spread_pages(spark, sf_dir), into="body")
    return read.select("page_id", F.coalesce("body", F.lit("")).alias("body"))


LAW_HTML = rf"replace(regexp_extract({sql_kept('html', ('script', 'style'))}, '(?is)<article\b[^>]*>.*?</article\s*>', 0), '<!>', '')"


@query("page_text_profiles", f"SELECT page_id, {LAW_TEXT} AS law, md5({LAW_HTML}) AS law_html FROM pages")
def page_text_profiles(spark, sf_dir):
    """Text by the legislation rules, and the markup the historical rule keeps."""
    df = spread(load(spark, sf_dir, "pages"), "page_id")
    read = H.extract_historical(H.extract_content(df, into="law"), into="markup")
    return read.select("page_id", F.coalesce("law", F.lit("")).alias("law"), F.md5("markup").alias("law_html"))


# Elements the text may stand in instead of an article: by class, by name, and nested ones that never close.
SHAPES = [
    ('<div class="post entry-content"><div>', "</div></div>"),
    ("<main>", "</main>"),
    ('<section class=\'article-body x\'><span><span>', "</section>"),
]


@query(
    "page_shapes",
    f"""SELECT page_id, CASE WHEN length(body) > 100 THEN body ELSE '' END AS body, law
FROM (SELECT page_id, {NEWS_TEXT} AS body, {LAW_TEXT} AS law FROM pages_x)""",
    [PAGES],
)
def page_shapes(spark, sf_dir):
    """The same texts from pages that hold them in other elements, by the news and the legislation rules."""
    shape = (F.col("page_id") % len(SHAPES) + 1).cast("int")
    start, end = (F.element_at(F.array(*[F.lit(s[i]) for s in SHAPES]), shape) for i in (0, 1))
    html = F.replace(F.replace("html", F.lit("<article>"), start), F.lit("</article>"), end)
    df = _spread_pages(spark, sf_dir).withColumn("html", html)
    read = H.extract_news(H.extract_content(df, into="law"), into="body")
    return read.select("page_id", F.coalesce("body", F.lit("")).alias("body"), F.coalesce("law", F.lit("")).alias("law"))


# Elements the historical rule keeps as they stand: by class, by name, by id with an element that never closes, by a bare class.
KEPT_SHAPES = [
    ('<div class="post entry-content"><div>', "</div></div>"),
    ("<main>", "</main>"),
    ("<section id='content'><span>", "</section>"),
    ("<div class=content>", "</div>"),
]
INNER = rf"replace(regexp_extract({sql_kept('html', ('script', 'style'))}, '(?is)<article\b[^>]*>(.*?)</article\s*>', 1), '<!>', '')"


@query(
    "historical_shapes",
    f"""SELECT page_id, md5({sql_pick([s for s, _ in KEPT_SHAPES], 'page_id % 4')} || {INNER} || {sql_pick([e for _, e in KEPT_SHAPES], 'page_id % 4')}) AS markup
FROM pages_x""",
    [PAGES],
)
def historical_shapes(spark, sf_dir):
    """The markup kept by the historical rule from pages that hold their text in other elements than an article."""
    shape = (F.col("page_id") % len(KEPT_SHAPES) + 1).cast("int")
    start, end = (F.element_at(F.array(*[F.lit(s[i]) for s in KEPT_SHAPES]), shape) for i in (0, 1))
    html = F.replace(F.replace("html", F.lit("<article>"), start), F.lit("</article>"), end)
    df = _spread_pages(spark, sf_dir).withColumn("html", html)
    return H.extract_historical(df, into="markup").select("page_id", F.md5("markup").alias("markup"))


@query(
    "bill_pages",
    r"""SELECT * FROM (SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN '<body><div class=''govinfo-content''>' || html || '</div></body>'
  ELSE regexp_extract(html, '(?is)<body\b.*</body\s*>', 0) END AS body
FROM pages WHERE strlen(html) > 1000) WHERE body <> ''""",
)
def bill_pages(spark, sf_dir):
    """Bills from their XML version, or from the body of the HTML version where the XML is too short."""
    df = load(spark, sf_dir, "pages")
    xml = F.when(F.col("page_id") % 3 == 0, F.lit("<bill/>")).otherwise(F.col("html"))
    return df.select("page_id", H.extract_bill(xml, F.col("html")).alias("body")).where("body IS NOT NULL")


@query(
    "senate_pages",
    """SELECT doc_id, '<body><div class=''senado-content''><h1>Materia ' || doc_id || '</h1><div id=''textoMateria''>' || phrase || chr(10) ||
  'n. ' || doc_id || '</div></div></body>' AS body FROM documents_u WHERE doc_id % 4 <> 0""",
    [ARTICLES],
)
def senate_pages(spark, sf_dir):
    """Title and text of senate pages; pages without the text element give none."""
    doc = F.col("doc_id").cast("string")
    df = load(spark, sf_dir, "documents").withColumn("phrase", pick(PHRASES, F.col("doc_id") % len(PHRASES)))
    name = F.when(F.col("doc_id") % 4 == 0, "other").otherwise("textoMateria")
    html = F.concat(
        F.lit("<html><h1>Senado</h1><div id='materia'><h1> Materia "), doc, F.lit("</h1></div><script>x</script><div id='"), name,
        F.lit("'><p>"), "phrase", F.lit("</p><div><p>n. "), doc, F.lit("</p></div></div></html>"),
    )
    return df.select("doc_id", H.extract_senate(html).alias("body")).where("body IS NOT NULL")


SITE = r"regexp_extract(url, '^[a-zA-Z]+://[^/?#]*', 0)"


@query(
    "discover_links",
    f"""SELECT page_id, unnest([{SITE} || '/news/2025/' || page_id, 'https://other.example.org/story/' || (page_id % 40)]) AS link
FROM pages""",
)
def discover_links(spark, sf_dir):
    links = H.discover_links(F.col("url"), F.col("html"))
    return _spread_pages(spark, sf_dir).select("page_id", F.explode_outer(links).alias("link")).where("link IS NOT NULL")


@query(
    "distinct_links",
    f"""SELECT host, link FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY link) AS rn FROM (
  SELECT DISTINCT 'src' || (page_id % 20) AS host, unnest([{SITE} || '/news/2025/' || page_id, 'https://other.example.org/story/' || (page_id % 40)]) AS link FROM pages))
WHERE rn <= 20""",
)
def distinct_links(spark, sf_dir):
    """Distinct article links per host by the source checker's rules, at most 20 each."""
    links = H.discover_article_links(F.col("url"), F.col("html"))
    host = F.concat(F.lit("src"), (F.col("page_id") % 20).cast("string"))
    found = _spread_pages(spark, sf_dir).select(host.alias("host"), F.explode_outer(links).alias("link"))
    found = found.where("link IS NOT NULL").distinct()
    return dedup.cap_links(found, 20, site="host", url="link")


# ---------------------------------------------------------------------------
# Feeds: one document per article, RSS or Atom by rule
# ---------------------------------------------------------------------------
def _xml(text):
    text = F.regexp_replace(text, r"[\x00-\x1f]", " ")
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def feed_documents(df):
    title, url, date = _xml(F.col("title")), F.col("url"), F.col("pub_date")
    rss = F.concat(
        F.lit("<rss><channel><title>c</title><item><title>"), title, F.lit("</title><link>"), url,
        F.lit("</link><pubDate>"), date, F.lit("</pubDate><description>"), _xml(F.col("description")),
        F.lit("</description></item><item><link>"), url, F.lit("?second</link><summary> s </summary></item></channel></rss>"),
    )
    atom = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title>'), title,
        F.lit('</title><link href="'), url, F.lit('"/><link href="https://example.org/self"/><updated>'), date,
        F.lit("</updated><content>"), _xml(F.col("description")), F.lit("</content></entry></feed>"),
    )
    return df.select("doc_id", "lang", "feed_url", F.when(F.col("lang") == "en", rss).otherwise(atom).alias("xml"))


@query(
    "feed_items",
    r"""SELECT doc_id, CAST(0 AS INTEGER) AS item_pos, regexp_replace(title, '[\x00-\x1f]', ' ', 'g') AS title, url AS link, pub_date,
  regexp_replace(description, '[\x00-\x1f]', ' ', 'g') AS description FROM articles
UNION ALL SELECT doc_id, 1, 'No Title', url || '?second', '', ' s ' FROM articles WHERE lang = 'en'""",
    [ARTICLES],
)
def feed_items(spark, sf_dir):
    documents = feed_documents(spread_articles(spark, sf_dir)).drop("lang", "feed_url")
    return feeds.normalize_items(feeds.explode_feed(documents))


# What happens to a document on its way: nothing, a bare ampersand in each title, a cut tail, an undeclared prefix,
# a cut before the first item ends.
DAMAGES = 5


def damaged_documents(df):
    """Feeds of two items, damaged by rule over all documents."""
    n = (F.col("doc_id") % 100).cast("string")
    amp = F.when(F.col("doc_id") % DAMAGES == 1, F.lit("A & B ")).otherwise(F.lit("A and B "))
    prefix = F.when(F.col("doc_id") % DAMAGES == 3, F.lit("<media:thumb u:r='x'/>")).otherwise(F.lit(""))
    link = F.col("url")
    head = F.concat(F.lit("<rss><channel><title>t</title><item><title>"), amp, n)
    first = F.concat(head, F.lit("</title>"), prefix, F.lit("<link>"), link, F.lit("</link></item>"))
    second = F.concat(F.lit("<item><title>"), amp, F.lit("two</title><link>"), link, F.lit("?two</link>"))
    whole = F.concat(first, second, F.lit("</item></channel></rss>"))
    xml = F.when(F.col("doc_id") % DAMAGES == 2, F.concat(first, second)).when(F.col("doc_id") % DAMAGES == 4, head).otherwise(whole)
    return df.select("doc_id", xml.alias("xml"))


@query(
    "feed_items_damaged",
    f"""SELECT doc_id, pos AS item_pos,
  CASE WHEN doc_id % {DAMAGES} = 1 THEN 'A & B ' ELSE 'A and B ' END || CASE pos WHEN 0 THEN CAST(doc_id % 100 AS VARCHAR) ELSE 'two' END AS title,
  url || CASE pos WHEN 0 THEN '' ELSE '?two' END AS link
FROM articles, (VALUES (CAST(0 AS INTEGER)), (CAST(1 AS INTEGER))) AS places(pos)
WHERE doc_id % {DAMAGES} <> 4 AND NOT (doc_id % {DAMAGES} = 2 AND pos = 1)""",
    [ARTICLES],
)
def feed_items_damaged(spark, sf_dir):
    """The complete items of feeds that are not well-formed."""
    items = feeds.normalize_items(feeds.explode_feed(damaged_documents(articles(spark, sf_dir)), keep_cut=False))
    return items.select("doc_id", "item_pos", "title", "link")


# Where a document ends: in a text, an end tag, a CDATA section (before and within markup), an entity, a start tag, an Atom entry, a title.
CUTS = 8


def cut_documents(df):
    """Feeds of two items that end in the second one (of one entry for Atom), at a place given by the id."""
    part = F.regexp_replace(F.substr("text", F.lit(1), (F.col("doc_id") % 50 + 5).cast("int")), "[^A-Za-z ]", "x")
    first = F.concat(F.lit("<rss><channel><title>c</title><item><title>one</title><link>"), F.col("url"), F.lit("</link></item>"))
    title = F.concat(F.lit("<item><title>two "), (F.col("doc_id") % 100).cast("string"))
    linked = F.concat(title, F.lit("</title><link>"), F.col("url"), F.lit("?two"))
    described = F.concat(linked, F.lit("</link><description>"))
    ends = [
        F.concat(described, part),
        F.concat(linked, F.lit("</li")),
        F.concat(described, F.lit("<![CDATA["), part, F.lit("]")),
        F.concat(described, F.lit("<![CDATA["), part, F.lit(" <b")),
        F.concat(described, part, F.lit("&am")),
        F.concat(linked, F.lit("</link><media:thumbnail u:r='x'/><pubDate")),
        None,
        title,
    ]
    atom = F.concat(
        F.lit("<feed><entry><title>two "), (F.col("doc_id") % 100).cast("string"), F.lit('</title><link href="'), F.col("url"),
        F.lit('?two"/><summary>'), part,
    )
    kind = F.col("doc_id") % CUTS
    xml = F.when(kind == 6, atom)
    for i, end in enumerate(ends):
        if end is not None:
            xml = xml.when(kind == i, F.concat(first, end))
    return df.select("doc_id", xml.alias("xml"))


@query(
    "feed_items_cut",
    f"""WITH cut AS (SELECT a.doc_id, a.doc_id % {CUTS} AS kind, url, 'two ' || (a.doc_id % 100) AS title,
  regexp_replace(substr(text, 1, CAST(a.doc_id % 50 + 5 AS INTEGER)), '[^A-Za-z ]', 'x', 'g') AS part FROM articles_text a)
SELECT doc_id, CAST(0 AS INTEGER) AS item_pos, 'one' AS title, url AS link, '' AS description FROM cut WHERE kind <> 6
UNION ALL SELECT doc_id, CAST(CASE WHEN kind = 6 THEN 0 ELSE 1 END AS INTEGER), title, CASE WHEN kind <> 7 THEN url || '?two' END,
  CASE kind WHEN 0 THEN part WHEN 2 THEN part WHEN 3 THEN part || ' ' WHEN 4 THEN part WHEN 6 THEN part ELSE '' END FROM cut""".replace(
        "WITH cut AS", "SELECT * FROM (WITH cut AS"
    ).replace("ELSE '' END FROM cut", "ELSE '' END FROM cut)"),
    [ARTICLES, "articles_text AS (SELECT a.*, d.text FROM articles a JOIN documents d USING (doc_id))"],
)
def feed_items_cut(spark, sf_dir):
    """Items of feeds that end in the middle of one: it keeps the fields it has."""
    text = load(spark, sf_dir, "documents").select("doc_id", "text")
    df = articles(spark, sf_dir).select("doc_id", "url").join(text, "doc_id")
    items = feeds.normalize_items(feeds.explode_feed(cut_documents(df), keep_cut=True))
    return items.select("doc_id", "item_pos", "title", "link", "description")


@query("feeds_unreadable", f"SELECT doc_id FROM articles WHERE doc_id % {DAMAGES} = 4", [ARTICLES])
def feeds_unreadable(spark, sf_dir):
    """Documents that give no item at all."""
    return feeds.unreadable(damaged_documents(articles(spark, sf_dir)), keep_cut=False).select("doc_id")


# ---------------------------------------------------------------------------
# Markets
# ---------------------------------------------------------------------------
POLITICAL = f"""({S.any_part("lower(coalesce(category, ''))", lex.POLITICAL_CATEGORIES)}
  OR {S.any_word("lower(question || ' ' || coalesce(description, ''))", lex.POLITICAL_TERMS)})"""


@query("political_markets", f"SELECT id, volume_usd FROM top_markets WHERE {POLITICAL}", [MARKETS])
def political_markets(spark, sf_dir):
    """The 500 largest open markets, then those that are political."""
    top = dedup.top_markets(M.market_stats(open_markets(markets(spark, sf_dir))))
    return M.political_markets(top).select("id", "volume_usd")


@query(
    "political_filter",
    f"SELECT id FROM markets WHERE {POLITICAL}",
    [MARKETS],
)
def political_filter(spark, sf_dir):
    return M.political_markets(markets(spark, sf_dir)).select("id")


@query(
    "market_outcomes",
    """SELECT id, pos, outcome, pct, CASE WHEN pct IS NULL THEN 'N/A' ELSE printf('%.1f%%', pct) END AS pct_shown FROM (
  SELECT id, CAST(pos AS INTEGER) AS pos, outcomes[pos + 1] AS outcome, try_cast(prices[pos + 1] AS DOUBLE) * 100 AS pct
  FROM markets, range(0, 2) AS r(pos))""",
    [MARKETS],
)
def market_outcomes(spark, sf_dir):
    return M.market_outcomes(markets(spark, sf_dir))


@query(
    "market_keys",
    """SELECT id, 'https://polymarket.com/event/' || coalesce(slug, id) AS url, coalesce(nullif(start_date, ''), created_at, '') AS pub_date,
  volume_usd, liquidity_usd, CASE WHEN closed THEN 'Closed' ELSE 'Open' END AS status, coalesce(category, 'N/A') AS category_shown
FROM market_numbers""",
    [MARKETS],
)
def market_keys(spark, sf_dir):
    df = M.market_stats(M.market_keys(markets(spark, sf_dir)))
    return df.select("id", "url", "pub_date", "volume_usd", "liquidity_usd", "status", "category_shown")


@query(
    "market_tags",
    f"""SELECT id, CASE WHEN len(c.found) = 0 THEN 'Global' ELSE array_to_string(c.found, '|') END AS continents,
  array_to_string(k.found, '|') AS countries, 'geopolitics' AS topics, 'prediction_market' AS special
FROM geo c JOIN lands k USING (id)""",
    [
        MARKETS,
        "texts AS (SELECT id, lower(question || ' ' || coalesce(description, '')) AS low FROM markets)",
        S.found_list("geo", "texts", "id", "low", list(S.continent_rows())),
        S.found_list("lands", "texts", "id", "low", list(S.country_rows())),
    ],
)
def market_tags(spark, sf_dir):
    df = M.market_tags(markets(spark, sf_dir))
    return df.select(
        "id",
        F.array_join("tags.continents", "|").alias("continents"),
        F.array_join("tags.countries", "|").alias("countries"),
        F.array_join("tags.core_topics", "|").alias("topics"),
        F.array_join("tags.special_tags", "|").alias("special"),
    )


@query(
    "market_yield",
    f"""SELECT CAST(floor((rank - 1) / 100) AS BIGINT) AS page, CAST(count(*) AS BIGINT) AS fetched,
  CAST(count(*) FILTER ({POLITICAL}) AS BIGINT) AS political FROM top_markets GROUP BY 1""",
    [MARKETS],
)
def market_yield(spark, sf_dir):
    top = dedup.top_markets(M.market_stats(open_markets(markets(spark, sf_dir))))
    political = P.is_political(F.col("category"), F.col("question"), F.col("description"))
    return rollups.market_yield(M.ranked(top).withColumn("political", political))


# ---------------------------------------------------------------------------
# Source health
# ---------------------------------------------------------------------------
REGION_TEST = "CASE region " + " ".join(
    f"WHEN '{name}' THEN {S.any_part('low', terms)}" for name, terms in lex.REGION_RELEVANCE_TERMS.items()
) + " ELSE true END"
RELEVANT = S.any_part("low", lex.RELEVANCE_TERMS)

FEED_HEALTH = f"""entries AS (
  SELECT host AS source, lower(title || description) AS low, {S.PARSED} AS parsed,
    row_number() OVER (PARTITION BY host ORDER BY doc_id) AS rn FROM articles),
feed_counts AS (
  SELECT source, count(*) AS article_count,
    count(*) FILTER (rn <= 10 AND coalesce(parsed > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY, false)) AS recent_articles,
    count(*) FILTER (rn <= 20 AND {RELEVANT}) AS relevant_articles,
    count(*) FILTER (rn <= 20 AND {REGION_TEST}) AS geographic_articles
  FROM entries JOIN sources USING (source) GROUP BY source),
feed_stages AS (
  SELECT source, region, http_status, response_time, article_count, recent_articles, relevant_articles, geographic_articles,
    http_status = 200 AS s1, http_status = 200 AND article_count > 0 AS s2 FROM sources JOIN fetch_log USING (source) JOIN feed_counts USING (source)),
feed_gates AS (
  SELECT *, s2 AND recent_articles > 0 AS s3, s2 AND recent_articles > 0 AND article_count >= 5 AS s4,
    s2 AND recent_articles > 0 AND article_count >= 5 AND relevant_articles > 0 AS s5,
    s2 AND recent_articles > 0 AND article_count >= 5 AND relevant_articles > 0 AND geographic_articles > 0 AS s6 FROM feed_stages),
feed_health AS (
  SELECT source, region, CAST(CASE WHEN s3 THEN article_count ELSE 0 END AS BIGINT) AS article_count,
    CAST(CASE WHEN s2 THEN recent_articles ELSE 0 END AS BIGINT) AS recent_articles,
    CAST(CASE WHEN s4 THEN relevant_articles ELSE 0 END AS BIGINT) AS relevant_articles,
    CAST(CASE WHEN s5 THEN geographic_articles ELSE 0 END AS BIGINT) AS geographic_articles, response_time,
    CAST(2 * CAST(s2 AS INTEGER) + CAST(s3 AS INTEGER) + CAST(s4 AS INTEGER) + CAST(s5 AS INTEGER) + CAST(s6 AS INTEGER) AS INTEGER) AS tests_passed,
    CASE WHEN s6 THEN 'PASSED' ELSE 'FAILED' END AS status,
    CASE WHEN NOT s1 THEN 'HTTP ' || http_status WHEN NOT s2 THEN 'No entries found in feed' WHEN NOT s3 THEN 'No recent articles found'
      WHEN NOT s4 THEN 'Too few articles: ' || article_count WHEN NOT s5 THEN 'No relevant articles found'
      WHEN NOT s6 THEN 'No ' || region || ' relevant articles found' ELSE '' END AS error FROM feed_gates),
feed_tiers AS (
  SELECT *, CASE WHEN status <> 'PASSED' THEN '' WHEN tests_passed = 6 AND response_time < 3 THEN 'deploy_immediately'
    WHEN tests_passed >= 5 AND response_time < 5 THEN 'deploy_with_monitoring' ELSE 'do_not_deploy' END AS tier FROM feed_health)"""


def _feed_health(spark, sf_dir):
    items = articles(spark, sf_dir).select(
        F.col("host").alias("source"), "doc_id", "title", F.lit(None).cast("string").alias("summary"), "description", "pub_date"
    )
    return health.feed_health(
        items, fetch_log(spark, sf_dir), sources(spark, sf_dir), datetime.fromisoformat(AS_OF), order="doc_id"
    )


def _with_tier(graded, kind):
    return health.with_tier(graded, kind).withColumn("tier", F.coalesce("tier", F.lit("")))


FEED_COLUMNS = [
    "source", "region", "article_count", "recent_articles", "relevant_articles", "geographic_articles",
    "tests_passed", "status", "error", "tier",
]


@query("feed_health", f"SELECT {', '.join(FEED_COLUMNS)} FROM feed_tiers", [ARTICLES, SOURCES, FEED_HEALTH])
def feed_health(spark, sf_dir):
    return _with_tier(_feed_health(spark, sf_dir), "rss").select(*FEED_COLUMNS)


RAW_ARTICLE = sql_closed(
    "regexp_extract(" + sql_kept("html", ("script", "style")) + r", '(?is)<article\b[^>]*>(.*?)</article\s*>', 1)"
)
SITE_TEXT = f"lower({TITLE} || ' ' || {sql_decode(_sub(RAW_ARTICLE, TAG))})"

SITE_HEALTH = f"""site_pages AS (
  SELECT 'src' || (page_id % 20) AS source, url AS link, {S.any_part('lower(html)', lex.BLOCKED_PAGE_TERMS)} AS blocked,
    length({sql_article('html', ('script', 'style'))}) > 200 AS long_enough, {SITE_TEXT} AS low FROM pages_x),
site_ranked AS (
  SELECT p.*, region, row_number() OVER (PARTITION BY source ORDER BY link) AS rn FROM site_pages p JOIN sources USING (source)),
site_counts AS (
  SELECT source, count(*) FILTER (rn <= 20) AS found, count(*) FILTER (rn <= 10 AND long_enough AND NOT blocked) AS extracted,
    count(*) FILTER (rn <= 15 AND {RELEVANT}) AS relevant, count(*) FILTER (rn <= 15 AND {REGION_TEST}) AS regional
  FROM site_ranked GROUP BY source),
site_stages AS (
  SELECT source, region, http_status, response_time, http_status = 200 AS s1,
    source = 'src7' AS blocked, coalesce(found, 0) AS found, coalesce(extracted, 0) AS extracted,
    coalesce(relevant, 0) AS relevant, coalesce(regional, 0) AS regional
  FROM sources JOIN fetch_log USING (source) LEFT JOIN site_counts USING (source)),
site_gates AS (
  SELECT *, s1 AND NOT blocked AS s2, s1 AND NOT blocked AND found >= 5 AS s4, s1 AND NOT blocked AND found >= 5 AND extracted >= 3 AS s5,
    s1 AND NOT blocked AND found >= 5 AND extracted >= 3 AND relevant > 0 AS s6,
    s1 AND NOT blocked AND found >= 5 AND extracted >= 3 AND relevant > 0 AND regional > 0 AS s7 FROM site_stages),
site_health AS (
  SELECT source, region, response_time, CAST(CASE WHEN s2 THEN found ELSE 0 END AS BIGINT) AS article_links_found,
    CAST(CASE WHEN s4 THEN extracted ELSE 0 END AS BIGINT) AS content_extraction_success,
    CAST(CASE WHEN s5 THEN relevant ELSE 0 END AS BIGINT) AS relevant_articles,
    CAST(CASE WHEN s6 THEN regional ELSE 0 END AS BIGINT) AS geographic_articles,
    CAST(3 * CAST(s2 AS INTEGER) + CAST(s4 AS INTEGER) + CAST(s5 AS INTEGER) + CAST(s6 AS INTEGER) + CAST(s7 AS INTEGER) AS INTEGER) AS tests_passed,
    CASE WHEN s7 THEN 'PASSED' ELSE 'FAILED' END AS status,
    CASE WHEN NOT s1 THEN 'HTTP ' || http_status WHEN NOT s2 THEN 'Anti-bot measures detected'
      WHEN NOT s4 THEN 'Too few article links found: ' || found
      WHEN NOT s5 THEN 'Content extraction failed for most articles: ' || extracted || '/10'
      WHEN NOT s6 THEN 'No relevant articles found' WHEN NOT s7 THEN 'No ' || region || ' relevant articles found' ELSE '' END AS error
  FROM site_gates),
site_tiers AS (
  SELECT *, CASE WHEN status <> 'PASSED' THEN '' WHEN tests_passed = 7 AND response_time < 5 AND content_extraction_success >= 7 THEN 'deploy_immediately'
    WHEN tests_passed >= 6 AND response_time < 8 AND content_extraction_success >= 5 THEN 'deploy_with_monitoring' ELSE 'do_not_deploy' END AS tier
  FROM site_health)"""


def _site_health(spark, sf_dir):
    linked = pages(spark, sf_dir).select(
        F.concat(F.lit("src"), (F.col("page_id") % 20).cast("string")).alias("source"), F.col("url").alias("link"), "html"
    )
    # Only the links a site is graded by are read, and only they meet their pages.
    chosen = dedup.cap_links(linked.select("source", "link"), health.LINK_HEAD, site="source", url="link")
    head = joins.attach_content(chosen, linked.select("link", "html"), "link")
    read = H.extract_site_text(H.extract_text(head, H.SITE_CHECK_RULE, into="main_text"), into="text")
    links = read.select(
        "source", "link", F.lit(True).alias("ok"),
        (F.col("main_text").isNotNull() & ~P.is_blocked(F.col("html"))).alias("extracted"),
        "text",
    )
    sites = joins.with_region(fetch_log(spark, sf_dir), sources(spark, sf_dir)).withColumns(
        {"blocked": F.col("source") == "src7", "parsed": F.lit(True)}
    )
    return health.site_health(sites, links)


SITE_COLUMNS = [
    "source", "region", "article_links_found", "content_extraction_success", "relevant_articles",
    "geographic_articles", "tests_passed", "status", "error", "tier",
]


@query("site_health", f"SELECT {', '.join(SITE_COLUMNS)} FROM site_tiers", [PAGES, SOURCES, SITE_HEALTH])
def site_health(spark, sf_dir):
    return _with_tier(_site_health(spark, sf_dir), "site").select(*SITE_COLUMNS)


@query(
    "health_summary",
    """SELECT coalesce(kind, 'all') AS kind, CAST(count(*) AS BIGINT) AS total_tested,
  CAST(count(*) FILTER (status = 'PASSED') AS BIGINT) AS passed, CAST(count(*) FILTER (status <> 'PASSED') AS BIGINT) AS failed,
  round(count(*) FILTER (status = 'PASSED') * 100.0 / count(*), 6) AS success_rate,
  CAST(count(*) FILTER (tier IN ('deploy_immediately', 'deploy_with_monitoring')) AS BIGINT) AS ready_sources
FROM (SELECT 'rss' AS kind, status, tier FROM feed_tiers UNION ALL SELECT 'site', status, tier FROM site_tiers) GROUP BY ROLLUP (kind)""",
    [ARTICLES, PAGES, SOURCES, FEED_HEALTH, SITE_HEALTH],
)
def health_summary(spark, sf_dir):
    return health.master_report(_feed_health(spark, sf_dir), _site_health(spark, sf_dir))


@query("ready_sources", "SELECT source, tier FROM feed_tiers WHERE tier IN ('deploy_immediately', 'deploy_with_monitoring')", [ARTICLES, SOURCES, FEED_HEALTH])
def ready_sources(spark, sf_dir):
    tiered = health.deploy_tier(_feed_health(spark, sf_dir), "rss")
    return health.ready_sources(tiered).select("source", "tier")


@query(
    "source_region",
    "SELECT region, CAST(count(*) AS BIGINT) AS articles, CAST(count(DISTINCT url) AS BIGINT) AS urls FROM articles JOIN sources ON host = sources.source GROUP BY 1",
    [ARTICLES, SOURCES],
)
def source_region(spark, sf_dir):
    df = articles(spark, sf_dir).select(F.col("host").alias("source"), "url")
    placed = joins.with_region(df, sources(spark, sf_dir))
    return placed.groupBy("region").agg(F.count("*").alias("articles"), F.count_distinct("url").alias("urls"))


# ---------------------------------------------------------------------------
# Streaks of the fetch log
# ---------------------------------------------------------------------------
FETCHES = """fetches AS (
  SELECT 'src' || (user_id % 20) AS source, ts, event_id AS fetch_id, event_type <> 'error' AND value < 40 AS ok FROM events),
marked AS (
  SELECT *, lag(ok) OVER one AS last_ok, lag(ts) OVER one AS last_ts FROM fetches
  WINDOW one AS (PARTITION BY source ORDER BY ts, fetch_id)),
islands AS (
  SELECT *, sum(CASE WHEN last_ok = ok THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY ts, fetch_id ROWS UNBOUNDED PRECEDING) AS island FROM marked),
streaks AS (
  SELECT source, ok, min(ts) AS started, max(ts) AS ended, CAST(count(*) AS BIGINT) AS fetches, CASE WHEN island > 1 THEN min(last_ts) END AS before
  FROM islands GROUP BY source, island, ok)"""
RATED_AT = "2024-01-31 12:00:00"


def fetches(spark, sf_dir):
    """Every event as a fetch of its user's source: errors and slow answers count as failed."""
    return load(spark, sf_dir, "events").select(
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("source"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("fetch_id"),
        ((F.col("event_type") != "error") & (F.col("value") < 40)).alias("ok"),
    )


def _shown(*names):
    return ", ".join(f"strftime({n}, '%Y-%m-%d %H:%M:%S') AS {n}" for n in names)


def _time(name):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


@query(
    "feed_streaks",
    f"SELECT source, ok, fetches, {_shown('started', 'ended', 'before')} FROM streaks",
    [FETCHES],
)
def feed_streaks(spark, sf_dir):
    """All runs of equal outcomes of every source, over slices of time put together."""
    found = streaks.feed_streaks(fetches(spark, sf_dir))
    return found.select("source", "ok", "fetches", _time("started"), _time("ended"), _time("before"))


@query(
    "broken_feeds",
    f"""SELECT *, reason IS NOT NULL AS broken FROM (SELECT *, CASE WHEN current_failure >= 5 THEN 'streak'
    WHEN hours_since_success IS NULL OR hours_since_success >= 72 THEN 'silent' WHEN success_rate < 0.5 THEN 'rate' END AS reason
FROM (SELECT source, CAST(sum(fetches) AS BIGINT) AS fetches, CAST(sum(CASE WHEN ok THEN 0 ELSE fetches END) AS BIGINT) AS failures,
  round(1 - sum(CASE WHEN ok THEN 0 ELSE fetches END) / sum(fetches), 6) AS success_rate,
  CAST(max(CASE WHEN ok THEN 0 ELSE fetches END) AS BIGINT) AS longest_failure,
  CAST(arg_max(CASE WHEN ok THEN 0 ELSE fetches END, (ended, started)) AS BIGINT) AS current_failure,
  strftime(max(CASE WHEN ok THEN ended END), '%Y-%m-%d %H:%M:%S') AS last_success,
  CAST(floor((epoch(TIMESTAMP '{RATED_AT}') - floor(epoch(max(CASE WHEN ok THEN ended END)))) / 3600) AS BIGINT) AS hours_since_success
FROM streaks GROUP BY source))""",
    [FETCHES],
)
def broken_feeds(spark, sf_dir):
    """Success rates of all sources and which are broken, and why."""
    rates = streaks.feed_rates(streaks.feed_streaks(fetches(spark, sf_dir)), datetime.fromisoformat(RATED_AT))
    return rates.withColumn("last_success", F.date_format("last_success", "yyyy-MM-dd HH:mm:ss"))
