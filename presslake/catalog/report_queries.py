"""Whole runs over the store: historical legislation, the index build, both backfills, page kinds, the master report."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.catalog import sql as S
from presslake.catalog.article_queries import SHOWN_DATE
from presslake.catalog.corpus import ARTICLES, AS_OF, PAGES, PHRASES, SOURCES, articles, fetch_log, pages, pick, sources, spread_articles, sql_pick
from presslake.catalog.page_queries import (
    FEED_HEALTH,
    REGION_TEST,
    RELEVANT,
    SITE_HEALTH,
    SITE_TEXT,
    _feed_health,
    _site_health,
    sql_article,
)
from presslake.catalog.registry import query
from presslake.catalog.run_queries import ONE_DATE, RUN_ITEMS, _clean, _documents, _first, _linked_pages, _pages
from presslake.catalog.tag_queries import CASES, LOW_TEXTS, REGION_LIST, detection_cases, tagged
from presslake.functions import html as H
from presslake.functions import lexicons as lex
from presslake.functions import site_rules as R
from presslake.functions import text as X
from presslake.operators import health, rollups
from presslake.plans import legislation, records, reports, sites
from presslake.session import scratch_dir
from presslake.sources import store

NOW = datetime.fromisoformat(AS_OF)

# ---------------------------------------------------------------------------
# Historical legislation
# ---------------------------------------------------------------------------
MARKUP = f"replace(replace(replace({_clean('content')}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(
    "historical_run",
    """SELECT url, title, feed_url, 'historical' AS origin, CAST(length(markup) AS INTEGER) AS content_length, md5(markup) AS digest,
  CASE WHEN len(g.found) = 0 THEN 'Global' ELSE array_to_string(g.found, '|') END AS continents
FROM kept JOIN geo g USING (url)""",
    [
        ARTICLES,
        RUN_ITEMS,
        f"markups AS (SELECT url, '<article>' || {MARKUP} || '</article>' AS markup FROM articles WHERE doc_id = u)",
        _first("true"),
        "kept AS (SELECT f.*, markup FROM firsts f JOIN markups USING (url) WHERE url NOT IN (SELECT url FROM articles WHERE lang = 'fr'))",
        "texts AS (SELECT url, lower(title || ' ' || description || ' ' || markup) AS low FROM kept)",
        S.found_list("geo", "texts", "url", "low", list(S.continent_rows())),
    ],
)
def historical_run(spark, sf_dir):
    """Legislation of any date with the markup of its pages; URLs of French articles count as seen."""
    df = spread_articles(spark, sf_dir)
    seen = df.where("lang = 'fr'").select("url")
    out = legislation.historical_articles(_documents(df), _pages(df), NOW, seen)
    return out.select(
        "url", "title", "feed_url", "origin", "content_length", F.md5("content").alias("digest"),
        F.array_join("tags.continents", "|").alias("continents"),
    )


# ---------------------------------------------------------------------------
# The index of one date, built from the store
# ---------------------------------------------------------------------------
INDEX_DAY = f"SELECT * FROM tagged WHERE doc_id = u AND collection_date = DATE '{ONE_DATE}'"


@query(
    "index_build",
    f"""SELECT 'article' AS part, url AS key, title || '|' || {SHOWN_DATE} || '|' || array_to_string(continents, ' ') || '|' || array_to_string(keywords, ' ') AS text,
  CAST(content_length AS BIGINT) AS n FROM ({INDEX_DAY})
UNION ALL SELECT 'order', CAST(row_number() OVER (ORDER BY wall DESC NULLS LAST, md5(url)) AS VARCHAR), url, 0 FROM (SELECT url, {S.WALL} AS wall FROM ({INDEX_DAY}))
UNION ALL SELECT 'header', '{ONE_DATE}', '', CAST(count(*) AS BIGINT) FROM ({INDEX_DAY})
UNION ALL SELECT 'facet', 'source', 'RSS Feed', 0
UNION ALL SELECT 'facet', 'keyword', keyword, 0 FROM (SELECT DISTINCT unnest(keywords) AS keyword FROM ({INDEX_DAY}))
UNION ALL SELECT 'card', CAST(collection_date AS VARCHAR), '', CAST(count(*) AS BIGINT) FROM tagged
  WHERE doc_id = u AND (collection_date = DATE '{ONE_DATE}' OR collection_date < DATE '2025-11-09' AND lang = 'en') GROUP BY 2
UNION ALL SELECT 'total', 'days', '', CAST(count(DISTINCT collection_date) AS BIGINT) FROM tagged
UNION ALL SELECT 'total', 'articles', '', CAST(count(*) AS BIGINT) FROM tagged WHERE doc_id = u""",
    [ARTICLES, S.TAGGED],
)
def index_build(spark, sf_dir):
    """All articles stored, then the index of one date; the master list held English articles of earlier dates."""
    base = scratch_dir(spark, "index")
    df = tagged(spark, sf_dir)
    tags = records.tag_struct(F.col("tags.continents"), matched_keywords=F.col("tags.matched_keywords"), core_topics=F.col("tags.core_topics"))
    df = df.withColumn("tags", tags).drop("source", "origin", "content_length")
    batch = records.to_articles(df, "rss", NOW, keep_date=True, extra=["doc_id", "lang"])
    store.save_articles(store.first_per_id(batch, "doc_id"), base)
    table = store.articles(spark, base)
    english = articles(spark, sf_dir).where("doc_id = u AND lang = 'en' AND collection_date < DATE '2025-11-09'")
    built = reports.build_index(table, ONE_DATE, rollups.card_stats(english))
    shown = F.concat_ws("|", "title", "shown_date", "continents", "keywords")
    none, no_text = F.lit(0).cast("long"), F.lit("")
    rows = built.articles.withColumn("row", F.monotonically_increasing_id())
    # A date's articles in the order they come out in.
    place = rows.groupBy().agg(F.sort_array(F.collect_list(F.struct("row", "url"))).alias("all"))
    place = place.select(F.posexplode("all").alias("place", "one"))
    parts = [
        built.articles.select(F.lit("article").alias("part"), F.col("url").alias("key"), shown.alias("text"), F.col("content_length").cast("long").alias("n")),
        place.select(F.lit("order"), (F.col("place") + 1).cast("string"), F.col("one.url"), none),
        built.header.select(F.lit("header"), F.col("collection_date").cast("string"), no_text, "articles"),
        built.facets.select(F.lit("facet"), "facet", "value", none),
        built.master.select(F.lit("card"), F.col("collection_date").cast("string"), no_text, "articles"),
        built.totals.select(F.lit("total"), F.lit("days"), no_text, "total_days"),
        built.totals.select(F.lit("total"), F.lit("articles"), no_text, "total_articles"),
    ]
    return reduce(DataFrame.union, parts)


# ---------------------------------------------------------------------------
# Bills and senate pages: read by kind, and read again for the store
# ---------------------------------------------------------------------------
BILL = "https://www.govinfo.gov/app/details/BILLS-"
SENATE = "https://www25.senado.leg.br/web/materia/"
LONG = "bill " * 250
KINDS = f"""kinds AS (SELECT *, CASE u % 3 WHEN 0 THEN '{BILL}' || u WHEN 1 THEN '{SENATE}' || u ELSE url END AS own, u % 4 AS way FROM articles WHERE doc_id = u),
bills AS (SELECT *, CASE way WHEN 0 THEN '<body><div class=''govinfo-content''><bill>{LONG}' || u || '</bill></div></body>'
    WHEN 1 THEN '<body class="b">{LONG}' || u || '</body>' END AS body FROM kinds WHERE u % 3 = 0),
senate AS (SELECT *, CASE WHEN way <> 0 THEN '<body><div class=''senado-content''><h1>Materia ' || u || '</h1><div id=''textoMateria''>' || phrase || chr(10)
    || 'n. ' || u || '</div></div></body>' END AS body FROM (SELECT k.*, {sql_pick(PHRASES, f'u % {len(PHRASES)}')} AS phrase FROM kinds k) WHERE u % 3 = 1)"""


def _by_kind(spark, sf_dir):
    """A third of the articles as bills, a third as senate pages, the rest as they are; `way` is what their pages hold."""
    df = articles(spark, sf_dir).where("doc_id = u")
    number = F.col("u").cast("string")
    own = F.when(F.col("u") % 3 == 0, F.concat(F.lit(BILL), number)).when(F.col("u") % 3 == 1, F.concat(F.lit(SENATE), number))
    df = df.withColumns({"url": F.coalesce(own, F.col("url")), "way": F.col("u") % 4, "number": number})
    return df.withColumn("phrase", pick(PHRASES, F.col("u") % len(PHRASES)))


def _kind_pages(df):
    """Pages of bill packages (XML, HTML; too short ones, none) and of the senate (none for some)."""
    bills, senate = df.where("u % 3 = 0"), df.where("u % 3 = 1 AND way <> 0")
    bill = X.bill_id(F.col("url"))
    xml = F.when(F.col("way") == 0, F.concat(F.lit(f"<bill>{LONG}"), "number", F.lit("</bill>"))).otherwise("<bill/>")
    version = F.when(F.col("way") == 1, F.concat(F.lit(f'<html><body class="b">{LONG}'), "number", F.lit("</body></html>"))).otherwise("<html/>")
    page = F.concat(
        F.lit("<html><h1>Senado</h1><div id='materia'><h1> Materia "), "number", F.lit("</h1></div><div id='textoMateria'><p>"), "phrase",
        F.lit("</p><div><p>n. "), "number", F.lit("</p></div></div></html>"),
    )
    parts = [
        bills.where("way <> 3").select(X.bill_xml_url(bill).alias("url"), xml.alias("html")),
        bills.where("way <> 3").select(X.bill_html_url(bill).alias("url"), version.alias("html")),
        senate.select("url", page.alias("html")),
    ]
    return reduce(DataFrame.union, parts)


def _backfill_sql(table: str) -> str:
    return f"""SELECT 'article' AS what, own AS key, CAST(length(coalesce(b.body, content)) AS BIGINT) AS n, md5(coalesce(b.body, content)) AS digest
FROM kinds k LEFT JOIN (SELECT doc_id, body FROM {table}) b USING (doc_id)
UNION ALL SELECT 'report', unnest(['updated', 'failed', 'total']), unnest([count(body), count(*) - count(body), count(*)]), '' FROM {table}"""


def _backfilled(spark, sf_dir, plan, name):
    base = scratch_dir(spark, name)
    df = _by_kind(spark, sf_dir)
    batch = df.withColumn("tags", records.tag_struct(F.array(F.lit("Global")))).drop("source", "origin", "content_length")
    store.save_articles(records.to_articles(batch, "legislation", NOW, keep_date=True), base)
    pages_path = scratch_dir(spark, f"{name}-pages")
    _kind_pages(df).write.parquet(pages_path)
    table, content = store.articles(spark, base), store.contents(spark, base)
    new_table, new_content = plan(table, content, spark.read.parquet(pages_path))
    staged = scratch_dir(spark, f"{name}-outcomes")
    new_table.select("backfill").write.parquet(staged)
    dates = [row[0] for row in table.select("collection_date").distinct().collect()]
    store.rewrite_backfilled(new_table, new_content, base, dates)
    report = rollups.backfill_report(spark.read.parquet(staged))
    # Digests, not texts, go through the join.
    digests = store.contents(spark, base).select(*store.KEY, F.md5("content").alias("digest"))
    stored = store.articles(spark, base).join(digests, store.KEY)
    counts = report.select(F.inline(F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).alias("n")) for c in ("updated", "failed", "total")))))
    return stored.select(
        F.lit("article").alias("what"), F.col("url").alias("key"), F.col("content_length").cast("long").alias("n"), "digest"
    ).union(counts.select(F.lit("report"), "key", "n", F.lit("")))


@query("backfill_bills", _backfill_sql("bills"), [ARTICLES, KINDS])
def backfill_bills(spark, sf_dir):
    """Stored bills with their content read again, written back, and the report."""
    return _backfilled(spark, sf_dir, reports.backfill_bills, "bills")


@query("backfill_senate", _backfill_sql("senate"), [ARTICLES, KINDS])
def backfill_senate(spark, sf_dir):
    """Stored senate articles with their content read again, written back, and the report."""
    return _backfilled(spark, sf_dir, reports.backfill_senate, "senate")


@query(
    "page_kinds",
    """SELECT own AS url, CASE WHEN u % 3 = 0 AND body IS NOT NULL THEN body WHEN u % 3 = 1 AND body IS NOT NULL THEN body
  ELSE 'Plain ' || u || chr(10) || 'n. ' || u END AS content
FROM (SELECT own, u, body FROM bills UNION ALL SELECT own, u, body FROM senate UNION ALL SELECT own, u, NULL FROM kinds WHERE u % 3 = 2)""",
    [ARTICLES, KINDS],
)
def page_kinds(spark, sf_dir):
    """Content by the kind of the page: bills, the senate, and what is neither or has nothing of its kind."""
    df = _by_kind(spark, sf_dir).drop("html")
    plain = F.concat(F.lit("<html><body><article><p>Plain "), "number", F.lit("</p><p>n. "), "number", F.lit("</p></article></body></html>"))
    pages = _kind_pages(df)
    own = df.join(pages.withColumnRenamed("html", "own_html"), "url", "left")
    items = own.select("url", F.coalesce("own_html", plain).alias("html"))
    bill = X.govinfo_links(F.col("url"))
    items = items.withColumns({"xml_key": bill["xml_url"], "html_key": bill["html_url"]})
    xml = pages.select(F.col("url").alias("xml_key"), F.col("html").alias("bill_xml"))
    version = pages.select(F.col("url").alias("html_key"), F.col("html").alias("bill_html"))
    read = H.extract_content(items.join(xml, "xml_key", "left").join(version, "html_key", "left"))
    return read.select("url", "content")


# Domain, selectors, dropped elements, separator and least length of the rules of three sites; the third one's rule finds nothing.
SITE_RULES = [
    ("src1.example.org", [".story", "#body"], ["nav", "b"], "|", 0),
    ("example.org", ['[data-x="y"]', "section"], [], "", 3),
    ("src2.example.org", [".nowhere"], [], "", 0),
]


@query(
    "site_rules",
    """SELECT own AS url, extractor, content FROM (
  SELECT own, 'generic' AS extractor, body AS content FROM bills WHERE body IS NOT NULL
  UNION ALL SELECT own, 'generic', body FROM senate WHERE body IS NOT NULL
  UNION ALL SELECT own, 'generic', 'Plain ' || u || chr(10) || 'n. ' || u FROM (SELECT own, u FROM bills WHERE body IS NULL UNION ALL SELECT own, u FROM senate WHERE body IS NULL)
  UNION ALL SELECT own, CASE WHEN host = 'src2' THEN 'generic' ELSE 'site' END,
    CASE WHEN host = 'src1' THEN 'Story|' || u WHEN host = 'src2' THEN 'Plain ' || u || chr(10) || 'n. ' || u ELSE 'Long enough ' || u END FROM kinds WHERE u % 3 = 2)""",
    [ARTICLES, KINDS],
)
def site_rules(spark, sf_dir):
    """Pages by the rules of their sites: subdomains, a more special rule, one that finds nothing, bills, the senate, no rule."""
    df = _by_kind(spark, sf_dir)
    extra = F.concat(
        F.lit("<html><body><nav class='story'>x</nav><div class='big story'><b>no</b>Story<p>"), "number",
        F.lit("</p></div><p data-x='y'>ab</p><section>Long enough "), "number", F.lit("</section><article><p>Plain "), "number",
        F.lit("</p><p>n. "), "number", F.lit("</p></article></body></html>"),
    )
    pages = _kind_pages(df)
    items = df.select("url", "number", extra.alias("own_page")).join(pages.withColumnRenamed("html", "kind_page"), "url", "left")
    bill = X.govinfo_links(F.col("url"))
    items = items.select("url", F.coalesce("kind_page", "own_page").alias("html"), bill["xml_url"].alias("xml_key"), bill["html_url"].alias("html_key"))
    xml = pages.select(F.col("url").alias("xml_key"), F.col("html").alias("bill_xml"))
    version = pages.select(F.col("url").alias("html_key"), F.col("html").alias("bill_html"))
    items = items.join(xml, "xml_key", "left").join(version, "html_key", "left")
    rules = spark.createDataFrame(SITE_RULES, R.RULES)
    return R.extract_by_site(items, rules).select("url", "extractor", "content")


# ---------------------------------------------------------------------------
# Sites graded from their section pages
# ---------------------------------------------------------------------------
SITE_CHECKS = f"""linked AS (SELECT page_id, page_id % 20 AS k,
  replace(replace(html, '<title>', '<title>' || phrase || ': '), '</article>', phrase || '</article>') AS html
  FROM (SELECT *, {sql_pick(PHRASES, f'page_id % {len(PHRASES)}')} AS phrase FROM pages_x)),
site_pages AS (
  SELECT 'src' || k AS source, k, 'https://src' || k || '.example.org/news/2025/' || page_id AS link, page_id % 7 <> 3 AS ok,
    {S.any_part('lower(html)', lex.BLOCKED_PAGE_TERMS)} AS blocked, length({sql_article('html', ('script', 'style'))}) > 200 AS long_enough, {SITE_TEXT} AS low
  FROM linked WHERE k <> 11 AND (k % 10 <> 3 OR page_id < 60)),
site_ranked AS (
  SELECT p.*, region, row_number() OVER (PARTITION BY source ORDER BY link) AS rn FROM site_pages p JOIN sources USING (source)),
site_counts AS (
  SELECT source, count(*) FILTER (rn <= 20) AS found, count(*) FILTER (rn <= 10 AND ok AND long_enough AND NOT blocked) AS extracted,
    count(*) FILTER (rn <= 15 AND ok AND {RELEVANT}) AS relevant, count(*) FILTER (rn <= 15 AND ok AND {REGION_TEST}) AS regional
  FROM site_ranked GROUP BY source),
site_stages AS (
  SELECT source, region, http_status, http_status = 200 AS s1, source <> 'src7' AS free, source <> 'src11' AS parsed,
    coalesce(found, 0) AS found, coalesce(extracted, 0) AS extracted, coalesce(relevant, 0) AS relevant, coalesce(regional, 0) AS regional
  FROM sources JOIN fetch_log USING (source) LEFT JOIN site_counts USING (source)),
site_gates AS (
  SELECT *, s1 AND free AS s2, s1 AND free AND parsed AS s3, s1 AND free AND parsed AND found >= 5 AS s4,
    s1 AND free AND parsed AND found >= 5 AND extracted >= 3 AS s5, s1 AND free AND parsed AND found >= 5 AND extracted >= 3 AND relevant > 0 AS s6,
    s1 AND free AND parsed AND found >= 5 AND extracted >= 3 AND relevant > 0 AND regional > 0 AS s7 FROM site_stages)"""


@query(
    "site_checks",
    """SELECT source, region, CAST(CASE WHEN s3 THEN found ELSE 0 END AS BIGINT) AS article_links_found,
  CAST(CASE WHEN s4 THEN extracted ELSE 0 END AS BIGINT) AS content_extraction_success,
  CAST(CASE WHEN s5 THEN relevant ELSE 0 END AS BIGINT) AS relevant_articles, CAST(CASE WHEN s6 THEN regional ELSE 0 END AS BIGINT) AS geographic_articles,
  CAST(2 * CAST(s2 AS INTEGER) + CAST(s3 AS INTEGER) + CAST(s4 AS INTEGER) + CAST(s5 AS INTEGER) + CAST(s6 AS INTEGER) + CAST(s7 AS INTEGER) AS INTEGER) AS tests_passed,
  CASE WHEN s7 THEN 'PASSED' ELSE 'FAILED' END AS status,
  CASE WHEN NOT s1 THEN 'HTTP ' || http_status WHEN NOT s2 THEN 'Anti-bot measures detected' WHEN NOT s3 THEN 'HTML parsing failed'
    WHEN NOT s4 THEN 'Too few article links found: ' || found WHEN NOT s5 THEN 'Content extraction failed for most articles: ' || extracted || '/10'
    WHEN NOT s6 THEN 'No relevant articles found' WHEN NOT s7 THEN 'No ' || region || ' relevant articles found' ELSE '' END AS error
FROM site_gates""",
    [ARTICLES, PAGES, SOURCES, SITE_CHECKS],
)
def site_checks(spark, sf_dir):
    """Sites by what their section pages link to: some block, one cannot be read, some have few links, some pages do not answer."""
    linked = _linked_pages(pages(spark, sf_dir)).select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("page_id"), "html")
    k = F.col("page_id") % 20
    host = F.concat(F.lit("https://src"), k.cast("string"), F.lit(".example.org"))
    path = F.concat(F.lit("/news/2025/"), F.col("page_id").cast("string"))
    shown = linked.where((k % 10 != 3) | (F.col("page_id") < 60))
    anchor = F.concat(F.lit("<h2><a href='"), path, F.lit("'>More</a></h2><a href='"), path, F.lit("'>again</a><a href='/about'>About</a>"))
    # A section page has the links of its site; as many as the supplied pages have.
    section = shown.groupBy(k.alias("k"), host.alias("host")).agg(F.array_join(F.sort_array(F.collect_list(anchor)), "\n").alias("links"))
    note = F.when(F.col("k") == 7, "<p>Captcha</p>").otherwise("")
    html = F.when(F.col("k") != 11, F.concat(F.lit("<html><body>"), note, "links", F.lit("<a href='mailto:x@y.z'>Mail</a></body></html>")))
    sections = section.select(F.concat(F.lit("src"), F.col("k").cast("string")).alias("source"), F.concat("host", F.lit("/")).alias("url"), html.alias("html"))
    answered = linked.where("page_id % 7 <> 3").select(F.concat(host, path).alias("url"), "html")
    graded = sites.check_sites(sections, answered, fetch_log(spark, sf_dir), sources(spark, sf_dir))
    return graded.select(
        "source", "region", "article_links_found", "content_extraction_success", "relevant_articles", "geographic_articles",
        "tests_passed", "status", "error",
    )


# ---------------------------------------------------------------------------
# Master report
# ---------------------------------------------------------------------------
@query(
    "master_report",
    """SELECT coalesce(kind, 'all') AS kind, CAST(count(*) AS BIGINT) AS total_tested,
  CAST(count(*) FILTER (status = 'PASSED') AS BIGINT) AS passed,
  CAST(count(*) FILTER (tier IN ('deploy_immediately', 'deploy_with_monitoring')) AS BIGINT) AS ready_sources,
  CASE WHEN kind IS NULL THEN (SELECT round(count(*) FILTER (len(missing) = 0) * 100.0 / count(*), 6) FROM results) ELSE 0 END AS detection_accuracy
FROM (SELECT 'rss' AS kind, status, tier FROM feed_tiers UNION ALL SELECT 'site', status, tier FROM site_tiers) GROUP BY ROLLUP (kind)""",
    [ARTICLES, PAGES, SOURCES, FEED_HEALTH, SITE_HEALTH, LOW_TEXTS, REGION_LIST, CASES],
)
def master_report(spark, sf_dir):
    """Feeds, sites and the accuracy of region detection in one report."""
    report = health.master_report(_feed_health(spark, sf_dir), _site_health(spark, sf_dir), detection_cases(spark, sf_dir))
    return report.select("kind", "total_tested", "passed", "ready_sources", "detection_accuracy")
