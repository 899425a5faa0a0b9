"""Articles, pages, markets and sources derived from the given tables, their texts whole.

The tables hold invented prose, so lexicon phrases, dates and links are added
to every row by rule. Each view is defined twice, in Spark and as a SQL common
table expression of the same name, over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PHRASES = [
    "Lagos solar power project grows",
    "Berlin nuclear AI summit",
    "climate risk insurance premiums",
    "a comparison of results",
    "please tell us",
    "the eu member states vote on gas",
    "Tokyo supply chain and lithium",
    "Brazil oil tender in Mexico City",
    "Sydney carbon tax protest",
    "FERC and Moody's review grid reliability",
    "Cairo and Riyadh trade war talks",
    "quarterly results improved",
    "the U.S. Congress and the Kremlin",
]
QUESTIONS = [
    "Will the Senate vote on the bill?",
    "Will it rain in Paris?",
    "Will the eu member states agree?",
    "Will the eu (as planned) expand?",
    "Will Putin meet Netanyahu in Cairo?",
    "Will the home team win?",
    "Will oil close above 100 dollars?",
]
CATEGORIES = ["US-current-affairs", "Sports", "Crypto", "Politics"]
ORIGINS = ["rss", "direct", "legislation", "market"]
AS_OF = "2025-11-08 12:00:00"
REGIONS = ["Africa", "Latin America", "MENA", "Global"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores by a unique key, where the session asks for it (`spark.presslake.spread`).

    Only for the supplied tables on one machine: a table of one file with one row group
    is read by one task. On a cluster tables have many splits and stay as they are.
    """
    cores = df.sparkSession.conf.get("spark.presslake.spread", "")
    return df.repartition(int(cores), key) if cores else df


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_pick(values: list[str], index: str) -> str:
    return f"([{', '.join(quoted(v) for v in values)}])[({index}) + 1]"


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# ---------------------------------------------------------------------------
# Articles
# ---------------------------------------------------------------------------
def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_articles(load(spark, sf_dir, "documents"))


def spread_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all cores, for work on the text itself."""
    return as_articles(spread(load(spark, sf_dir, "documents"), "doc_id"))


def as_articles(documents: DataFrame) -> DataFrame:
    """documents as articles; a fifth of the URLs repeat an earlier one, on the same day."""
    doc, text = F.col("doc_id"), F.col("text")
    kind = doc % 7
    return (
        documents
        .withColumns(
            {
                "u": F.when(doc % 100 >= 80, doc - 20).otherwise(doc),
                "phrase": pick(PHRASES, doc % len(PHRASES)),
            }
        )
        .withColumn("collection_date", F.date_add(F.lit("2025-11-01").cast("date"), (F.col("u") % 14).cast("int")))
        .select(
            "doc_id",
            "u",
            "lang",
            F.col("source").alias("host"),
            F.concat(F.lit("https://"), "source", F.lit(".example.org/news/"), F.col("u").cast("string")).alias("url"),
            F.when(doc % 5 == 0, F.concat(F.lit("https://www.congress.gov/rss/"), "source", F.lit(".xml")))
            .otherwise(F.concat(F.lit("https://"), "source", F.lit(".example.org/feed")))
            .alias("feed_url"),
            F.when(doc % 11 != 0, F.col("source")).alias("source"),
            pick(ORIGINS, doc % 4).alias("origin"),
            F.when(doc % 3 == 0, F.concat("phrase", F.lit(": "), F.substring_index(text, "\n", 1)))
            .otherwise(F.substring_index(text, "\n", 1))
            .alias("title"),
            F.concat(F.lit("<p>"), "phrase", F.lit("</p> "), text).alias("description"),
            F.concat(text, F.lit(" "), "phrase").alias("content"),
            F.when(kind == 0, F.date_format("collection_date", "EEE, dd MMM yyyy '10:00:00 GMT'"))
            .when(kind == 1, F.concat(F.col("collection_date").cast("string"), F.lit("T08:30:00+02:00")))
            .when(kind == 2, F.lit("2024-06-15T07:45:30Z"))
            .when(kind == 3, F.lit(""))
            .when(kind == 4, F.lit("garbage"))
            .when(kind == 5, F.lit("order 1999 x"))
            .otherwise(F.concat(F.col("collection_date").cast("string"), F.lit(" 21:15:00")))
            .alias("pub_date"),
            "collection_date",
        )
        .withColumn("content_length", F.char_length("content"))
    )


ARTICLES = f"""documents_u AS (
  SELECT *, CASE WHEN doc_id % 100 >= 80 THEN doc_id - 20 ELSE doc_id END AS u,
    {sql_pick(PHRASES, f'doc_id % {len(PHRASES)}')} AS phrase FROM documents),
documents_d AS (
  SELECT *, CAST(DATE '2025-11-01' + CAST(u % 14 AS INTEGER) AS DATE) AS collection_date FROM documents_u),
articles AS (
  SELECT doc_id, u, lang, source AS host,
    'https://' || source || '.example.org/news/' || CAST(u AS VARCHAR) AS url,
    CASE WHEN doc_id % 5 = 0 THEN 'https://www.congress.gov/rss/' || source || '.xml'
      ELSE 'https://' || source || '.example.org/feed' END AS feed_url,
    CASE WHEN doc_id % 11 <> 0 THEN source END AS source,
    {sql_pick(ORIGINS, 'doc_id % 4')} AS origin,
    CASE WHEN doc_id % 3 = 0 THEN phrase || ': ' || split_part(text, chr(10), 1) ELSE split_part(text, chr(10), 1) END AS title,
    '<p>' || phrase || '</p> ' || text AS description,
    text || ' ' || phrase AS content,
    CASE doc_id % 7 WHEN 0 THEN strftime(collection_date, '%a, %d %b %Y 10:00:00 GMT')
      WHEN 1 THEN CAST(collection_date AS VARCHAR) || 'T08:30:00+02:00'
      WHEN 2 THEN '2024-06-15T07:45:30Z' WHEN 3 THEN '' WHEN 4 THEN 'garbage'
      WHEN 5 THEN 'order 1999 x' ELSE CAST(collection_date AS VARCHAR) || ' 21:15:00' END AS pub_date,
    collection_date, length(text || ' ' || phrase) AS content_length
  FROM documents_d)"""

# ---------------------------------------------------------------------------
# Pages: every page gets a heading link, a link by path and two dated elements
# by rule; some turn into bot checks.
# ---------------------------------------------------------------------------
BLOCKED_NOTE = "<p>Security check: please wait</p>"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    extra = F.concat(
        F.lit('<h2><a href="/news/2025/'), page.cast("string"), F.lit('">More</a></h2>'),
        F.lit('<a class="x" href="https://other.example.org/story/'), (page % 40).cast("string"), F.lit('">'),
        F.lit('Other</a><a href="/tag/'), (page % 3).cast("string"), F.lit('">Tag</a>'),
    )
    dated = F.when(page % 4 == 0, F.lit('<time datetime="2025-11-03">Monday</time>')).when(
        page % 4 == 1, F.lit('<span class="meta publish-date">3 Nov 2025</span>')
    ).when(page % 4 == 2, F.lit("<time>3 November</time>")).otherwise(F.lit(""))
    note = F.when(page % 9 == 0, F.lit(BLOCKED_NOTE)).otherwise(F.lit(""))
    return load(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.replace("html", F.lit("</article>"), F.concat(dated, extra, note, F.lit("</article>"))).alias("html"),
    )


PAGES = f"""pages_x AS (
  SELECT page_id, url, replace(html, '</article>',
    CASE page_id % 4 WHEN 0 THEN '<time datetime="2025-11-03">Monday</time>'
      WHEN 1 THEN '<span class="meta publish-date">3 Nov 2025</span>'
      WHEN 2 THEN '<time>3 November</time>' ELSE '' END ||
    '<h2><a href="/news/2025/' || page_id || '">More</a></h2>' ||
    '<a class="x" href="https://other.example.org/story/' || (page_id % 40) || '">' ||
    'Other</a><a href="/tag/' || (page_id % 3) || '">Tag</a>' ||
    CASE WHEN page_id % 9 = 0 THEN {quoted(BLOCKED_NOTE)} ELSE '' END || '</article>') AS html
  FROM pages)"""


# ---------------------------------------------------------------------------
# Markets from orders
# ---------------------------------------------------------------------------
def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    price = ((key % 101) / 100).cast("decimal(5,2)")
    number = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return spread(load(spark, sf_dir, "orders"), "o_orderkey").select(
        key.cast("string").alias("id"),
        pick(QUESTIONS, key % len(QUESTIONS)).alias("question"),
        F.when(key % 5 != 0, F.concat(F.lit("market-"), key.cast("string"))).alias("slug"),
        F.when(key % 8 != 0, F.concat(F.lit("Resolves by order priority "), "o_orderpriority")).alias("description"),
        F.when(key % 6 != 0, pick(CATEGORIES, key % 4)).alias("category"),
        F.when(key % 13 == 0, F.lit("")).when(key % 17 != 0, number).alias("volume"),
        F.when(key % 19 != 0, number).alias("liquidity"),
        F.array(F.lit("Yes"), F.lit("No"), F.lit("Other")).alias("outcomes"),
        F.when(key % 10 == 9, F.array(F.lit("bad"), price.cast("string")))
        .otherwise(F.array(price.cast("string"), (1 - price).cast("decimal(5,2)").cast("string")))
        .alias("outcomePrices"),
        (F.col("o_orderstatus") == "F").alias("closed"),
        F.when(key % 3 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("")).alias("startDate"),
        F.when(key % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'")).alias("createdAt"),
    )


MARKETS = f"""markets AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, {sql_pick(QUESTIONS, f'o_orderkey % {len(QUESTIONS)}')} AS question,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'market-' || o_orderkey END AS slug,
    CASE WHEN o_orderkey % 8 <> 0 THEN 'Resolves by order priority ' || o_orderpriority END AS description,
    CASE WHEN o_orderkey % 6 <> 0 THEN {sql_pick(CATEGORIES, 'o_orderkey % 4')} END AS category,
    CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS volume,
    CASE WHEN o_orderkey % 19 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS liquidity,
    ['Yes', 'No', 'Other'] AS outcomes,
    CASE WHEN o_orderkey % 10 = 9 THEN ['bad', CAST(CAST((o_orderkey % 101) / 100 AS DECIMAL(5,2)) AS VARCHAR)]
      ELSE [CAST(CAST((o_orderkey % 101) / 100 AS DECIMAL(5,2)) AS VARCHAR),
            CAST(CAST(1 - CAST((o_orderkey % 101) / 100 AS DECIMAL(5,2)) AS DECIMAL(5,2)) AS VARCHAR)] END AS prices,
    o_orderstatus = 'F' AS closed,
    CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS start_date,
    CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' END AS created_at
  FROM orders),
market_numbers AS (
  SELECT *, coalesce(try_cast(nullif(volume, '') AS DOUBLE), 0) AS volume_usd,
    coalesce(try_cast(nullif(liquidity, '') AS DOUBLE), 0) AS liquidity_usd FROM markets),
top_markets AS (
  SELECT *, row_number() OVER (ORDER BY volume_usd DESC, id) AS rank FROM market_numbers
  WHERE NOT closed ORDER BY volume_usd DESC, id LIMIT 500)"""


# ---------------------------------------------------------------------------
# Sources: one per host of the documents, with a region and its last fetch
# ---------------------------------------------------------------------------
def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = load(spark, sf_dir, "documents").select(F.col("source")).distinct()
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    return hosts.select("source", pick(REGIONS, number % 4).alias("region"))


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event per host: users are spread over the hosts, an error is a failed fetch."""
    source = F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string"))
    events = load(spark, sf_dir, "events").withColumn("source", source)
    # The last time per source needs no sort; few events then remain to choose from.
    latest = events.groupBy("source").agg(F.max("ts").alias("ts"))
    last = F.max(F.struct("event_id", "event_type", "value"))
    return (
        events.join(latest, ["source", "ts"])
        .groupBy("source")
        .agg(last.alias("last"))
        .select(
            "source",
            F.when(F.col("last.event_type") == "error", 500).otherwise(200).alias("http_status"),
            (F.col("last.value") / 20).alias("response_time"),
        )
    )


SOURCES = f"""sources AS (
  SELECT DISTINCT source, {sql_pick(REGIONS, "CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 4")} AS region
  FROM documents),
fetch_log AS (
  SELECT source, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_status, value / 20 AS response_time
  FROM (SELECT 'src' || (user_id % 20) AS source, event_type, value,
          row_number() OVER (PARTITION BY user_id % 20 ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1)"""
