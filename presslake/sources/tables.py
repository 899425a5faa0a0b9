"""Page, market and legacy article readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.schemas import ARTICLES, MARKETS

LEGACY_TAGS = (
    "struct<continents: array<string>, matched_keywords: array<string>, core_topics: array<string>,"
    " special_tags: array<string>, countries: array<string>,"
    " market_data: struct<volume: double, liquidity: double, outcomes: array<string>,"
    " prices: array<string>, closed: boolean>>"
)
LEGACY_ARTICLE = (
    "title string, url string, pub_date string, date string, description string, source string,"
    " feed_url string, base_url string, content_length int, collection_date string,"
    f" tags {LEGACY_TAGS}"
)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table of the given schema, empty if its folder does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_markets(spark: SparkSession, path: str) -> DataFrame:
    """Open markets from JSON arrays. Numbers and arrays may come as JSON strings."""
    raw = spark.read.schema(MARKETS).json(path, multiLine=True)
    return open_markets(
        raw.withColumns({c: F.from_json(c, "array<string>") for c in ("outcomes", "outcomePrices")})
    )


def open_markets(markets: DataFrame) -> DataFrame:
    return markets.where(~F.coalesce(F.col("closed"), F.lit(False)))


def read_legacy_articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles kept as one JSON object per metadata file; unreadable ones are skipped."""
    raw = (
        spark.read.schema(LEGACY_ARTICLE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .option("multiLine", "true")
        .option("mode", "DROPMALFORMED")
        .json(path)
        .withColumn("path", F.col("_metadata.file_path"))
    )
    folder = F.regexp_extract("path", r"/([^/]+)/metadata/[^/]*$", 1)
    ts = F.col("collection_date").try_cast("timestamp")
    articles = raw.where(F.col("path").contains("/metadata/") & F.col("url").isNotNull()).select(
        F.md5("url").alias("article_id"),
        "title", "url", "pub_date", "date", "description", "source",
        F.when(folder.isin("rss", "direct"), folder)
        .when(F.array_contains("tags.special_tags", "legislation"), "legislation")
        .when(F.array_contains("tags.special_tags", "prediction_market"), "market")
        .otherwise("rss")
        .alias("origin"),
        "feed_url", "base_url", "content_length",
        ts.alias("collection_ts"),
        "tags",
        F.coalesce(F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/", 1).try_cast("date"), ts.cast("date"))
        .alias("collection_date"),
    )
    return articles.select(*ARTICLES.fieldNames())


def source_dimension(sources: DataFrame) -> DataFrame:
    """Each source once: (source_url, kind, region)."""
    return sources.groupBy("source_url").agg(F.min("kind").alias("kind"), F.min("region").alias("region"))
