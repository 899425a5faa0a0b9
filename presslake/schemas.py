"""Fixed table schemas. Dates and instants are columns; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_strings = T.ArrayType(T.StringType())


def _struct(ddl: str) -> T.StructType:
    fields = [part.strip().split(" ", 1) for part in ddl.split(",")]
    kinds = {
        "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
        "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
        "timestamp": T.TimestampType(), "strings": _strings,
    }
    return T.StructType([T.StructField(name, kinds[kind.strip()]) for name, kind in fields])


FEED_DOCUMENTS = _struct("feed_url string, xml string, fetched_at timestamp")
FEED_ITEMS = _struct(
    "feed_url string, item_pos int, title string, link string, pub_date string, description string"
)
PAGES = _struct("url string, html string")
MARKETS = _struct(
    "id string, question string, slug string, description string, category string,"
    " volume string, liquidity string, outcomes string, outcomePrices string,"
    " closed boolean, startDate string, createdAt string"
)
MARKET_DATA = _struct(
    "volume double, liquidity double, outcomes strings, prices strings, closed boolean"
)
TAGS = _struct(
    "continents strings, matched_keywords strings, core_topics strings,"
    " special_tags strings, countries strings"
).add("market_data", MARKET_DATA)
ARTICLES = (
    _struct(
        "article_id string, title string, url string, pub_date string, date string,"
        " description string, source string, origin string, feed_url string, base_url string,"
        " content_length int, collection_ts timestamp"
    )
    .add("tags", TAGS)
    .add("collection_date", T.DateType())
)
ARTICLE_CONTENT = _struct("article_id string, content string, collection_date date")
DETECTION_CASES = _struct("name string, text string, expected strings")
SOURCES = _struct("source_url string, kind string, region string")
INGEST_LOG = _struct("source_url string, completed_at timestamp")
