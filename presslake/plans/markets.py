"""Political prediction markets as articles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions import text
from presslake.operators import dedup
from presslake.operators import markets as M
from presslake.plans.records import tag_struct, to_articles
from presslake.sources.tables import open_markets

# Fixed value: the address that stands for the market feed.
FEED = "https://gamma-api.polymarket.com/markets"


def market_articles(markets: DataFrame, as_of: datetime, max_markets: int = 500) -> DataFrame:
    """The largest open markets, then those that are political."""
    top = dedup.top_markets(M.market_stats(open_markets(markets)), max_markets)
    chosen = M.market_content(M.market_tags(M.market_keys(M.political_markets(top))))
    tags = F.col("tags")
    record = tag_struct(
        tags["continents"],
        core_topics=tags["core_topics"],
        special_tags=tags["special_tags"],
        countries=tags["countries"],
        market_data=tags["market_data"],
    )
    chosen = chosen.withColumns(
        {"tags": record, "description": text.market_description(F.col("description")), "feed_url": F.lit(FEED)}
    )
    # Markets are saved in the order of their volume, and of a shared URL the first save wins.
    placed = chosen.withColumn("place", F.struct(F.negative("volume_usd").alias("volume"), "id"))
    return to_articles(dedup.dedupe_urls(placed, "place").drop("place"), "market", as_of)
