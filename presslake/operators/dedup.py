"""Deduplication, first-N per group, ordering and top-k.

A key may hold a third of all rows, so no key's rows are ever brought together
whole: winners are found by aggregates that combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SALTS = 32
# Fixed value: the title of a dated index card.
CARD_DATE = r"Daily News Collection - (\d{4}-\d{2}-\d{2})"


def dedupe_by(df: DataFrame, keys: Sequence[str], order: str, keep: str = "first") -> DataFrame:
    """Exactly one row per key: that with the smallest (`first`) or largest (`last`) `order`.

    Spark cuts each task's rows to one per key before the shuffle, so a hot key sends one row per task, and a
    wide row is neither an aggregation buffer nor shuffled in vain."""
    by = F.col(order).asc_nulls_last() if keep == "first" else F.col(order).desc_nulls_last()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(by))
    return df.withColumn("_place", rank).where(F.col("_place") == 1).drop("_place")


def dedupe_urls(df: DataFrame, order: str, keep: str = "first", url: str = "url") -> DataFrame:
    """First save wins (or the last, in a fresh run) per URL."""
    return dedupe_by(df, [url], order, keep)


def dedupe_cards(cards: DataFrame) -> DataFrame:
    """Dated index cards (title, position): the first card of each date, newest date first."""
    date = F.regexp_extract("title", CARD_DATE, 1)
    dated = cards.select(date.alias("date"), "title", "position").where(F.col("date") != "")
    first = dated.groupBy("date").agg(
        F.min("position").alias("position"), F.min_by("title", "position").alias("title")
    )
    return first.orderBy(F.col("date").desc())


def head_per_source(df: DataFrame, n: int, source: str, order: Sequence[str]) -> DataFrame:
    """The first `n` rows of each source, with their place in `head_rank`.

    Spark cuts each task's rows to `n` per group before a shuffle. A hot source
    would still send `n` rows from every task to one place, so a first round
    cuts by source and a hash of the row, which leaves at most `n` rows per hash
    for the second."""
    salt = F.pmod(F.xxhash64(*order), F.lit(SALTS))
    salted = df.withColumn("head_salt", salt)
    first = F.row_number().over(W.partitionBy(source, "head_salt").orderBy(*order))
    few = salted.withColumn("head_rank", first).where(F.col("head_rank") <= n).drop("head_rank", "head_salt")
    rank = F.row_number().over(W.partitionBy(source).orderBy(*order))
    return few.withColumn("head_rank", rank).where(F.col("head_rank") <= n)


def cap_links(links: DataFrame, n: int, site: str = "base_url", url: str = "url") -> DataFrame:
    """At most `n` links per site, the first by URL."""
    return head_per_source(links, n, site, [url]).drop("head_rank")


def newest_first(df: DataFrame, when: Column, *ties: str) -> DataFrame:
    """Newest first; rows without a readable date last."""
    return df.orderBy(when.desc_nulls_last(), *ties)


def dates_desc(df: DataFrame, date: str = "collection_date") -> DataFrame:
    return df.orderBy(F.col(date).desc())


def top_markets(markets: DataFrame, k: int = 500) -> DataFrame:
    """The `k` largest by volume. The cut is part of the market report, and comes before any filter."""
    return markets.orderBy(F.col("volume_usd").desc(), F.col("id")).limit(k)
