"""Prediction markets: keys, numbers, outcomes and the political selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from presslake.functions import tagging, text
from presslake.functions.match import no_strings
from presslake.functions.predicates import is_political

PAGE_ROWS = 100


def market_stats(df: DataFrame) -> DataFrame:
    """Numbers as doubles (missing counts as 0), status, category and their display forms."""
    return df.withColumns(
        {
            "volume_usd": text.number_or_zero(F.col("volume")),
            "liquidity_usd": text.number_or_zero(F.col("liquidity")),
            "status": F.when(F.coalesce("closed", F.lit(False)), "Closed").otherwise("Open"),
            "category_shown": F.coalesce("category", F.lit("N/A")),
        }
    ).withColumns(
        {"volume_shown": text.dollars(F.col("volume_usd")), "liquidity_shown": text.dollars(F.col("liquidity_usd"))}
    )


def market_keys(df: DataFrame) -> DataFrame:
    """Question, URL and start of a market, with their defaults."""
    start = F.coalesce(F.nullif("startDate", F.lit("")), F.nullif("createdAt", F.lit("")), F.lit(""))
    return df.withColumns(
        {
            "title": F.coalesce("question", F.lit("Unknown Market")),
            "url": F.concat(F.lit(text.MARKET_BASE + "/"), F.coalesce("slug", "id", F.lit(""))),
            "pub_date": start,
        }
    )


def percent(pct: Column) -> Column:
    return F.when(pct.isNotNull(), F.format_string("%.1f%%", pct)).otherwise("N/A")


def market_outcomes(df: DataFrame) -> DataFrame:
    """One row per outcome that has a price: `pct` (NULL if unreadable) and its display form."""
    paired = df.where(F.col("outcomes").isNotNull() & F.col("outcomePrices").isNotNull()).select(
        "id",
        F.size("outcomePrices").alias("n_prices"),
        F.posexplode(F.arrays_zip("outcomes", "outcomePrices")).alias("pos", "pair"),
        F.size("outcomes").alias("n_outcomes"),
    )
    pct = F.col("pair.outcomePrices").try_cast("double") * 100
    return paired.where(F.col("pos") < F.least("n_prices", "n_outcomes")).select(
        "id",
        "pos",
        F.col("pair.outcomes").alias("outcome"),
        pct.alias("pct"),
        percent(pct).alias("pct_shown"),
    )


def political_markets(df: DataFrame) -> DataFrame:
    return df.where(is_political(F.col("category"), F.col("question"), F.col("description")))


def market_tags(df: DataFrame) -> DataFrame:
    """The tag struct of each market, from its question and description."""
    combined = text.tag_text(F.coalesce("question", F.lit("Unknown Market")), F.col("description"))
    return df.withColumn(
        "tags",
        F.struct(
            tagging.continents(combined).alias("continents"),
            no_strings().alias("matched_keywords"),
            F.array(F.lit("geopolitics")).alias("core_topics"),
            F.array(F.lit("prediction_market")).alias("special_tags"),
            tagging.countries(combined).alias("countries"),
            F.struct(
                F.col("volume").try_cast("double").alias("volume"),
                F.col("liquidity").try_cast("double").alias("liquidity"),
                F.col("outcomes").alias("outcomes"),
                F.col("outcomePrices").alias("prices"),
                F.coalesce("closed", F.lit(False)).alias("closed"),
            ).alias("market_data"),
        ),
    )


def market_content(df: DataFrame) -> DataFrame:
    """The text stored as a market's content: its numbers, prices and resolution criteria."""
    shown = F.transform(
        F.arrays_zip("outcomes", "outcomePrices"),
        lambda p: F.when(
            p["outcomes"].isNotNull() & p["outcomePrices"].isNotNull(),
            F.concat(
                p["outcomes"], F.lit(": "),
                percent(p["outcomePrices"].try_cast("double") * 100),
            ),
        ),
    )
    return df.withColumn(
        "content",
        F.concat_ws(
            "\n",
            F.coalesce("question", F.lit("Unknown Market")),
            F.concat(F.lit("Volume: "), "volume_shown"),
            F.concat(F.lit("Liquidity: "), "liquidity_shown"),
            F.concat(F.lit("Status: "), "status"),
            F.concat(F.lit("Category: "), "category_shown"),
            F.concat_ws("\n", F.coalesce(shown, no_strings())),
            F.coalesce("description", F.lit("")),
        ),
    )


def ranked(top: DataFrame) -> DataFrame:
    """Rank from 1 by volume; for a top-k list, which is short by definition."""
    order = W.partitionBy(F.lit(0)).orderBy(F.col("volume_usd").desc(), F.col("id"))
    return top.withColumn("rank", F.row_number().over(order))
