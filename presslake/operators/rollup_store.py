"""Rollups kept up batch by batch: what a date counts is added to, and nothing already counted is read again.

A rollup folder holds

* `names`: a number, from 1 on, for every source and keyword ever seen;
* `days`: per batch and date the sums (articles, characters);
* `marks`: per batch and date the sources and keywords that occurred, as bitmaps over their numbers.

Sums add up and bitmaps are or-ed, so counts of distinct names over any dates are exact. An article is counted by the batch
that brings it: batches hold new articles only, as `store.new_only` gives them. A batch that is sent again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.functions.text import title_case
from presslake.operators.rollups import UNKNOWN
from presslake.session import drop_dir, scratch_dir
from presslake.sources.tables import read_or_empty

NAMES = "kind string, name string, number long"
SOURCE, KEYWORD = "source", "keyword"


def add_batch(batch: DataFrame, path: str, name: str) -> None:
    """Counts new articles (collection_date, source, content_length, tags.matched_keywords) into the folder at `path`."""
    spark = batch.sparkSession
    slim = batch.select(
        "collection_date",
        F.coalesce("source", F.lit(UNKNOWN)).alias("source"),
        F.col("source").isNull().alias("unnamed"),
        F.coalesce("content_length", F.lit(0)).alias("chars"),
        F.coalesce("tags.matched_keywords", F.array().cast("array<string>")).alias("keywords"),
    )
    # The batch is computed once: reading keywords from texts would be repeated for each table.
    staged = scratch_dir(spark, "rollup-batch")
    slim.write.parquet(staged)
    slim = spark.read.schema(slim.schema).parquet(staged)
    sums = slim.groupBy("collection_date").agg(
        F.count(F.lit(1)).alias("articles"), F.sum("chars").cast("long").alias("chars"), F.count_if("unnamed").alias("unnamed")
    )
    pairs = F.concat(
        F.array(F.struct(F.lit(SOURCE).alias("kind"), F.col("source").alias("name"))),
        F.transform("keywords", lambda k: F.struct(F.lit(KEYWORD).alias("kind"), k.alias("name"))),
    )
    # One row per date and name before anything is joined, however often a name occurs.
    seen = slim.select("collection_date", F.explode(pairs).alias("pair")).select("collection_date", "pair.*").distinct()
    names = _numbered(spark, seen, path)
    marks = seen.join(names, ["kind", "name"]).groupBy("collection_date", "kind", F.bitmap_bucket_number("number").alias("bucket"))
    marks = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    sums.write.mode("overwrite").parquet(f"{path}/days/batch={name}")
    marks.write.mode("overwrite").parquet(f"{path}/marks/batch={name}")
    drop_dir(spark, staged)


def _numbered(spark: SparkSession, seen: DataFrame, path: str) -> DataFrame:
    """The names table, after the names that are new in `seen` were given the next numbers."""
    known = read_or_empty(spark, f"{path}/names", NAMES)
    new = seen.select("kind", "name").distinct().join(known, ["kind", "name"], "left_anti")
    highest = known.groupBy("kind").agg(F.max("number").alias("highest"))
    # Only names that no batch had before, of which there are ever fewer.
    place = F.row_number().over(Window.partitionBy("kind").orderBy("name"))
    numbered = new.withColumn("place", place).join(highest, "kind", "left")
    numbered = numbered.select("kind", "name", (F.col("place") + F.coalesce("highest", F.lit(0))).cast("long").alias("number"))
    numbered.write.mode("append").parquet(f"{path}/names")
    return spark.read.schema(NAMES).parquet(f"{path}/names")


def _days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/days")


def _marks(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{path}/marks").where(F.col("kind") == kind)


def _distinct(marks: DataFrame, by: list[str], alias: str) -> DataFrame:
    """Distinct names per `by`: bitmaps or-ed per bucket, then counted."""
    merged = marks.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(alias))


def archive_totals(spark: SparkSession, path: str) -> DataFrame:
    """As `rollups.archive_totals`, of everything counted so far."""
    sums = _days(spark, path).agg(
        F.count_distinct("collection_date").alias("total_days"),
        F.coalesce(F.sum("articles"), F.lit(0)).alias("total_articles"),
        F.coalesce(F.floor(F.sum("chars") / 1000), F.lit(0)).cast("long").alias("length_k"),
    )
    sources = _distinct(_marks(spark, path, SOURCE), [], "unique_sources")
    none = F.lit(None).cast("long")
    # Two rows, put into one.
    both = sums.withColumn("unique_sources", none).union(sources.select(none, none, none, "unique_sources"))
    return both.agg(*(F.max(c).alias(c) for c in ("total_days", "total_articles", "length_k")), F.coalesce(F.max("unique_sources"), F.lit(0)).alias("unique_sources"))


def daily_stats(spark: SparkSession, path: str) -> DataFrame:
    """Per date: articles, distinct sources, thousands of characters, distinct keywords."""
    sums = _days(spark, path).groupBy("collection_date").agg(F.sum("articles").alias("articles"), F.sum("chars").alias("chars"))
    sources = _distinct(_marks(spark, path, SOURCE), ["collection_date"], "sources")
    keywords = _distinct(_marks(spark, path, KEYWORD), ["collection_date"], "keywords")
    joined = sums.join(sources, "collection_date", "left").join(keywords, "collection_date", "left")
    return joined.select(
        "collection_date", "articles", F.coalesce("sources", F.lit(0)).alias("sources"),
        F.floor(F.col("chars") / 1000).cast("long").alias("length_k"), F.coalesce("keywords", F.lit(0)).alias("keywords"),
    )


def card_stats(spark: SparkSession, path: str) -> DataFrame:
    """The master list's cards: per date articles and distinct sources, missing sources not counted."""
    unnamed = _days(spark, path).groupBy("collection_date").agg(F.sum("unnamed").alias("unnamed"))
    # A source that bears the name of missing ones cannot be told from them, and is not counted where both occur.
    stats = daily_stats(spark, path).join(unnamed, "collection_date")
    return stats.select("collection_date", "articles", (F.col("sources") - F.when(F.col("unnamed") > 0, 1).otherwise(0)).alias("sources"))


def facets(spark: SparkSession, path: str, dates: list | None = None) -> DataFrame:
    """Sorted sources and keywords with their labels, of the given dates (of all if none are given)."""
    marks = spark.read.parquet(f"{path}/marks")
    if dates is not None:
        marks = marks.where(F.col("collection_date").isin(dates))
    merged = marks.groupBy("kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    names = spark.read.schema(NAMES).parquet(f"{path}/names").withColumn("bucket", F.bitmap_bucket_number("number"))
    found = names.join(merged, ["kind", "bucket"]).where(_bit(F.col("bits"), F.bitmap_bit_position("number")))
    label = F.when(F.col("kind") == KEYWORD, title_case(F.col("name"))).otherwise(F.col("name"))
    return found.select(F.col("kind").alias("facet"), F.col("name").alias("value"), label.alias("label")).orderBy("facet", "value")


def _bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1
