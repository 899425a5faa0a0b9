"""The article store: metadata and content tables, partitioned by collection date.

Content is written first and metadata last, and only a pair counts as stored,
so a run cut short is repaired by running it again. What it left alone is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.operators.dedup import dedupe_by
from presslake.operators.joins import drop_stored
from presslake.schemas import ARTICLE_CONTENT, ARTICLES
from presslake.session import drop_dir, scratch_dir
from presslake.sources.tables import read_or_empty

KEY = ["collection_date", "article_id"]


#: Stands for the length of an article whose content is being replaced.
REPLACING = -1


def articles(spark: SparkSession, base: str) -> DataFrame:
    """Stored metadata; none of articles whose replacement was cut short."""
    table = read_or_empty(spark, f"{base}/articles", ARTICLES)
    return table.where(F.coalesce("content_length", F.lit(0)) != REPLACING)


def contents(spark: SparkSession, base: str) -> DataFrame:
    return read_or_empty(spark, f"{base}/content", ARTICLE_CONTENT)


def articles_for_date(table: DataFrame, date: str) -> DataFrame:
    """All origins of one date; reads that partition only."""
    return table.where(F.col("collection_date") == F.lit(date).cast("date"))


def seen_urls(table: DataFrame, date: str) -> DataFrame:
    return articles_for_date(table, date).select("url").distinct()


def _in_dates(table: DataFrame, dates: list) -> DataFrame:
    return table.where(F.col("collection_date").isin(dates))


def _write(table: DataFrame, path: str, replace: bool = False) -> None:
    # Rebalancing keeps files even when one date holds most rows: adaptive
    # execution splits a large date over several tasks.
    writer = table.hint("rebalance", "collection_date").write.partitionBy("collection_date")
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def save_articles(batch: DataFrame, base: str, dates: list | None = None, fresh: bool = False) -> None:
    """Store a batch of articles (ARTICLES columns plus `content`) of the given dates (if not
    given, those that occur in it).

    Normally what is already stored stays and only new articles are added; in
    `fresh` mode the batch replaces stored articles of the same URL. `batch` must
    hold each article once per date. It is computed once, into a scratch table
    both halves are then read from, which is deleted in the end.

    A fresh run first marks the metadata it is about to replace, then replaces the contents, then the metadata. Cut
    anywhere, it leaves no new content beside old metadata: marked articles do not count as stored.
    """
    spark = batch.sparkSession
    meta_columns, content_columns = ARTICLES.fieldNames(), ARTICLE_CONTENT.fieldNames()
    staged = scratch_dir(spark, "batch")
    batch = batch.select(*dict.fromkeys(meta_columns + content_columns))
    batch.write.parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    days = batch.select("collection_date").distinct()

    def of_days(table: DataFrame) -> DataFrame:
        # Either way only the partitions of these days are read.
        return table.join(days, "collection_date", "left_semi") if dates is None else _in_dates(table, dates)

    old_articles, old_contents = of_days(articles(spark, base)), of_days(contents(spark, base))
    if fresh:
        kept_articles = _without(old_articles, batch).select(*meta_columns)
        kept_contents = _without(old_contents, batch)
        # A mark stands for metadata that is never shown again, so it needs no more than the key.
        marks = old_articles.select(*KEY).join(batch.select(*KEY), KEY, "left_semi").withColumn("content_length", F.lit(REPLACING))
        _replace(kept_articles.unionByName(marks, allowMissingColumns=True), f"{base}/articles")
        _replace(kept_contents.select(*content_columns).unionByName(batch.select(*content_columns)), f"{base}/content")
        kept_articles = _without(of_days(articles(spark, base)), batch).select(*meta_columns)
        _replace(kept_articles.unionByName(batch.select(*meta_columns)), f"{base}/articles")
    else:
        # Content without metadata is what a run cut short has left, of whatever state: it gives way to the batch's.
        alone = old_contents.select(*KEY).join(old_articles.select(*KEY), KEY, "left_anti").join(batch.select(*KEY), KEY, "left_semi")
        if alone.limit(1).count():
            kept_contents = _without(old_contents, alone)
            added = _without(batch, kept_contents)
            _replace(kept_contents.select(*content_columns).unionByName(added.select(*content_columns)), f"{base}/content")
        else:
            missing_content = _without(batch, old_contents)
            _write(missing_content.select(*content_columns), f"{base}/content")
        missing_meta = _without(batch, old_articles)
        _write(missing_meta.select(*meta_columns), f"{base}/articles")
    drop_dir(spark, staged)


def _without(table: DataFrame, others: DataFrame) -> DataFrame:
    """Rows of `table` whose key is not in `others`; both are stored, so keys are cheap to read.

    Whole rows go through a join only where some of them stay and some do not.
    """
    keys, known = table.select(*KEY), others.select(*KEY)
    if not keys.join(known, KEY, "left_anti").limit(1).count():
        return table.limit(0)
    if not keys.join(known, KEY, "left_semi").limit(1).count():
        return table
    return table.join(known, KEY, "left_anti")


def _replace(table: DataFrame, path: str) -> None:
    """Overwrites the partitions of a table's days, from which it may itself be read: old files
    go when all new ones are written."""
    _write(table, path, replace=True)


def stored_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Ids whose metadata and content are both stored."""
    return articles(spark, base).select(*KEY).join(contents(spark, base).select(*KEY), KEY, "left_semi")


def new_only(batch: DataFrame, base: str) -> DataFrame:
    """Rows of `batch` not yet stored as a pair; of the store only the batch's dates are read."""
    spark = batch.sparkSession
    dates = batch.select("collection_date").distinct()
    old_articles, old_contents = (
        t.select(*KEY).join(dates, "collection_date", "left_semi") for t in (articles(spark, base), contents(spark, base))
    )
    if not old_articles.join(old_contents, KEY, "left_semi").limit(1).count():
        return batch
    return drop_stored(batch, old_articles, old_contents, KEY)


def first_per_id(batch: DataFrame, order: str) -> DataFrame:
    """Each article once per date: the row with the smallest `order`."""
    return dedupe_by(batch, KEY, order, keep="first")


def backfill_content(
    table: DataFrame, content: DataFrame, fresh_content: DataFrame, url_part: str
) -> tuple[DataFrame, DataFrame]:
    """Replace content of articles whose URL contains `url_part` and recompute its length.

    `fresh_content` is (url, new_content), each URL once; a NULL or empty text
    is a failed fetch and leaves the article as it was. Returns the new article
    and content tables, the article table with `backfill` = updated / failed
    for selected rows, else NULL.
    """
    fresh = fresh_content.select("url", F.nullif("new_content", F.lit("")).alias("new_content"))
    selected = F.col("url").contains(url_part)
    picked = table.where(selected).select(*KEY, "url").join(fresh, "url", "left")
    outcome = F.when(F.col("new_content").isNotNull(), "updated").otherwise("failed")
    marked = picked.select(*KEY, F.char_length("new_content").alias("new_length"), outcome.alias("backfill"))
    new_table = (
        table.join(marked, KEY, "left")
        .withColumn("content_length", F.coalesce("new_length", "content_length"))
        .drop("new_length")
    )
    new_content = (
        content.join(picked.select(*KEY, "new_content"), KEY, "left")
        .withColumn("content", F.coalesce("new_content", "content"))
        .drop("new_content")
    )
    return new_table, new_content


def rewrite_backfilled(new_table: DataFrame, new_content: DataFrame, base: str, dates: list) -> None:
    """Write back the partitions a backfill touched, content first; both tables may be read from the store itself."""
    columns, content_columns = ARTICLES.fieldNames(), ARTICLE_CONTENT.fieldNames()
    _write(_in_dates(new_content, dates).select(*content_columns), f"{base}/content", replace=True)
    _write(_in_dates(new_table, dates).select(*columns), f"{base}/articles", replace=True)
