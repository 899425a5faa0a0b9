"""Incremental runs as Structured Streaming queries.

Progress lives in the checkpoint, so a rerun resumes where the last one stopped. A new
checkpoint reads everything again and adds what is missing; `fresh=True` replaces its days.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from presslake.functions.dates import recent
from presslake.operators.dedup import dedupe_by
from presslake.schemas import ARTICLES, FEED_DOCUMENTS
from presslake.sources import store
from presslake.sources.tables import read_or_empty

SALTS = 64


def ingest_stream(
    spark: SparkSession, path: str, schema: T.StructType = FEED_DOCUMENTS, max_files: int | None = None
) -> DataFrame:
    """New parquet files of a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_name(batch: DataFrame) -> str:
    """The name of the streaming query that hands over a batch: kept in its checkpoint, so the same after a restart."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def append_new(df: DataFrame, path: str, keys: Sequence[str], day: str, fresh: bool = False) -> DataStreamWriter:
    """Each key once per day into a table partitioned by `day`, however late its rows come.

    No state and no watermark, so nothing is discarded: a batch's rows are held against what
    the table has for the batch's days, and only those partitions are read. A
    replayed batch adds nothing, and so does a new checkpoint over files already read.

    A `fresh` run replaces what earlier runs have stored for its days, and no other day: the first of its batches with a
    day overwrites that day's partition and notes it in `_claims` beside the table; later ones add to it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        claims = f"{path}/_claims/run={run_name(batch)}"
        days = batch.select(F.col(day).alias("_day")).distinct()
        of_day = F.col(day).eqNullSafe(F.col("_day"))
        once = batch.dropDuplicates([day, *keys])
        if fresh:
            claimed = read_or_empty(spark, claims, days.schema).withColumnRenamed("_day", "_claimed").distinct()
            new_days = days.join(claimed, F.col("_day").eqNullSafe(F.col("_claimed")), "left_anti")
            writer = once.join(new_days, of_day, "left_semi").write.mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
            # After the overwrite, so that a batch cut short is written again.
            new_days.write.mode("append").parquet(claims)
        stored = read_or_empty(spark, path, batch.schema).join(days, of_day, "left_semi").select(day, *keys)
        stored = stored.toDF(*(f"_stored_{i}" for i in range(len(keys) + 1)))
        same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_stored_{i}")) for i, c in enumerate((day, *keys))))
        once.join(stored, same, "left_anti").write.mode("append").partitionBy(day).parquet(path)

    return df.writeStream.outputMode("append").foreachBatch(write)


def add_counts(df: DataFrame, path: str, by: Sequence[str], ts: str = "ts", fresh: bool = False) -> DataStreamWriter:
    """Rows of each batch per day of `ts` and `by`, under its run and number; a replayed batch overwrites itself.

    Days stay open for good: `total_counts` sums what all batches of all runs have counted. What a `fresh` run
    counts for a day replaces what had been counted for it before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(F.col(ts).cast("date").alias("day"), *by).agg(F.count(F.lit(1)).alias("articles"))
        counted = counted.withColumns({"written": F.current_timestamp(), "fresh": F.lit(fresh)})
        counted.write.mode("overwrite").parquet(f"{path}/run={run_name(batch)}/batch_id={batch_id}")

    return df.writeStream.outputMode("append").foreachBatch(write)


def total_counts(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """Counts per day and `by`, from the first batch on of the last fresh run that had the day, if there was one."""
    counts = spark.read.parquet(path)
    begun = counts.where("fresh").groupBy("day", "run").agg(F.min("written").alias("begun"))
    since = begun.groupBy(F.col("day").alias("fresh_day")).agg(F.max("begun").alias("since"))
    kept = counts.join(since, F.col("day").eqNullSafe(F.col("fresh_day")), "left")
    kept = kept.where(F.col("since").isNull() | (F.col("written") >= F.col("since")))
    return kept.groupBy("day", *by).agg(F.sum("articles").alias("articles"))


def dedupe_stream(df: DataFrame, keys: Sequence[str] = ("url",), ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """First row of each key within `delay` of event time; later rows are discarded, see `append_new` for all of them.

    A first round per key and task number keeps a hot key's copies apart; the
    second round then gets at most a few rows of any key.
    """
    salted = df.withColumn("salt", F.spark_partition_id() % SALTS).withWatermark(ts, delay)
    once_per_salt = salted.dropDuplicatesWithinWatermark([*keys, "salt"]).drop("salt")
    return once_per_salt.dropDuplicatesWithinWatermark(list(keys))


def recent_stream(df: DataFrame, as_of, days: int = 1, pub_date: str = "pub_date") -> DataFrame:
    """Late items dropped, undated ones kept: a filter, since a watermark would drop those too."""
    return df.where(recent(F.col(pub_date), as_of, days))


def daily_counts_stream(df: DataFrame, by: Sequence[str], ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Rows per day of event time and `by`, in update mode, of rows at most `delay` late; see `add_counts` for all."""
    counted = (
        df.withWatermark(ts, delay).groupBy(F.window(ts, "1 day"), *by).agg(F.count("*").alias("articles"))
    )
    return counted.select(F.col("window.start").cast("date").alias("day"), *by, "articles")


def run_to_end(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process what is there, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_to(df: DataFrame, path: str) -> DataStreamWriter:
    return df.writeStream.format("parquet").option("path", path).outputMode("append")


def write_updates(df: DataFrame, path: str) -> DataStreamWriter:
    """Updated rows of each batch under their batch number; a replayed batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return df.writeStream.outputMode("update").foreachBatch(write)


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last version of each key written by `write_updates`."""
    return dedupe_by(spark.read.parquet(path), list(keys), "batch_id", keep="last").drop("batch_id")


def sink_batches(df: DataFrame, base: str, order: str, fresh: bool = False) -> DataStreamWriter:
    """Articles into the store, batch by batch: a replayed batch adds nothing.

    `df` has the ARTICLES columns, `content` and `order`, by which the first of
    several copies in one batch is chosen.
    """
    columns = [*ARTICLES.fieldNames(), "content", order]

    def save(batch: DataFrame, batch_id: int) -> None:
        store.save_articles(store.first_per_id(batch.select(*columns), order), base, fresh=fresh)

    return df.writeStream.outputMode("append").foreachBatch(save)

