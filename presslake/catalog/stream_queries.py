"""Streaming queries: the supplied tables read as file streams, run to their end."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from presslake.catalog.corpus import ARTICLES, AS_OF, as_articles, load
from presslake.catalog.registry import query
from presslake.catalog.sql import PARSED
from presslake.session import scratch_dir
from presslake.streaming import dedupe, ingest


BATCHES = 4


def _stream(df, work, name="in", batches=BATCHES):
    """A table as a stream of several batches whose times are mixed: files by hash, one file a batch."""
    shuffled = df.withColumn("file", F.pmod(F.xxhash64(*df.columns), F.lit(batches)))
    shuffled.repartition(batches, "file").drop("file").write.mode("append").parquet(f"{work}/{name}")
    return ingest.ingest_stream(df.sparkSession, f"{work}/{name}", df.schema, max_files=1)


def _half(df, n):
    return df.where(F.pmod(F.xxhash64(F.lit(1), *df.columns), F.lit(2)) == n)


def _urls(spark, path):
    out = spark.read.schema("url string, collection_date date").parquet(path)
    return out.withColumn("collection_date", F.col("collection_date").cast("string"))


@query(
    "stream_dedupe",
    "SELECT DISTINCT url, CAST(collection_date AS VARCHAR) AS collection_date FROM articles",
    [ARTICLES],
)
def stream_dedupe(spark, sf_dir):
    """URLs of several batches in mixed time order, each kept once, by two runs that know nothing of each other."""
    work = scratch_dir(spark, "stream-dedupe")
    slim = as_articles(load(spark, sf_dir, "documents")).select("url", "collection_date")
    for run in (0, 1):
        stream = _stream(_half(slim, run), work, f"in{run}", 2)
        ingest.run_to_end(ingest.append_new(stream, f"{work}/out", ["url"], "collection_date"), f"{work}/checkpoint{run}")
    return _urls(spark, f"{work}/out")


@query(
    "stream_daily_counts",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, 'src' || (user_id % 20) AS source, event_type,
  CAST(count(*) AS BIGINT) AS articles FROM events GROUP BY ALL""",
)
def stream_daily_counts(spark, sf_dir):
    """Events of several batches in mixed time order, counted by day by two runs of different files."""
    events = load(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("source"),
        "event_type",
    )
    by = ["source", "event_type"]
    work = scratch_dir(spark, "stream-counts")
    for run in (0, 1):
        stream = _stream(_half(events, run), work, f"in{run}", 2)
        ingest.run_to_end(ingest.add_counts(stream, f"{work}/out", by), f"{work}/checkpoint{run}")
    latest = ingest.total_counts(spark, f"{work}/out", by)
    return latest.withColumn("day", F.col("day").cast("string"))


@query(
    "stream_fresh",
    """SELECT CAST(collection_date AS VARCHAR) AS day, lang, CAST(count(DISTINCT url) AS BIGINT) AS urls, CAST(count(*) AS BIGINT) AS articles
FROM (SELECT *, collection_date IN (SELECT collection_date FROM articles WHERE lang = 'en' AND collection_date < DATE '2025-11-08') AS again FROM articles)
WHERE CASE WHEN again THEN lang = 'en' ELSE lang <> 'de' END GROUP BY ALL""",
    [ARTICLES],
)
def stream_fresh(spark, sf_dir):
    """A run without German articles, then a fresh one over a week of English ones: only its days are replaced."""
    work = scratch_dir(spark, "stream-fresh")
    slim = as_articles(load(spark, sf_dir, "documents")).select("url", "lang", "collection_date", F.col("collection_date").cast("timestamp").alias("ts"))
    parts = {False: slim.where("lang <> 'de'"), True: slim.where("lang = 'en' AND collection_date < DATE '2025-11-08'")}
    for fresh, rows in parts.items():
        stream = _stream(rows, work, f"in-{fresh}", 2)
        urls = ingest.append_new(stream.drop("ts"), f"{work}/urls", ["url", "lang"], "collection_date", fresh=fresh)
        ingest.run_to_end(urls, f"{work}/urls-{fresh}")
        ingest.run_to_end(ingest.add_counts(stream, f"{work}/counts", ["lang"], fresh=fresh), f"{work}/counts-{fresh}")
    urls = spark.read.schema("url string, lang string, collection_date date").parquet(f"{work}/urls")
    urls = urls.groupBy(F.col("collection_date").alias("day"), "lang").agg(F.count_distinct("url").alias("urls"))
    both = urls.join(ingest.total_counts(spark, f"{work}/counts", ["lang"]), ["day", "lang"], "full")
    return both.withColumn("day", F.col("day").cast("string"))


@query(
    "stream_state",
    """SELECT DISTINCT url, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM (
  SELECT 'https://src' || (user_id % 20) || '.example.org/' || event_type || '/' || (event_id % 50) AS url, ts FROM events)""",
)
def stream_state(spark, sf_dir):
    """Fetched URLs, each once per day by keyed state: mixed batches, a restart with more files, then a run from the beginning."""
    source = F.concat(F.lit("https://src"), (F.col("user_id") % 20).cast("string"), F.lit(".example.org/"), "event_type", F.lit("/"))
    url = F.concat(source, (F.col("event_id") % 50).cast("string"))
    fetched = load(spark, sf_dir, "events").select(url.alias("url"), F.col("ts").cast("timestamp").alias("ts"))
    work = scratch_dir(spark, "stream-state")
    for half, checkpoint in ((0, "a"), (1, "a"), (None, "b")):
        if half is not None:
            stream = _stream(_half(fetched, half), work, batches=2)
        kinds = dedupe.write_kinds(dedupe.first_per_day(stream, ["url"]), f"{work}/out")
        ingest.run_to_end(kinds, f"{work}/checkpoint-{checkpoint}")
    out = dedupe.settled(spark, f"{work}/out", ["url"])
    return out.select("url", F.col("ts").cast("date").cast("string").alias("day"))


def _fetched(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    source = F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string"))
    return events.select(source.alias("source"), "event_type", F.col("ts").cast("timestamp").alias("ts"))


@query("stream_within_watermark", "SELECT DISTINCT 'src' || (user_id % 20) AS source, event_type FROM events")
def stream_within_watermark(spark, sf_dir):
    """The first row of each source and event type, by state that a watermark behind all rows would clear."""
    work = scratch_dir(spark, "stream-watermark")
    stream = _stream(_fetched(spark, sf_dir), work, batches=2)
    once = ingest.dedupe_stream(stream, ["source", "event_type"], delay="60 days").select("source", "event_type")
    ingest.run_to_end(ingest.append_to(once, f"{work}/out"), f"{work}/checkpoint")
    return spark.read.schema("source string, event_type string").parquet(f"{work}/out")


@query(
    "stream_windowed_counts",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, 'src' || (user_id % 20) AS source, CAST(count(*) AS BIGINT) AS articles
FROM events GROUP BY ALL""",
)
def stream_windowed_counts(spark, sf_dir):
    """Events per day and source in update mode: the last version of each count, after batches in mixed time order."""
    work = scratch_dir(spark, "stream-windows")
    counted = ingest.daily_counts_stream(_stream(_fetched(spark, sf_dir), work, batches=2), ["source"], delay="60 days")
    ingest.run_to_end(ingest.write_updates(counted, f"{work}/out"), f"{work}/checkpoint")
    latest = ingest.latest_updates(spark, f"{work}/out", ["day", "source"])
    return latest.withColumn("day", F.col("day").cast("string"))


@query(
    "stream_recent",
    f"""SELECT doc_id, url FROM (SELECT *, {PARSED} AS parsed FROM articles)
WHERE CASE WHEN pub_date = '' THEN true WHEN parsed IS NOT NULL THEN parsed >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY
  WHEN regexp_extract(pub_date, '(\\d{{4}})', 1) <> '' THEN CAST(regexp_extract(pub_date, '(\\d{{4}})', 1) AS INTEGER) >= 2025
  ELSE true END""",
    [ARTICLES],
)
def stream_recent(spark, sf_dir):
    """Recent and undated articles of a stream of several batches."""
    work = scratch_dir(spark, "stream-recent")
    slim = as_articles(load(spark, sf_dir, "documents")).select("doc_id", "url", "pub_date")
    fresh = ingest.recent_stream(_stream(slim, work), datetime.fromisoformat(AS_OF)).select("doc_id", "url")
    ingest.run_to_end(ingest.append_to(fresh, f"{work}/out"), f"{work}/checkpoint")
    return spark.read.schema("doc_id long, url string").parquet(f"{work}/out")
