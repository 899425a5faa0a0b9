"""The store, collection runs over it, and streams."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from presslake.functions import tagging
from presslake.operators import rollups
from presslake.plans import legislation, news, records, reports
from presslake.sources import store
from presslake.streaming import ingest

NOW = datetime(2025, 11, 4, 12)
DAY = ["2025-11-04"]
LONG = "Solar power and gas in Lagos. " * 10
BILL = "https://www.govinfo.gov/app/details/BILLS-119hr7ih/summary"
BILL_XML = "https://www.govinfo.gov/content/pkg/BILLS-119hr7ih/xml/BILLS-119hr7ih.xml"
SENATE = "https://www12.senado.leg.br/noticias/1"


def rss(*items):
    body = "".join(
        f"<item><title>{t}</title><link>{u}</link><pubDate>{d}</pubDate><description>{x}</description></item>"
        for t, u, d, x in items
    )
    return f"<rss><channel>{body}</channel></rss>"


@pytest.fixture
def documents(spark):
    new, old = "Tue, 04 Nov 2025 09:00:00 GMT", "Mon, 03 Nov 2014 10:00:00 GMT"
    return spark.createDataFrame(
        [
            ("https://b.example/feed", rss(("Gas again", "https://n/1", new, ""), ("Nothing", "https://n/2", new, "plain"))),
            ("https://a.example/feed", rss(("Oil first", "https://n/1", new, "x"), ("Coal", "https://n/3", old, ""), ("No link: gas", "", new, ""))),
            ("https://www.congress.gov/rss/x.xml", rss(("Nuclear bill", BILL, "", ""), ("Nuclear act", SENATE, new, ""), ("Energy", "https://n/short", new, ""))),
        ],
        "feed_url string, xml string",
    )


@pytest.fixture
def pages(spark):
    page = f"<html><article><p>{LONG}</p></article></html>"
    senate = f"<div id='materia'><h1>Lei</h1><div id='textoMateria'><p>{LONG}</p></div></div>"
    return spark.createDataFrame(
        [("https://n/1", page), ("https://n/2", page), ("https://n/3", page), ("https://n/short", "<article>x</article>"),
         (BILL, page), (BILL_XML, "<bill>" + "energy " * 200 + "</bill>"), (SENATE, senate)],
        "url string, html string",
    )


def ids(df):
    return {r.url for r in df.select("url").collect()}


def test_news_run_is_idempotent(spark, documents, pages, tmp_path):
    base = str(tmp_path / "store")
    run = news.rss_articles(documents, pages, NOW)
    rows = {r.url: r for r in run.collect()}
    assert set(rows) == {"https://n/1", "https://n/3", BILL, SENATE}
    assert rows["https://n/1"].title == "Oil first" and rows["https://n/1"].feed_url == "https://a.example/feed"
    assert rows["https://n/1"].tags.matched_keywords == ["solar power", "gas", "oil"]
    assert rows["https://n/1"].tags.continents == ["Africa"] and rows["https://n/1"].source == "RSS Feed"
    assert rows[BILL].tags.special_tags == ["legislation"]
    assert rows["https://n/1"].content_length == len(LONG.strip())
    store.save_articles(run, base, DAY)
    table = store.articles(spark, base)
    assert ids(store.articles_for_date(table, DAY[0])) == set(rows)
    again = news.rss_articles(documents, pages, NOW, seen=store.seen_urls(table, DAY[0]), stored=store.stored_pairs(spark, base))
    assert again.count() == 0
    assert news.rss_articles(documents, pages, NOW, seen=store.seen_urls(table, DAY[0]), fresh=True).count() == len(rows)
    store.save_articles(run, base, DAY)
    assert store.articles(spark, base).count() == store.contents(spark, base).count() == len(rows)


def test_year_filter_only_when_strict(documents, pages):
    assert "https://n/3" not in ids(news.rss_articles(documents, pages, NOW, strict_year=True))


def test_half_stored_articles_are_repaired(spark, documents, pages, tmp_path):
    base = str(tmp_path / "store")
    run = news.rss_articles(documents, pages, NOW)
    lost = run.where(F.col("url") != "https://n/1")
    store._write(run.select(*store.ARTICLE_CONTENT.fieldNames()), f"{base}/content")
    store._write(lost.select(*store.ARTICLES.fieldNames()), f"{base}/articles")
    assert ids(store.new_only(run, base)) == {"https://n/1"}
    store.save_articles(store.new_only(run, base), base, DAY)
    assert store.new_only(run, base).count() == 0
    assert store.articles(spark, base).count() == store.contents(spark, base).count() == 4


def test_fresh_run_replaces(spark, documents, pages, tmp_path):
    base = str(tmp_path / "store")
    store.save_articles(news.rss_articles(documents, pages, NOW), base, DAY)
    other = pages.withColumn("html", F.replace("html", F.lit("Lagos"), F.lit("Berlin")))
    changed = news.rss_articles(documents, other, NOW, fresh=True).where(F.col("url") == "https://n/1")
    store.save_articles(changed, base, DAY)
    assert store.contents(spark, base).where(F.col("content").contains("Berlin")).count() == 0
    store.save_articles(changed, base, DAY, fresh=True)
    kept = store.articles(spark, base).join(store.contents(spark, base), store.KEY).collect()
    assert len(kept) == 4
    assert [r.tags.continents for r in kept if "Berlin" in r.content] == [["Europe"]]


def test_legislation_runs(spark, documents, pages):
    daily = {r.url: r for r in legislation.legislation_articles(documents, pages, NOW).collect()}
    assert set(daily) == {"https://n/1", "https://n/2", "https://n/short", BILL, SENATE}
    assert daily[BILL].content.startswith("<body><div class='govinfo-content'><bill>energy")
    assert daily[SENATE].content.startswith("<body><div class='senado-content'><h1>Lei</h1>")
    assert daily["https://n/short"].content == "x" and daily["https://n/short"].tags.matched_keywords == []
    assert {r.tags.special_tags[0] for r in daily.values()} == {"legislation"}
    past = {r.url: r for r in legislation.historical_articles(documents, pages, NOW).collect()}
    assert set(past) == set(daily) | {"https://n/3"}
    assert past["https://n/3"].content.startswith("<article><p>Solar") and past["https://n/3"].origin == "historical"
    seen = spark.createDataFrame([(BILL,)], "url string")
    assert BILL not in ids(legislation.legislation_articles(documents, pages, NOW, seen=seen))


def test_backfills_and_index(spark, documents, pages, tmp_path):
    base = str(tmp_path / "store")
    store.save_articles(news.rss_articles(documents, pages, NOW), base, DAY)
    table, content = store.articles(spark, base), store.contents(spark, base)
    for plan, url, start in [
        (reports.backfill_bills, BILL, "<body><div class='govinfo"), (reports.backfill_senate, SENATE, "<body><div class='senado"),
    ]:
        new_table, new_content = plan(table, content, pages)
        report = rollups.backfill_report(new_table).first()
        assert (report.updated, report.failed, report.total) == (1, 0, 1)
        row = new_table.join(new_content, store.KEY).where(F.col("url") == url).first()
        assert row.content.startswith(start) and row.content_length == len(row.content)
        assert new_table.count() == 4
    failed, _ = reports.backfill_bills(table, content, pages.limit(0))
    assert rollups.backfill_report(failed).first().failed == 1
    new_table, new_content = reports.backfill_bills(table, content, pages)
    store.rewrite_backfilled(new_table, new_content, base, DAY)
    assert store.contents(spark, base).where(F.col("content").contains("govinfo-content")).count() == 1
    built = reports.build_index(store.articles(spark, base), DAY[0])
    shown = built.articles.collect()
    assert len(shown) == 4 and [r.sort_ts is None for r in shown].index(True) == 3 and shown[2].url == "https://n/3"
    assert built.header.first().articles == built.master.first().articles == built.totals.first().total_articles == 4
    assert {r.value for r in built.facets.collect()} >= {"RSS Feed", "gas", "solar power"}


def test_master_keeps_other_dates(spark):
    old = spark.createDataFrame([("2025-11-03", 5, 2), ("2025-11-04", 1, 1)], "d string, articles long, sources long")
    old = old.select(F.col("d").cast("date").alias("collection_date"), "articles", "sources")
    new = old.where("articles = 1").withColumn("articles", F.lit(9).cast("long"))
    got = [(str(r.collection_date), r.articles) for r in rollups.upsert_master(old, new).collect()]
    assert got == [("2025-11-04", 9), ("2025-11-03", 5)]


# ---------------------------------------------------------------------------
# Streams
# ---------------------------------------------------------------------------
def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_stream_resumes_and_adds_nothing_on_replay(spark, tmp_path):
    path, base, check = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "check")
    schema = "url string, content string, n int"
    write(spark, path, [("u1", "a", 1), ("u1", "b", 2), ("u2", "c", 3)], schema)

    def run(checkpoint):
        raw = ingest.ingest_stream(spark, path, spark.read.parquet(path).schema)
        tags = records.tag_struct(tagging.continents(F.col("content")))
        rows = records.to_articles(raw.withColumn("tags", tags), "rss", NOW, extra=("n",))
        ingest.run_to_end(ingest.sink_batches(rows, base, "n"), checkpoint)
        return {(r.url, r.content) for r in store.articles(spark, base).join(store.contents(spark, base), store.KEY).collect()}

    assert run(check) == {("u1", "a"), ("u2", "c")}
    write(spark, path, [("u2", "late", 4), ("u3", "d", 5)], schema)
    assert run(check) == {("u1", "a"), ("u2", "c"), ("u3", "d")}
    assert run(str(tmp_path / "fresh")) == {("u1", "a"), ("u2", "c"), ("u3", "d")}
    assert store.articles(spark, base).count() == 3


def test_stream_dedupe_across_batches(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "url string, ts timestamp"
    rows = [("hot", datetime(2025, 11, 4, 1))] * 50 + [("a", datetime(2025, 11, 4, 2))]
    write(spark, path, rows, schema)
    df = ingest.dedupe_stream(ingest.ingest_stream(spark, path, spark.read.parquet(path).schema))
    ingest.run_to_end(ingest.append_to(df, out), check)
    write(spark, path, [("hot", datetime(2025, 11, 4, 3)), ("b", datetime(2025, 11, 4, 4))], schema)
    df = ingest.dedupe_stream(ingest.ingest_stream(spark, path, spark.read.parquet(path).schema))
    ingest.run_to_end(ingest.append_to(df, out), check)
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["a", "b", "hot"]


def test_stream_counts_equal_batch(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "source string, ts timestamp"
    first = [("s", datetime(2025, 11, 4, h)) for h in range(5)] + [("t", datetime(2025, 11, 5, 1))]
    second = [("s", datetime(2025, 11, 4, 23)), ("t", datetime(2025, 11, 5, 2))]
    for rows in (first, second):
        write(spark, path, rows, schema)
        df = ingest.ingest_stream(spark, path, spark.read.parquet(path).schema)
        ingest.run_to_end(ingest.write_updates(ingest.daily_counts_stream(df, ["source"]), out), check)
    got = {(str(r.day), r.source): r.articles for r in ingest.latest_updates(spark, out, ["day", "source"]).collect()}
    assert got == {("2025-11-04", "s"): 6, ("2025-11-05", "t"): 2}


def test_recent_stream_keeps_undated(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, path, [("Mon, 03 Nov 2014 10:00:00 GMT",), ("",), ("2025-11-04",)], "pub_date string")
    df = ingest.recent_stream(ingest.ingest_stream(spark, path, spark.read.parquet(path).schema), NOW)
    ingest.run_to_end(ingest.append_to(df, out), str(tmp_path / "check"))
    assert sorted(r.pub_date for r in spark.read.parquet(out).collect()) == ["", "2025-11-04"]


def test_streams_lose_no_late_rows(spark, tmp_path):
    """Batches in falling time order, far behind any watermark: every URL once, every row counted; a replay adds nothing."""
    path = str(tmp_path / "in")
    for day in (14, 13, 1):
        rows = [(f"u{day}", f"2025-11-{day:02d} 10:00:00"), ("shared", "2025-11-13 10:00:00"), (f"u{day}", f"2025-11-{day:02d} 11:00:00")]
        df = spark.createDataFrame(rows, "url string, ts string").select("url", F.col("ts").cast("timestamp").alias("ts"))
        df.withColumn("day", F.col("ts").cast("date")).coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    for _ in range(2):
        stream = ingest.ingest_stream(spark, path, schema, max_files=1)
        ingest.run_to_end(ingest.append_new(stream.select("url", "day"), str(tmp_path / "urls"), ["url"], "day"), str(tmp_path / "c1"))
        ingest.run_to_end(ingest.add_counts(stream, str(tmp_path / "counts"), ["url"]), str(tmp_path / "c2"))
    urls = sorted((r.url, str(r.day)) for r in spark.read.parquet(str(tmp_path / "urls")).collect())
    assert urls == [("shared", "2025-11-13"), ("u1", "2025-11-01"), ("u13", "2025-11-13"), ("u14", "2025-11-14")]
    counts = {(r.url, str(r.day)): r.articles for r in ingest.total_counts(spark, str(tmp_path / "counts"), ["url"]).collect()}
    assert counts == {("shared", "2025-11-13"): 3, ("u1", "2025-11-01"): 2, ("u13", "2025-11-13"): 2, ("u14", "2025-11-14"): 2}


def test_markets_sharing_a_url_keep_the_larger(spark):
    from presslake.plans.markets import market_articles

    text = "string"
    fields = ["id", "question", "slug", "description", "category", "volume", "liquidity"]
    schema = ", ".join(f"{f} {text}" for f in fields) + ", outcomes array<string>, outcomePrices array<string>, closed boolean, startDate string, createdAt string"
    rows = [(i, "Will the Senate vote?", "same", "d", "Politics", v, "1", ["Yes"], ["0.5"], False, "", "") for i, v in (("10", "5"), ("9", "500"), ("8", "7"))]
    out = market_articles(spark.createDataFrame(rows, schema), NOW).collect()
    assert len(out) == 1 and "500" in str(out[0])


def test_latest_page_and_feed_order(spark):
    from presslake.operators import joins
    from presslake.plans import news

    pages = spark.createDataFrame([("u", "old", 1), ("u", "new", 2), ("v", "v", 1)], "url string, html string, fetched_at int")
    items = spark.createDataFrame([("u",), ("w",)], "url string")
    assert [tuple(r) for r in joins.attach_content(items, pages).collect()] == [("u", "new")]
    placed = spark.createDataFrame([("z", 0, 3, "u", "first"), ("a", 1, 0, "u", "second")], "feed_url string, feed_pos int, item_pos int, url string, title string")
    assert [r.title for r in news.first_items(placed).collect()] == ["first"]
    assert [r.title for r in news.first_items(placed.drop("feed_pos")).collect()] == ["second"]
    stored = spark.createDataFrame([("2025-11-01",)], "d string").select(F.md5(F.lit("u")).alias("article_id"), F.col("d").cast("date").alias("collection_date"))
    assert news._with_stored(placed, stored, NOW).count() == 2
    assert news._with_stored(placed, stored.withColumn("collection_date", F.lit(NOW.date())), NOW).count() == 0
