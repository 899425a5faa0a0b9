"""Grading stages, tiers, reports, detection cases, searches and first-N operators."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from presslake.functions import dates as D
from presslake.functions import lexicons as lex
from presslake.functions import predicates as P
from presslake.operators import dedup, evaluation, health, joins, rollups, search
from presslake.plans import reports

NOW = datetime(2025, 11, 8)
FRESH = "2025-11-07"


def feed(name, n, fresh=True, text="oil in kenya"):
    return [(name, i, f"{text} {i}", "", None, FRESH if fresh else "2020-01-01") for i in range(n)]


@pytest.fixture(scope="module")
def feeds(spark):
    items = (
        feed("good", 30) + feed("few", 4) + feed("stale", 9, fresh=False) + feed("dull", 9, text="chess in kenya")
        + feed("far", 9, text="oil in peru") + feed("slow", 9) + feed("slower", 9) + feed("down", 9) + feed("world", 9, text="gas")
        + [("late", i, "chess" if i < 20 else "oil in kenya", "", None, FRESH) for i in range(25)]
    )
    names = ["good", "few", "stale", "dull", "far", "slow", "slower", "down", "empty", "world", "late"]
    seconds = {"slow": 4.0, "slower": 9.0}
    log = [(n, 503 if n == "down" else 200, seconds.get(n, 1.0)) for n in names]
    regions = [(n, "Global" if n == "world" else "Africa") for n in names]
    items = spark.createDataFrame(items, "source string, item_pos int, title string, summary string, description string, pub_date string")
    return health.feed_health(
        items,
        spark.createDataFrame(log, "source string, http_status int, response_time double"),
        spark.createDataFrame(regions, "source string, region string"),
        NOW,
    )


def test_feed_grades(feeds):
    got = {r.source: (r.tests_passed, r.status, r.error) for r in feeds.collect()}
    assert got == {
        "good": (6, "PASSED", ""), "slow": (6, "PASSED", ""), "slower": (6, "PASSED", ""), "world": (6, "PASSED", ""),
        "down": (0, "FAILED", "HTTP 503"), "empty": (0, "FAILED", "No entries found in feed"),
        "stale": (2, "FAILED", "No recent articles found"), "few": (3, "FAILED", "Too few articles: 4"),
        "dull": (4, "FAILED", "No relevant articles found"), "late": (4, "FAILED", "No relevant articles found"),
        "far": (5, "FAILED", "No Africa relevant articles found"),
    }
    counts = {r.source: (r.article_count, r.recent_articles, r.relevant_articles) for r in feeds.collect()}
    assert counts["good"] == (30, 10, 20) and counts["late"][0] == 25


def test_tiers_and_reports(spark, feeds):
    tiers = {r.source: r.tier for r in health.deploy_tier(feeds, "rss").collect()}
    assert tiers == {
        "good": "deploy_immediately", "world": "deploy_immediately", "slow": "deploy_with_monitoring", "slower": "do_not_deploy",
    }
    summary = health.health_summary(feeds).first()
    assert (summary.total_tested, summary.passed, summary.failed) == (11, 4, 7)
    assert health.health_summary(feeds.limit(0)).first().success_rate == 0.0
    columns = "source string, region string, http_status int, response_time double, blocked boolean, parsed boolean"
    sites = spark.createDataFrame(
        [("a", "Global", 200, 1.0, False, True), ("b", "Global", 200, 6.0, False, True), ("c", "MENA", 200, 1.0, True, True),
         ("d", "MENA", 200, 1.0, False, True), ("e", "Global", 404, 1.0, False, True), ("f", "Global", 200, 1.0, False, False)], columns)
    links = [(s, f"l{i:02d}", True, i < 7, "oil") for s in "abd" for i in range(12)] + [("f", "x", True, True, "oil")]
    graded = health.site_health(sites, spark.createDataFrame(links, "source string, link string, ok boolean, extracted boolean, text string"))
    got = {r.source: (r.tests_passed, r.status, r.error) for r in graded.collect()}
    assert got == {
        "a": (7, "PASSED", ""), "b": (7, "PASSED", ""), "c": (0, "FAILED", "Anti-bot measures detected"),
        "d": (6, "FAILED", "No MENA relevant articles found"), "e": (0, "FAILED", "HTTP 404"), "f": (2, "FAILED", "HTML parsing failed"),
    }
    site_tiers = {r.source: r.tier for r in health.deploy_tier(graded, "site").collect()}
    assert site_tiers == {"a": "deploy_immediately", "b": "deploy_with_monitoring"}
    cases = spark.createDataFrame([("PASSED",), ("FAILED",)], "status string")
    report = {r.kind: r for r in reports.health_report(feeds, graded, cases).report.collect()}
    assert (report["all"].total_tested, report["all"].passed, report["all"].ready_sources) == (17, 6, 5)
    assert report["all"].detection_accuracy == 50.0 and report["rss"].ready_sources == 3


CASES = [
    ("Nigeria Power", "Lagos plans a solar plant for Nigeria", ["Africa"], ["Africa"]),
    ("Egypt Oil", "Cairo reports an oil find; Egyptian officials agree", ["Africa"], ["MENA"]),
    ("Morocco Solar", "Casablanca hosts a Moroccan fair", ["Africa"], ["MENA"]),
    ("Brazil Wind", "São Paulo builds; the Brazilian state pays", ["Latin America"], []),
    ("Colombia Oil", "Bogotá pumps more, Colombian firms say", ["Latin America"], []),
    ("Mexico Oil", "Mexico City pumps more", ["Latin America"], ["Latin America"]),
    ("Saudi Arabia Oil", "Riyadh sets targets for Saudi Arabia", ["MENA"], ["MENA"]),
    ("Global Summit", "Saudi Arabia, Brazil and South Africa meet", ["MENA", "Latin America", "Africa"], ["Africa", "Latin America", "MENA"]),
    ("No Places", "A company shows a product", [], []),
    ("Too Many", "Gulf news", [], ["MENA"]),
]


def test_detection_cases(spark):
    df = spark.createDataFrame([c[:3] for c in CASES], "name string, text string, expected array<string>")
    done = reports.evaluate_detection(df)
    rows = {r.name: r for r in done.results.collect()}
    assert {n: rows[n].detected for n, *_ in CASES} == {c[0]: c[3] for c in CASES}
    failed = {n for n, r in rows.items() if r.status == "FAILED"}
    assert failed == {"Egypt Oil", "Morocco Solar", "Brazil Wind", "Colombia Oil"}
    assert rows["Too Many"].false_positives == ["MENA"]
    buckets = {r.bucket: (r.passed, r.failed, r.total) for r in done.accuracy.collect()}
    assert buckets == {"Edge cases": (3, 3, 6), "Latin America": (1, 1, 2), "MENA": (1, 0, 1), "Multi-continent": (1, 0, 1)}
    patterns = {(r.kind, r.regions): r.cases for r in done.patterns.collect()}
    assert patterns == {("missing", "Africa"): 2, ("missing", "Latin America"): 2, ("false_positive", "MENA"): 2}


def test_region_lexicon_last_entry_wins(spark):
    entries = [("egypt", "Africa"), ("Kenya", "Africa"), ("egypt", "MENA")]
    assert lex.region_lexicon(entries) == {"MENA": ["egypt"], "Africa": ["kenya"]}
    rows = [(t, r, i) for i, (t, r) in enumerate(entries)]
    for shuffled in (rows, rows[::-1], rows[1:] + rows[:1]):
        table = spark.createDataFrame(shuffled, "term string, region string, position int").repartition(3)
        assert lex.region_lexicon(table) == lex.region_lexicon(entries)
    with pytest.raises(ValueError):
        lex.rows_of(spark.range(5), max_rows=4)


def test_first_n_and_caps(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("source"), "id")
    head = dedup.head_per_source(df, 5, "source", ["id"])
    assert "WindowGroupLimit" in head._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in head.where("source = 'hot'").orderBy("id").collect()] == [0, 3, 6, 9, 12]
    cards = spark.createDataFrame([("Daily News Collection - 2025-11-03", 2), ("Daily News Collection - 2025-11-03!", 1), ("x", 0), ("Daily News Collection - 2025-11-04", 5)], "title string, position int")
    assert [(r.date, r.position) for r in dedup.dedupe_cards(cards).collect()] == [("2025-11-04", 5), ("2025-11-03", 1)]
    order = spark.createDataFrame([("a", "2025-11-03"), ("b", ""), ("c", "2025-11-05T01:00:00+09:00"), ("d", "junk")], "id string, d string")
    wall = D.parse_pub_date(F.col("d"), keep_wall_clock=True)
    assert [r.id for r in dedup.newest_first(order, wall, "id").collect()] == ["c", "a", "b", "d"]


def test_a_lexicon_in_blocks_gives_the_same(spark, sf):
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(-1, "Moody's and the U.S. (supply chain) AÍ"), (-2, "supply chains; moodys"), (-3, None)], "doc_id long, text string")
    )
    rows = [("the", 1), ("Moody's", 2), ("U.S", 3), ("supply chain", 4), ("que", 5), ("zzz", 6), ("aí", 7)]
    lexicon = spark.createDataFrame(rows, "term string, label int")
    scan = sorted(tuple(r) for r in joins.explode_matches(texts, lexicon, "doc_id", "text").collect())
    joined = sorted(tuple(r) for r in joins.explode_matches(texts, lexicon, "doc_id", "text", block=2).collect())
    assert joins.explode_matches(texts, lexicon.limit(0), "doc_id", "text").count() == 0
    assert scan == joined and {t for i, t, _ in scan if i == -1} == {"the", "Moody's", "U.S", "supply chain", "aí"}
    assert not [r for r in scan if r[0] in (-2, -3)]


def test_searches(spark):
    df = spark.createDataFrame(
        [("Oil Up", "RSS Feed", "<b>x</b>", ["Asia"], ["energy"], ["Supply Chain", "oil"], [], "2025-11-03"),
         ("Law", None, None, ["Global"], [], [], ["legislation"], "2025-11-04")],
        "title string, source string, description string, c array<string>, t array<string>, k array<string>, s array<string>, d string",
    ).select("title", "source", "description", F.struct(F.col("c").alias("continents"), F.col("t").alias("core_topics"), F.col("k").alias("matched_keywords"), F.col("s").alias("special_tags")).alias("tags"), F.col("d").cast("date").alias("collection_date"))

    def titles(found):
        return [r.title for r in found.collect()]

    assert titles(search.faceted_search(df)) == ["Oil Up", "Law"]
    assert titles(search.faceted_search(df, source="rss", continent="Asia", topic="energy", keyword="supply ch", term="OIL")) == ["Oil Up"]
    assert titles(search.faceted_search(df, source="unknown", special="legislation")) == ["Law"]
    assert titles(search.faceted_search(df, term="<b>")) == []
    assert titles(search.archive_search(df, term="<B>")) == ["Oil Up"]
    assert titles(search.archive_search(df, date="2025-11-04")) == ["Law"]
    assert titles(search.daily_search(df, keyword="chain,oil")) == ["Oil Up"]
    stats = rollups.date_rollup(df.withColumn("content_length", F.lit(1)))
    assert [r.article_count for r in search.date_search(stats, "11-04").collect()] == [1]
    assert [P.by_special(F.col("tags.special_tags"), "legislation") is not None, df.where(P.by_special(F.col("tags.special_tags"), "legislation")).count()] == [True, 1]


def test_orphans_and_region_default(spark):
    a, b = spark.createDataFrame([("1",), ("2",)], "article_id string"), spark.createDataFrame([("2",), ("3",)], "article_id string")
    assert {tuple(r) for r in joins.orphans(a, b).collect()} == {("1", "content"), ("3", "metadata")}
    sources = spark.createDataFrame([("1", "MENA")], "article_id string, region string")
    assert {r.article_id: r.region for r in joins.with_region(a, sources, "article_id").collect()} == {"1": "MENA", "2": "Global"}
    passes = evaluation.evaluate(spark.createDataFrame([("n", ["a"], ["a", "b"])], "name string, expected array<string>, d array<string>"), F.col("d")).first()
    assert (passes.status, passes.false_positives) == ("PASSED", ["b"])
