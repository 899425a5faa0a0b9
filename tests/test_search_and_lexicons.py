"""The search index, lexicons joined as tables, page fetches and streaks, against plain Python."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from presslake.operators import joins, search, search_index, streaks
from test_plan_shape import plan_of

DAYS = ["2025-11-01", "2025-11-02"]


# ---------------------------------------------------------------------------
# Search index
# ---------------------------------------------------------------------------
def articles(spark, rows):
    df = spark.createDataFrame(rows, "doc_id int, title string, description string, day string")
    return df.select("doc_id", "title", "description", F.col("day").cast("date").alias("collection_date"))


ROWS = [
    (1, "Solar Power", "the EU", DAYS[0]), (2, "a", None, DAYS[0]), (3, "", "", DAYS[1]), (4, None, "İstanbul ÄÖ 😀x", DAYS[1]),
    (5, "solar", "power", DAYS[1]), (6, "aaaa", "aab\n", DAYS[0]), (6, "aaaa", "aab\n", DAYS[0]), (7, "x" * 50_000 + "end", "", DAYS[0]),
]
TERMS = ["solar power", "SOLAR", "a", "aa", "aab", "aaab", "eu", "😀", "😀x", "ä", "ö 😀", "xend", "zzz", "r p", "\n", "b\n", ""]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    df = articles(spark, ROWS)
    assert search_index.append(df.where("doc_id < 5"), path, "one")
    assert search_index.append(df.where("doc_id >= 5"), path, "two")
    assert not search_index.append(df, path, "two")
    return path


def test_search_equals_a_scan(spark, indexed):
    found = search_index.search_terms(spark, indexed, TERMS).select("term", "doc_id", "title", "description").collect()
    scan = articles(spark, ROWS)
    for term in TERMS:
        want = sorted(r["doc_id"] for r in search.archive_search(scan, term=term).collect())
        assert sorted(r["doc_id"] for r in found if r["term"] == term) == want, term
    assert [r["doc_id"] for r in search_index.search(spark, indexed, "power", date=DAYS[1]).collect()] == [5]
    assert search_index.search(spark, indexed, "", date=DAYS[0]).count() == 5


def test_broken_attempts_are_not_shown(spark, indexed):
    """Docs and postings without an entry in the list of batches are those of a run that broke off."""
    other = articles(spark, [(99, "solar", "", DAYS[0])]).withColumn("slot", F.lit(0)).withColumn("block", F.lit("b0-0"))
    other.write.partitionBy("collection_date", "block").parquet(f"{indexed}/docs/attempt=abroken")
    lists = other.select("collection_date", F.lit("sol").alias("gram"), "block", F.array("slot").alias("slots"))
    lists.write.partitionBy("collection_date").parquet(f"{indexed}/postings/attempt=abroken")
    assert {r["doc_id"] for r in search_index.search(spark, indexed, "sol").collect()} == {1, 5}
    assert 99 not in {r["doc_id"] for r in search_index.search(spark, indexed, "").collect()}


def test_search_reads_postings_and_candidate_blocks(spark, indexed):
    plan = plan_of(search_index.search(spark, indexed, "solar"))
    assert "In(gram, [ar" not in plan and "[lar,ola,sol]" in plan.replace(" ", "")
    assert "dynamicpruning" in plan and "CartesianProduct" not in plan
    short = plan_of(search_index.search(spark, indexed, "so"))
    assert "StringStartsWith(gram,so)" in short


# ---------------------------------------------------------------------------
# Lexicons as tables
# ---------------------------------------------------------------------------
LEXICON = ["eu ", "u.s.", "c++", "&", "supply chain", "supply", "chain", "ai", "a", "moody's", " x", "é_1", "the eu (x", "", "--", "a b c d e", "😀", "x😀y"]
TEXTS = [
    "The EU member", "the eu", "the u.s.a. and u.s. c++x c++", "a&b & c", "Supply chain, supply-chain; SUPPLY  chain", "ai-led AI's said",
    "moody's a x b", "É_1 é_12", "the eu (x)", None, "", "a--b -- c", "a b c d e f", "x😀y 😀", "a b c d e a b c d e" * 50,
]


def whole_word(term, text):
    word = r"[^\W]"
    before = rf"(?<!{word})" if re.match(word, term[0]) else rf"(?<={word})"
    after = rf"(?!{word})" if re.match(word, term[-1]) else rf"(?={word})"
    return re.search(before + re.escape(term) + after, (text or "").lower()) is not None


@pytest.mark.parametrize("way", ["scan", "broadcast", "shuffled"])
def test_lexicon_join_equals_whole_word_tests(spark, way):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id int, body string")
    lexicon = spark.createDataFrame([(t, len(t)) for t in LEXICON], "term string, letters int")
    if way == "scan":
        found = joins.explode_matches(texts, lexicon, "id", "body")
    else:
        found = joins.join_matches(texts, lexicon, "id", "body", broadcast_bytes=0 if way == "shuffled" else 1 << 20)
    got = sorted((r["id"], r["term"]) for r in found.collect())
    assert got == sorted((i, t) for i, x in enumerate(TEXTS) for t in LEXICON if t and whole_word(t, x))
    assert found.columns == ["id", "term", "letters"]


def test_large_lexicon_reads_texts_once_and_stays_out_of_the_driver(spark, tmp_path):
    random.seed(5)
    words = ["".join(random.choices("abcdefgh", k=5)) for _ in range(3000)]
    rows = [(i, " ".join(["hot", *random.choices(words, k=30)])) for i in range(300)]
    path = str(tmp_path / "texts")
    spark.createDataFrame(rows, "id int, body string").write.parquet(path)
    terms = sorted({*words, "hot", *(" ".join(random.choices(words, k=2)) for _ in range(500)), "hot " + words[0]})
    lexicon = spark.createDataFrame([(t,) for t in terms], "term string")
    for bound in (1 << 20, 0):
        found = joins.join_matches(spark.read.parquet(path), lexicon, "id", "body", bound)
        plan = plan_of(found)
        assert plan.count("FileScan parquet") == 1 and plan.count("regexp_extract_all") <= 2
        assert ("BroadcastHashJoin" in plan) == (bound > 0)
        want = {(i, t) for i, body in rows for t in terms if f" {t} " in f" {body} "}
        assert {(r["id"], r["term"]) for r in found.collect()} == want
    assert joins.explode_matches(spark.read.parquet(path), lexicon.limit(0), "id", "body").collect() == []
    assert joins.join_matches(spark.read.parquet(path), lexicon.where("term = ''"), "id", "body").collect() == []


def test_latest_fetch_without_times_and_with_ties(spark):
    rows = [("a", "only", None), ("b", "old", 1), ("b", "none", None), ("c", "x", 5), ("c", "y", 5), ("c", "y", 5)]
    pages = spark.createDataFrame(rows, "url string, html string, fetched_at int")
    items = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "url string")
    got = {r["url"]: r["html"] for r in joins.attach_content(items, pages).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"] == "only" and got["b"] == "old" and got["c"] in "xy"
    assert joins.attach_content(items, pages).count() == 3


# ---------------------------------------------------------------------------
# Streaks
# ---------------------------------------------------------------------------
def plain_streaks(rows):
    out = []
    for source in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == source), key=lambda r: (r[1], r[2]))
        last = None
        for _, ts, _, ok in mine:
            ok = bool(ok)
            if last and last[1] == ok:
                last[3], last[4] = ts, last[4] + 1
            else:
                last = [source, ok, ts, ts, 1, last and last[3]]
                out.append(last)
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("seconds", [1, 600, 3600, 10**9])
def test_streaks_over_slices(spark, seconds):
    """A hot source, equal times, slices with one row, long gaps: the same streaks however time is cut."""
    random.seed(3)
    start = datetime(2025, 11, 1)
    rows = [("hot", start + timedelta(minutes=random.randrange(600)), i, random.random() < 0.7) for i in range(400)]
    rows += [("one", start, 1, False), ("gap", start, 1, True), ("gap", start + timedelta(days=9), 2, None), ("gap", start + timedelta(days=9), 3, False)]
    log = spark.createDataFrame(rows, "source string, ts timestamp, fetch_id int, ok boolean")
    got = streaks.feed_streaks(log, seconds).select("source", "ok", "started", "ended", "fetches", "before").collect()
    assert sorted(map(tuple, got), key=repr) == plain_streaks(rows)


def test_broken_feeds(spark):
    now = datetime(2025, 11, 10)
    at = lambda h: now - timedelta(hours=h)
    rows = [("fine", at(2), True), ("fine", at(1), False), ("never", at(3), False), ("quiet", at(100), True)]
    rows += [("down", at(30 - i), i < 5) for i in range(10)] + [("poor", at(20 - i), i % 3 == 2) for i in range(12)]
    log = spark.createDataFrame([(s, t, i, ok) for i, (s, t, ok) in enumerate(rows)], "source string, ts timestamp, fetch_id int, ok boolean")
    got = {r["source"]: r for r in streaks.feed_rates(streaks.feed_streaks(log), now).collect()}
    assert {s: r["reason"] for s, r in got.items()} == {"fine": None, "never": "silent", "quiet": "silent", "down": "streak", "poor": "rate"}
    assert (got["down"]["current_failure"], got["down"]["longest_failure"], got["poor"]["current_failure"]) == (5, 5, 0)
    assert got["never"]["last_success"] is None and got["quiet"]["hours_since_success"] == 100
    assert streaks.feed_rates(streaks.feed_streaks(log.limit(0)), now).collect() == []
