"""What the physical plans must and must not contain, and skewed input."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from presslake.functions import tagging as T
from presslake.operators import dedup, rollups
from presslake.operators.shape import compute_once

STREAMS = {"stream_dedupe", "stream_daily_counts", "store_run"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - STREAMS))
def test_no_pairing_of_all_rows(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["tag_struct_counts", "rss_run", "lexicon_join", "facets"])
def test_text_is_scanned_once(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    # Continents and keywords; tags listed from a page's markup are another matter.
    scans = re.findall(r"regexp_extract_all\(lower\((?!body_html)", plan)
    assert 1 <= len(scans) <= 2, len(scans)


def test_narrow_queries_do_not_read_text(spark, sf):
    for name in ("pending_sources", "source_region", "stream_daily_counts"):
        if name not in STREAMS:
            assert "text:string" not in plan_of(entry.queries()[name](spark, sf))


def test_filter_on_computed_column_keeps_one_evaluation(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("t"))
    kept = compute_once(df, tags=T.matched_keywords(F.col("t"))).where(F.size("tags") > 0)
    assert plan_of(kept).count("regexp_extract_all") == 1


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A third of the rows share one URL; the result is whole and the shuffle small."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("url"), "id"
    ).repartition(8, "id")
    first = dedup.dedupe_urls(df, "id")
    assert first.count() == n - n // 3 + 1 and first.where("url = 'hot'").first().id == 0
    last = dedup.dedupe_urls(df, "id", keep="last")
    assert last.where("url = 'hot'").first().id == n - 3
    plan = plan_of(first)
    # The plan is printed from the top: one row per key and task is left before the exchange by URL.
    cuts = plan.split("Exchange hashpartitioning(url")
    assert len(cuts) == 2 and "WindowGroupLimit" in cuts[1] and "Partial" in cuts[1]
    daily = rollups.daily_stats(
        df.select(F.lit("2025-11-04").cast("date").alias("collection_date"), F.col("url").alias("source"), F.lit(10).alias("content_length"))
    ).first()
    assert (daily.articles, daily.sources, daily.length_k) == (n, n - n // 3 + 1, n * 10 // 1000)
