"""Copies across URLs, quality scores, incremental rollups, cut feeds and site rules, against plain Python."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.functions import site_rules
from presslake.operators import copies, quality, rollup_store, rollups
from presslake.sources import feeds


# ---------------------------------------------------------------------------
# Copies
# ---------------------------------------------------------------------------
def test_exact_copies_of_a_hot_text(spark):
    rows = [(i, "Same  Words, here") for i in range(300)] + [(900, "same words here!"), (901, "other"), (902, None), (903, ""), (904, " . ")]
    got = {r["id"]: (r["copy_of"], r["copies"]) for r in copies.exact_copies(spark.createDataFrame(rows, "id int, t string"), "id", "t").collect()}
    assert got[5] == got[900] == (0, 301) and got[901] == (901, 1) and got[902] == got[903] == got[904] == (902, 3)


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def test_simhash_is_the_majority_of_the_shingles(spark):
    texts = ["one two three four five", "a b", "", "word " * 5000, "x y z x y z x y z"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r["id"]: r["simhash"] for r in copies.simhashes(df, "id", "t").collect()}
    assert 2 not in got
    for i, text in enumerate(texts):
        words = text.split()
        shingles = [" ".join(words[j : j + 3]) for j in range(max(1, len(words) - 2))] if words else []
        if not shingles:
            continue
        hashes = [r[0] for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
        want = sum(1 << b for b in range(64) if sum(1 if (h >> b) & 1 else -1 for h in hashes) > 0)
        assert got[i] == signed(want)


def all_pairs(values):
    u = np.unique(np.array(values, dtype=np.int64))
    return {
        (int(u[i]), int(u[i + 1 + j]))
        for i in range(len(u))
        for j in np.flatnonzero(np.bitwise_count((u[i + 1 :] ^ u[i]).view(np.uint64)) <= copies.MAX_BITS)
    }


def test_near_hashes_against_all_pairs(spark):
    """Pairs at every distance, bits flipped anywhere, also the sign: all that are near are found."""
    random.seed(11)
    values = []
    for _ in range(400):
        base = random.getrandbits(64)
        values.append(base)
        for bits in (1, 2, 3, 4):
            values.append(base ^ sum(1 << b for b in random.sample(range(64), bits)))
    values = [signed(v) for v in values]
    got = {(r["a"], r["b"]) for r in copies.near_hashes(spark.createDataFrame([(v,) for v in values], "simhash long")).collect()}
    want = all_pairs(values)
    assert got <= want and len(got) >= 0.99 * len(want)


def test_crowded_hashes(spark):
    """Hundreds of hashes around one: pairs are not all listed, but nearly every hash finds one near it."""
    random.seed(12)
    base = random.getrandbits(64)
    values = {signed(base ^ sum(1 << b for b in random.sample(range(64), random.randrange(1, 4)))) for _ in range(600)}
    got = {(r["a"], r["b"]) for r in copies.near_hashes(spark.createDataFrame([(v,) for v in values], "simhash long")).collect()}
    want = all_pairs(list(values))
    assert got <= want
    linked, linkable = {x for p in got for x in p}, {x for p in want for x in p}
    assert len(linked) >= 0.9 * len(linkable)
    assert len(got) <= 16 * (copies.NEIGHBOURS + 1) * len(values)


def test_near_copies_name_the_first(spark):
    random.seed(2)
    text = " ".join(random.choices([f"w{i}" for i in range(500)], k=400))
    rows = [(3, text), (1, text.upper()), (7, text + " w1 w2"), (9, " ".join(random.choices("abcdefgh", k=300)))]
    got = {r["id"]: r for r in copies.near_copies(spark.createDataFrame(rows, "id int, t string"), "id", "t").collect()}
    assert got[1]["copy_of"] == got[3]["copy_of"] == 1 and got[9]["near"] is None
    if got[7]["simhash"] != got[1]["simhash"]:
        assert got[7]["near"] == 1 and 0 < got[7]["bits"] <= 3


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------
@pytest.mark.parametrize("seed", range(4))
def test_auc_equals_sql_on_the_same_scores(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(float(rng.integers(0, (3, 1000, 1, 10**9)[seed])) / 7, int(rng.random() < 0.3)) for _ in range(800)] + [(None, 1), (1.0, None)]
    got = quality.auc(spark.createDataFrame(rows, "score double, label int")).first()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (s DOUBLE, l INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    p, n, wins = con.execute(
        """SELECT count(*) FILTER (l = 1), count(*) FILTER (l = 0), (SELECT sum(CASE WHEN a.s > b.s THEN 1 WHEN a.s = b.s THEN 0.5 ELSE 0 END)
        FROM t a, t b WHERE a.l = 1 AND b.l = 0) FROM t WHERE s IS NOT NULL"""
    ).fetchone()
    assert (got["positives"], got["negatives"]) == (p, n) and got["auc"] == round(float(wins) / (p * n), 6)


def test_auc_without_rows_of_both_kinds(spark):
    assert quality.auc(spark.createDataFrame([(0.5, 1)], "score double, label int")).first()["auc"] is None
    assert tuple(quality.auc(spark.createDataFrame([], "score double, label int")).first()) == (0, 0, None)


def test_a_fitted_model_ranks_held_out_texts(spark, sf):
    base = sf.replace("sf0.001", "sf0.01")
    texts = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    rows = quality.features(texts, "text").join(labels, "doc_id").withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(2)))
    model = quality.fit_quality(rows.where("fold = 0"))
    held_out = quality.model_score(rows.where("fold = 1"), model)
    assert quality.auc(held_out, label="quality").first()["auc"] > 0.95
    null = quality.features(spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string"), "text")
    assert quality.model_score(null, model).where("score IS NOT NULL").count() == 2


def test_a_model_is_fitted_on_all_labelled_rows(spark):
    n = 250_000
    label = F.when(F.col("id") < n, (F.col("id") % 7 > 2).cast("int"))
    rows = spark.range(n + 10).select(*[(F.col("id") % (n - i)).cast("double").alias(name) for i, name in enumerate(quality.FEATURES)], label.alias("quality"))
    _, scaler, logistic = quality.fit_quality(rows).stages
    assert logistic.summary.predictions.count() == n
    mean = rows.where("quality IS NOT NULL").agg(*[F.avg(name) for name in quality.FEATURES]).first()
    assert np.allclose(scaler.mean, mean, rtol=1e-9)


# ---------------------------------------------------------------------------
# Incremental rollups
# ---------------------------------------------------------------------------
def test_rollups_batch_by_batch_equal_those_of_all(spark, tmp_path):
    random.seed(4)
    rows = [
        (f"2025-11-{random.randrange(1, 5):02d}", random.choice([None, "a", "b", *(f"s{i}" for i in range(40))]), random.randrange(2000),
         random.sample(["oil", "gas", "solar power", "ai"], random.randrange(4)), i % 3)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "d string, source string, content_length int, k array<string>, part int")
    df = df.select(F.col("d").cast("date").alias("collection_date"), "source", "content_length", F.struct(F.col("k").alias("matched_keywords")).alias("tags"), "part")
    path = str(tmp_path / "rollups")
    for part in (0, 1, 2, 1):
        rollup_store.add_batch(df.where(F.col("part") == part), path, f"p{part}")
    assert rollup_store.archive_totals(spark, path).collect() == rollups.archive_totals(df).collect()
    stats = rollups.daily_stats(df).join(rollups.keyword_count(df), "collection_date").orderBy("collection_date")
    assert rollup_store.daily_stats(spark, path).orderBy("collection_date").collect() == stats.collect()
    assert sorted(rollup_store.card_stats(spark, path).collect()) == sorted(rollups.card_stats(df).collect())
    assert rollup_store.facets(spark, path).collect() == rollups.facets(df).select("facet", "value", "label").collect()
    day = df.where("collection_date = DATE '2025-11-02'")
    assert rollup_store.facets(spark, path, ["2025-11-02"]).collect() == rollups.facets(day).select("facet", "value", "label").collect()
    plan = rollup_store.archive_totals(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "content_length" not in plan


# ---------------------------------------------------------------------------
# Cut feeds and site rules
# ---------------------------------------------------------------------------
WHOLE = (
    "<rss><channel><title>c</title><item><title>one</title><link>u1</link></item><item><title>A &amp; two</title><link>u2</link>"
    "<description><![CDATA[some <b>bold</b> text]]></description><pubDate>Mon</pubDate></item></channel></rss>"
)


def test_a_feed_may_end_anywhere(spark):
    """Whatever is cut off, the first item stays and the second has a beginning of its fields, growing with the cut."""
    docs = spark.createDataFrame([(i, WHOLE[:i]) for i in range(WHOLE.index("one"), len(WHOLE) + 1)], "cut int, xml string")
    items = feeds.normalize_items(feeds.explode_feed(docs, keep_cut=True)).select("cut", "item_pos", "title", "link", "description").collect()
    by_cut = {}
    for r in items:
        by_cut.setdefault(r["cut"], []).append(r)
    first_end, second_title = WHOLE.index("</item>") + 7, WHOLE.index("A &amp;")
    for cut in range(WHOLE.index("one") + 1, len(WHOLE) + 1):
        got = sorted(by_cut.get(cut, []), key=lambda r: r["item_pos"])
        assert got and "one".startswith(got[0]["title"]) , (cut, got)
        if cut >= first_end:
            assert (got[0]["title"], got[0]["link"]) == ("one", "u1")
        if cut > second_title + 1:
            assert len(got) == 2 and "A & two".startswith(got[1]["title"].rstrip()), (cut, got)
        if cut >= WHOLE.index("<description>"):
            assert (got[1]["title"], got[1]["link"]) == ("A & two", "u2")
        if cut >= WHOLE.index("bold"):
            assert got[1]["description"].startswith("some ")


def test_site_rules_choose_the_longest_domain(spark):
    rules = spark.createDataFrame(
        [("x.org", [".a"], ["b"], " ", 0), ("news.x.org", ["#m", "main"], [], "", 2), ("y.org", [".none"], [], "", 0), ("org", ["p"], [], "", 0)],
        site_rules.RULES,
    )
    page = "<html><p>para</p><div class='a'>A<b>x</b>a</div><div id='m'>m</div><main>main text</main><article>article</article></html>"
    urls = ["https://x.org/1", "http://WWW.x.org:80/1", "https://deep.news.x.org/", "https://y.org/q", "https://z.org", "https://nox.com/x.org", "ftp://u@x.org/", "none", None]
    pages = spark.createDataFrame([(u, page) for u in urls] + [("https://x.org/null", None)], "url string, html string")
    got = {r["url"]: (r["extractor"], r["content"]) for r in site_rules.extract_by_site(pages, rules).collect()}
    assert got["https://x.org/1"] == got["http://WWW.x.org:80/1"] == got["ftp://u@x.org/"] == ("site", "A a")
    assert got["https://deep.news.x.org/"] == ("site", "main text")
    assert got["https://y.org/q"] == got["https://nox.com/x.org"] == got["none"] == got[None] == ("generic", "article")
    assert got["https://z.org"] == ("site", "para") and got["https://x.org/null"] == (None, None)
