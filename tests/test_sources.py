"""Feeds, markets, legacy articles, dates and text expressions on literal files."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from presslake.functions import dates as D
from presslake.functions import text as X
from presslake.operators import dedup
from presslake.operators import markets as M
from presslake.sources import feeds, tables

RSS = """<?xml version="1.0"?><rss xmlns:atom="http://www.w3.org/2005/Atom"><channel><title>c</title>
<atom:link href="https://self"/><item><title>A &amp; B</title><atom:link href="https://no"/><link>https://a/1</link>
<pubDate>Mon, 03 Nov 2025 10:00:00 GMT</pubDate><description></description><summary>unused</summary></item>
<item><link href=""/><title/></item><item><description> d </description><link>https://a/3</link><updated>u</updated></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="text">T</title><link href="https://b/1" rel="alternate"/>
<link href="https://b/2"/><published>p</published><updated>u</updated><content type="html">&lt;p&gt;c</content></entry></feed>"""
RDF = """<rdf:RDF xmlns:rdf="r"><channel><title>x</title></channel><item><title>R</title><link>https://c/1</link></item></rdf:RDF>"""


def test_feeds(spark, tmp_path):
    for name, body in {"rss": RSS, "atom": ATOM, "rdf": RDF, "bad": "<rss><chan", "empty": "<rss/>"}.items():
        (tmp_path / f"{name}.xml").write_text(body)
    documents = feeds.read_feeds(spark, str(tmp_path))
    items = feeds.normalize_items(feeds.explode_feed(documents))
    got = sorted((r.feed_url.split("/")[-1], r.item_pos, r.title, r.link, r.pub_date, r.description) for r in items.collect())
    assert got == [
        ("atom.xml", 0, "T", "https://b/1", "p", "<p>c"),
        ("rdf.xml", 0, "R", "https://c/1", "", ""),
        ("rss.xml", 0, "A & B", "https://a/1", "Mon, 03 Nov 2025 10:00:00 GMT", ""),
        ("rss.xml", 1, "", "", "", ""),
        ("rss.xml", 2, "No Title", "https://a/3", "u", " d "),
    ]


MARKETS = [
    {"id": "1", "question": "Vote?", "volume": "10.5", "liquidity": "", "outcomes": '["Yes","No"]', "outcomePrices": '["0.615","x"]', "closed": False, "slug": "s1", "startDate": "2025-01-01"},
    {"id": "2", "question": "Rain?", "volume": 1234567, "outcomes": ["Yes", "No", "Maybe"], "outcomePrices": ["0.5"], "createdAt": "c"},
    {"id": "3", "question": "Closed vote?", "volume": "99", "closed": True},
    {"id": "4", "category": "US Elections", "volume": None, "closed": False},
]


def test_markets(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps(MARKETS))
    df = M.market_stats(M.market_keys(tables.read_markets(spark, str(tmp_path))))
    rows = {r.id: r for r in df.collect()}
    assert set(rows) == {"1", "2", "4"}
    assert (rows["1"].volume_usd, rows["1"].liquidity_usd, rows["2"].volume_shown) == (10.5, 0.0, "$1,234,567")
    assert (rows["2"].url, rows["1"].url) == ("https://polymarket.com/event/2", "https://polymarket.com/event/s1")
    assert (rows["1"].pub_date, rows["2"].pub_date, rows["4"].pub_date) == ("2025-01-01", "c", "")
    assert (rows["4"].title, rows["4"].volume_usd, rows["4"].category_shown, rows["1"].category_shown) == ("Unknown Market", 0.0, "US Elections", "N/A")
    outcomes = sorted(tuple(r) for r in M.market_outcomes(df).collect())
    assert [(o[0], o[2], o[4]) for o in outcomes] == [("1", "Yes", "61.5%"), ("1", "No", "N/A"), ("2", "Yes", "50.0%")]
    # The cut comes before the filter: the largest open market is not political.
    assert M.political_markets(dedup.top_markets(df, 1)).count() == 0
    assert {r.id for r in M.political_markets(df).collect()} == {"1", "4"}


def test_legacy_articles(spark, tmp_path):
    for folder, name, body in [
        ("2025-11-03/rss/metadata", "a", {"title": "A", "url": "u1", "pub_date": "", "collection_date": "2025-11-03T01:02:03", "tags": {"special_tags": []}}),
        ("2025-11-03/direct/metadata", "b", {"title": "B", "url": "u2", "date": "d", "collection_date": "2025-11-03T01:02:03"}),
        ("2025-11-03/metadata", "c", {"title": "C", "url": "u3", "collection_date": "x", "tags": {"special_tags": ["legislation"]}}),
        ("2025-11-03/rss/content", "d", {"title": "D", "url": "u4"}),
    ]:
        path = tmp_path / folder
        path.mkdir(parents=True, exist_ok=True)
        (path / f"{name}.json").write_text(json.dumps(body, indent=2))
    (tmp_path / "2025-11-03/rss/metadata/bad.json").write_text("{broken")
    got = sorted((r.url, r.origin, str(r.collection_date)) for r in tables.read_legacy_articles(spark, str(tmp_path)).collect())
    assert got == [("u1", "rss", "2025-11-03"), ("u2", "direct", "2025-11-03"), ("u3", "legislation", "2025-11-03")]


def test_dates(spark):
    now = datetime(2025, 11, 4, 10)
    # text, instant, recent within a day, strict year, recent entry
    cases = [
        ("Mon, 03 Nov 2025 10:00:00 GMT", "2025-11-03 10:00:00", True, True, True),
        ("Mon, 03 Nov 2025 09:59:59 +0000", "2025-11-03 09:59:59", False, True, True),
        ("2025-11-03T12:30:00+02:00", "2025-11-03 10:30:00", True, True, True),
        ("2025-11-03T08:00:00.250Z", "2025-11-03 08:00:00", False, True, True),
        ("Mon, 03 Nov 2014 10:00:00 GMT", "2014-11-03 10:00:00", False, False, False),
        ("Sun, 2 Nov 2008 10:00 -0530", "2008-11-02 15:30:00", False, False, False),
        ("November 4, 2025 at 9:15 AM", "2025-11-04 09:15:00", True, True, True),
        ("Nov 3, 2025 9:15 p.m. EST", "2025-11-03 21:15:00", True, True, True),
        ("2025-11-03 12:05 AM", "2025-11-03 00:05:00", False, True, True),
        ("Nov 4, 2025", "2025-11-04 00:00:00", True, True, True),
        ("4 Nov 2025 07:00 EST", "2025-11-04 07:00:00", True, True, True),
        ("2025-10-28 10:00:00", "2025-10-28 10:00:00", False, True, False),
        ("", None, True, True, False),
        (None, None, True, True, False),
        ("garbage", None, True, True, False),
        ("order 1999 x", None, False, True, False),
        ("in 2031", None, True, True, False),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "d string")
    d = F.col("d")
    rows = df.select(
        "d", D.parse_pub_date(d).cast("string").alias("i"), D.recent(d, now).alias("r"),
        D.year_filter(d, strict=True).alias("y"), D.entry_recent(d, now).alias("e"), D.year_filter(d).alias("all"),
    ).collect()
    got = {r.d: (r.i, r.r, r.y, r.e) for r in rows}
    assert got == {c[0]: c[1:] for c in cases}
    assert all(r.all for r in rows)


def test_display(spark):
    df = spark.createDataFrame([("2025-11-03T20:05:00-05:00",), ("odd",), (None,), ("",)], "d string")
    assert [r[0] for r in df.select(D.display_date(F.col("d"))).collect()] == ["November 03, 2025 at 08:05 PM", "odd", "Unknown", ""]
    row = spark.range(1).select(
        X.clean_description(F.lit("<b>x</b>" * 301)).alias("long"),
        X.clean_description(F.lit("<b>" + "y" * 300)).alias("fits"),
        X.tag_text(F.lit("a"), F.lit(None).cast("string"), F.lit("c")).alias("joined"),
        X.govinfo_links(F.lit("https://www.govinfo.gov/app/details/BILLS-119hr1ih/summary")).alias("bill"),
        X.govinfo_links(F.lit("https://www.govinfo.gov/app/details/")).alias("none"),
        X.content_path(F.lit("market"), F.lit("i")).alias("path"),
        X.title_case(F.lit("Standard & Poor's feed-in ESG x")).alias("label"),
    ).first()
    assert row.long == "x" * 300 + "..." and row.fits == "y" * 300 and row.joined == "a  c"
    assert row.bill.xml_url == "https://www.govinfo.gov/content/pkg/BILLS-119hr1ih/xml/BILLS-119hr1ih.xml"
    assert row.label == "Standard & Poor'S Feed-In Esg X"
    assert row.none.bill_id is None and row.path == "content/i.html"


def test_items_of_damaged_feeds(spark):
    good = "<item><title>First</title><link>https://a/1</link></item>"
    cases = {
        "bare": f"<rss><channel>{good}<item><title>B & C &nbsp; &lt;</title><link>https://a/2</link></item></channel></rss>",
        "tail": f"<rss><channel>{good}<item><title>Second</title><link>https://a/2</li",
        "prefix": f"<rss><channel>{good}<item><dc:x y:z='1'/><title><![CDATA[D & E]]></title><link>https://a/2</link></item></channel></rss>",
        "junk": "no feed at all & more",
        "null": None,
        "fine": f"<rss><channel>{good}<item><title><![CDATA[F & G]]></title><link>https://a/2</link></item></channel></rss>",
    }
    df = spark.createDataFrame(list(cases.items()), "name string, xml string")
    items = feeds.normalize_items(feeds.explode_feed(df)).collect()
    found = {n: [r.title for r in sorted(items, key=lambda r: r.item_pos) if r.name == n] for n in cases}
    assert found == {
        "bare": ["First", "B & C &nbsp; <"], "tail": ["First"], "prefix": ["First", "D & E"], "junk": [], "null": [], "fine": ["First", "F & G"],
    }
    assert {r.name for r in feeds.unreadable(df).collect()} == {"junk", "null"}
