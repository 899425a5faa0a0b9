"""Page extraction: built-in expressions against the tag reader, and the rules themselves."""

import pytest
from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions import page_reader as R
from presslake.functions import predicates as P

LONG = "word " * 60


def one(spark, html, make, url="https://site.example/a/b?x=1#f"):
    df = spark.createDataFrame([(url, html)], "url string, html string")
    return make(df).first()[-1]


@pytest.mark.parametrize("rule", [H.NEWS_RULE, H.LEGISLATION_RULE, H.HISTORICAL_RULE, H.SITE_CHECK_RULE, H.SITE_TEXT_RULE])
def test_built_ins_agree_with_reader_on_all_pages(spark, sf, rule):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = H._plain_article(pages, "html", rule, "fast").collect()
    assert sum(r.fast is not None for r in rows) == len(rows)
    assert all(r.fast == R.main_text(r.html, rule) for r in rows)


PAGES = {
    "plain": f"<article><p> {LONG}</p> <p>x &amp; y</p></article>",
    "nested": f"<article>a<article>{LONG}</article>b</article>",
    "unbalanced": f"<div><article>{LONG}</div>after</article>",
    "rare entity": f"<article>{LONG}&eacute;</article>",
    "bare entity": f"<article>{LONG}a&amp<b>c &ampx &am d&copyright; &#233;</b></article>",
    "attribute": f'<article><a title="x > y">{LONG}</a></article>',
    "comment": f"<article>a<!-- <article> -->{LONG}</article>",
    "nav inside": f"<article><nav>menu</nav>{LONG}</article>",
    "open nav": f"<nav>menu<article>{LONG}</article>",
    "by class": f'<div class="x content">{LONG}<div>in</div></div>',
    "by module": f'<div data-module="ArticleBody">{LONG}</div>',
    "main": f"<main>{LONG}</main>",
    "short article, long main": f"<article>short</article><main>{LONG}</main>",
    "paragraphs": f"<p>{LONG}</p><p> </p><p>end</p>",
    "script only": "<script>var t='<p>no</p>'</script>",
    "nothing": "",
    "less than": f"<article>1 < 2 {LONG}</article>",
    "blanks": f"<article>  {LONG}&nbsp;<b> z</b></article>",
}


@pytest.mark.parametrize("rule", [H.NEWS_RULE, H.LEGISLATION_RULE, H.HISTORICAL_RULE, H.SITE_TEXT_RULE])
def test_pages_of_all_shapes_read_like_the_element_tree(spark, rule):
    df = spark.createDataFrame([("u", name, page) for name, page in PAGES.items()], "url string, name string, html string")
    for row in H.extract_text(df, rule).collect():
        want = R.main_text(row.html, rule)
        want = want if want is not None and len(want) > rule.min_chars else None
        assert row.content == want, row.name


def test_news_rule(spark):
    text = {n: one(spark, p, H.extract_news) for n, p in PAGES.items()}
    flat = LONG.strip()
    assert text["plain"] == flat + "x & y"
    assert text["nested"] == "a" + flat + "b"
    assert text["unbalanced"] == flat
    assert text["rare entity"] == LONG + "é"
    assert text["nav inside"] == flat
    assert text["bare entity"] == LONG + "a&c &ampx &am d&copyright é"
    assert text["open nav"] is None
    assert text["by class"] == flat + "in"
    assert text["short article, long main"] == flat
    assert text["paragraphs"] == flat + "\nend"
    assert text["blanks"] == flat + "z"
    assert text["nothing"] is None and text["script only"] is None


def test_legislation_rules(spark):
    law = "<body><script>x</script><div id='content'>First<p>Second</p></div></body>"
    assert one(spark, law, H.extract_legislation) == "First\nSecond"
    assert one(spark, "<body> <p>only</p>body</body>", H.extract_legislation) == "only\nbody"
    assert one(spark, "bare text", H.extract_legislation) == "bare text"
    assert one(spark, "<body><style>p{}</style></body>", H.extract_legislation) is None
    senate = "<div id='materia'><h1> T </h1><div id='textoMateria'>A<p>B</p></div></div>"
    got = one(spark, senate, H.extract_content, url="https://www12.senado.leg.br/n/1")
    assert got == "<body><div class='senado-content'><h1>T</h1><div id='textoMateria'>A\nB</div></div></body>"
    assert one(spark, "<main>other</main>", H.extract_content, url="https://www12.senado.leg.br/n/1") == "other"
    kept = one(spark, "<main><p class=a>x</p><script>s</script></main>", H.extract_historical)
    assert kept == "<main><p class=a>x</p></main>"


def test_bill_rule(spark):
    long = "<bill>" + "x" * 1000 + "</bill>"
    page = "<html><body class='b'>" + "y" * 1000 + "</body></html>"
    df = spark.createDataFrame(
        [(1, long, page), (2, "<bill/>", page), (3, None, "<body>short</body>"), (4, None, None)], "id int, x string, h string"
    )
    got = {r.id: r.b for r in df.select("id", H.extract_bill(F.col("x"), F.col("h")).alias("b")).collect()}
    assert got[1] == f"<body><div class='govinfo-content'>{long}</div></body>"
    assert got[2] == "<body class='b'>" + "y" * 1000 + "</body>"
    assert got[3] is None and got[4] is None


def test_title_and_date(spark):
    pages = [
        ("<title> A &amp; <b>B</b> </title><h1>h</h1>", "A & B", "Unknown"),
        ("<h1>h <i>1</i></h1><time>May 1</time>", "h 1", "May 1"),
        ("<p>none</p><span class='x'></span>", "No Title", "Unknown"),
        ("<title>it&#8217;s caf&eacute; A&ampB R&amp</title>", "it’s café A&ampB R&", "Unknown"),
        ('<title></title><div class="post-date late">5 May</div>', "", "5 May"),
        ('<b class="publish-date">p</b><time datetime="2025-01-02">t</time>', "No Title", "2025-01-02"),
        ("<time datetime=''>shown</time>", "No Title", "shown"),
        ('<b class="my-post-date">no</b>', "No Title", "Unknown"),
    ]
    df = spark.createDataFrame(pages, "html string, title string, date string")
    for r in df.select("*", H.page_title(F.col("html")).alias("t"), H.page_date(F.col("html")).alias("d")).collect():
        assert (r.t, r.d) == (r.title, r.date), r.html


def test_links(spark):
    html = (
        '<a href="/news/1">a</a><a href="https://o.example/story/2">b</a><a href="/plain">c</a>'
        "<h2><a href='//cdn.example/x/3'>d</a></h2><h3><a href=rel/4>e</a></h3>"
        '<div class="story-link"><p><a href="/deep?a=1&amp;b=2">f</a></p></div><script>"<a href=\'/news/no\'>"</script>'
        '<a href="/news/1">again</a><a href="mailto:x/news/y">m</a>'
    )
    found = one(spark, html, lambda d: d.select(H.discover_links(F.col("url"), F.col("html"))))
    assert found == [
        "https://cdn.example/x/3", "https://o.example/story/2", "https://site.example/deep?a=1&b=2",
        "https://site.example/news/1",
    ]
    assert one(spark, html, lambda d: d.select(H.discover_links(F.col("url"), F.col("html"), 2))) == found[:2]
    tester = one(spark, html, lambda d: d.select(H.discover_article_links(F.col("url"), F.col("html"))))
    assert tester == ["https://o.example/story/2", "https://site.example/news/1", "mailto:x/news/y"]


def test_resolve_url(spark):
    base = "https://h.example/a/b?q=1#f"
    cases = {
        "/x": "https://h.example/x", "c": "https://h.example/a/c", "//o.example/y": "https://o.example/y",
        "?z=2": "https://h.example/a/b?z=2", "http://p/": "http://p/", "#g": "https://h.example/a/b?q=1#g",
    }
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    got = {r.h: r.u for r in df.select("h", H.resolve_url(F.lit(base), F.col("h")).alias("u")).collect()}
    assert got == cases


def test_page_filters(spark):
    df = spark.createDataFrame([("Please WAIT",), ("fine",), (None,)], "h string")
    assert [r[0] for r in df.select(P.is_blocked(F.col("h"))).collect()] == [True, False, False]
    urls = {"https://a/news/1": True, "https://a/TAG/x/news/": False, "https://a/about": False, "https://a/May/": True}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.ok for r in df.select("u", P.is_article_url(F.col("u")).alias("ok")).collect()} == urls


def test_links_of_unclosed_headings_and_dot_segments(spark):
    page = '<div><h2>Title</div><p><a href="/about">a</a></p><h2><a href="/real">b</a></h2><a href="../news/1">c</a>'
    df = spark.createDataFrame([("https://h.org/a/b", page)], "url string, html string")
    links = df.select(H.discover_links(F.col("url"), F.col("html"))).first()[0]
    assert "https://h.org/about" not in links and "https://h.org/real" in links
    cases = {
        "../news/1": "https://h.org/news/1", "./x/./y": "https://h.org/a/x/y", "/p/../../q?r=/../s": "https://h.org/q?r=/../s",
        "..": "https://h.org/", "d/..": "https://h.org/a/", "https://o.org/./a/b/../c/": "https://o.org/a/c/", "plain": "https://h.org/a/plain",
        "file.tar..gz": "https://h.org/a/file.tar..gz",
    }
    rows = spark.createDataFrame(list(cases.items()), "href string, want string")
    for r in rows.select("want", H.resolve_url(F.lit("https://h.org/a/b"), F.col("href")).alias("got")).collect():
        assert r.got == r.want


def test_dates_in_all_quotings_but_not_in_scripts(spark):
    cases = {
        "<span class='publish-date'>3 May</span>": "3 May", "<p class=post-date>4 May</p>": "4 May",
        "<script>'<time datetime=\"1999\">'</script><b class=\"x article-date\">5 May</b>": "5 May",
        "<!-- <time>1998</time> --><time>6 May</time>": "6 May", "<span class='not-publish-date'>7</span>": "Unknown",
    }
    df = spark.createDataFrame(list(cases.items()), "html string, want string")
    for r in df.select("want", H.page_date(F.col("html")).alias("got")).collect():
        assert r.got == r.want


def test_dates_in_nested_elements(spark):
    pages = [
        ("5 May", '<div class="publish-date"><div>5</div> May</div><div>x</div>'),
        ("5 May 2025", '<DIV class="article-date"><div><div>5</div> May</div> 2025</DIV> tail</div>'),
        ("now", '<time>now<b>!</b></time>'.replace("<b>!</b>", "")),
        ("a b", '<span datetime=""><span>a</span> b</span>'),
        ("2025", '<p datetime="2025"><p>x</p></p>'),
        ("open", '<div class=post-date>open</div>'),
    ]
    df = spark.createDataFrame(pages, "want string, html string")
    for r in df.select("want", H.page_date(F.col("html")).alias("got")).collect():
        assert r.got == r.want
