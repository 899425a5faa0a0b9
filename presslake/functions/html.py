"""Titles, dates, links and main text of HTML pages.

Almost every page has one well-formed ``<article>``; its text is cut out with
built-in expressions. Only pages where that could differ from reading the
element tree (nested or missing articles, unbalanced tags, rare entities) are
handed, whole, to the small tag reader in `page_reader`; all others pass NULL
through that step.
"""

from __future__ import annotations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.functions import page_reader
from presslake.functions.match import any_contains, bind
from presslake.functions.page_reader import TextRule
from presslake.operators.shape import compute_once

# Workers get the reader with the task, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(page_reader)

# Blanks as stripped from text ends: as a list, and as a pattern both engines read.
BLANK_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680])) + "".join(
    map(chr, [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
BLANK = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
TAG = r"<[A-Za-z/!?][^>]*>"
BILL_PATH = "govinfo.gov/app/details/"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'")]
RARE_ENTITY = r"&(?!(?:amp|lt|gt|quot|apos|nbsp|#39);)[A-Za-z#]"


# Selectors and dropped elements of each extraction rule.
NEWS_RULE = TextRule(
    selectors=(
        "article", '[data-module="ArticleBody"]', ".article-body", ".story-body",
        ".post-content", ".entry-content", ".content", "main", ".article-content",
    ),
    drop=("script", "style", "nav", "header", "footer", "aside", "ads"),
    enough=200,
    min_chars=100,
    fallback="p",
)
LEGISLATION_RULE = TextRule(
    selectors=(
        "article", ".article-content", ".article-body", ".post-content",
        ".entry-content", "main", "#content", ".content",
    ),
    drop=("script", "style"),
    separator="\n",
)
HISTORICAL_RULE = TextRule(
    selectors=(
        "article", "main", ".article-content", ".post-content", ".entry-content",
        "#content", ".content",
    ),
    drop=("script", "style"),
    as_html=True,
)
SITE_CHECK_RULE = TextRule(
    selectors=(
        "article", ".article-content", ".post-content", ".entry-content",
        ".story-content", ".news-content", ".content", "main",
    ),
    drop=("script", "style"),
    min_chars=200,
)
SITE_TEXT_RULE = TextRule(selectors=SITE_CHECK_RULE.selectors, drop=("script", "style"), strip=False)
# What links to articles carry or stand in, for the collector and for the source checker, and date classes.
LINK_HREF_PARTS = ["/article/", "/news/", "/story/", "/post/", "/blog/"]
LINK_CLASSES = ["article-link", "story-link", "headline"]
TESTER_HREF_PARTS = ["/article", "/news", "/story", "/post", "/entry"]
TESTER_LINK_CLASSES = ["article", "news-item", "story", "post", "headline", "title"]
DATE_CLASSES = ["publish-date", "article-date", "post-date"]


# ---------------------------------------------------------------------------
# Building blocks
# ---------------------------------------------------------------------------
def strip_blanks(column: Column) -> Column:
    return F.trim(column, F.lit(BLANK_CHARS))


def decode_entities(column: Column) -> Column:
    out = F.replace(column, F.lit("&nbsp;"), F.lit("\u00a0"))
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(column.contains("&"), F.replace(out, F.lit("&amp;"), F.lit("&"))).otherwise(column)


@F.pandas_udf(T.StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(page_reader.unescape, na_action="ignore").astype(object)


def decode_text(column: Column) -> Column:
    """All entities; texts with none but the common ones never leave the JVM."""
    rare = column.rlike(RARE_ENTITY)
    return F.coalesce(F.when(~rare, decode_entities(column)), _unescape(F.when(rare, column)))


def cut_elements(html: Column, tags: tuple[str, ...]) -> Column:
    """Comments replaced by ``<!>`` and whole elements of these tags by ``<!tag>``."""
    names = "|".join(tags)
    return F.regexp_replace(html, rf"(?is)<!--.*?-->|<({names})\b[^>]*>.*?</\1\s*>", "<!$1>")


def flat_text(markup: Column, separator: str = "", strip: bool = True) -> Column:
    """Text pieces between tags, each stripped, empty ones dropped, joined by `separator`;
    entities other than blanks are left as they are."""
    spaced = F.when(
        markup.contains("&nbsp;"), F.replace(markup, F.lit("&nbsp;"), F.lit("\u00a0"))
    ).otherwise(markup)
    if not strip:
        return F.regexp_replace(spaced, TAG, "")
    pieces = F.transform(F.split(spaced, TAG), strip_blanks)
    return F.array_join(F.filter(pieces, lambda piece: piece != ""), separator)


def _plain_article(df: DataFrame, html: str, rule: TextRule, into: str) -> DataFrame:
    """Adds text (or markup) of each page's only article, NULL unless built-ins read it exactly."""
    names = "|".join(rule.drop)
    kept = compute_once(df, kept_html=cut_elements(F.col(html), rule.drop))
    one = F.regexp_count("kept_html", F.lit(r"(?i)</?article\b")) == 2
    clear = ~F.col("kept_html").rlike(rf"(?i)</?(?:{names})\b") & ~F.col("kept_html").rlike(
        r"""=\s*(?:"[^"<>]*>|'[^'<>]*>)"""
    )
    group = 0 if rule.as_html else 1
    article = F.regexp_extract("kept_html", r"(?is)<article\b[^>]*>(.*?)</article\s*>", group)
    found = compute_once(kept, body_html=F.when(one & clear, F.nullif(article, F.lit("")))).drop("kept_html")
    # An end tag of an element opened outside would end the article early.
    tags = F.regexp_extract_all(
        F.lower("body_html"), F.lit(r"<(/?(?:p|div|section|main|body|html|table|template))\b"), F.lit(1)
    )
    found = compute_once(found, body_tags=tags)

    def count(name: str) -> Column:
        return F.size(F.filter("body_tags", lambda tag: tag == name))

    others = F.exists("body_tags", lambda t: ~t.isin("p", "/p", "div", "/div", "section", "/section"))
    exact = (count("/p") <= count("p")) & (count("/div") <= count("div"))
    exact = exact & (count("/section") <= count("section")) & ~others
    body = F.col("body_html")
    if rule.as_html:
        # Comments belong to the markup and would be lost here.
        text = F.when(exact & ~body.contains("<!>"), F.regexp_replace(body, rf"(?i)<!(?:{names})>", ""))
    else:
        plain = ~body.contains("&") | ~body.rlike(RARE_ENTITY)
        text = F.when(exact & plain, flat_text(body, rule.separator, rule.strip))
    read = compute_once(found, **{into: text}).drop("body_html", "body_tags")
    return read if rule.as_html else read.withColumn(into, decode_entities(F.col(into)))


def _reader(rule: TextRule):
    @F.pandas_udf(T.StringType())
    def read(html: pd.Series) -> pd.Series:
        return html.map(lambda page: page_reader.main_text(page, rule), na_action="ignore").astype(object)

    return read


def _senate_or_main(rule: TextRule):
    def one(senate: str | None, page: str | None) -> tuple:
        special = None if senate is None else page_reader.senate_text(senate)
        return special, page_reader.main_text(page, rule) if special is None and page is not None else None

    @F.pandas_udf("special string, main string")
    def read(senate: pd.Series, page: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(*pair) for pair in zip(senate, page, strict=True)], columns=["special", "main"], dtype=object)

    return read


def extract_text(df: DataFrame, rule: TextRule, into: str = "content", html: str = "html") -> DataFrame:
    """Adds the main text of each page by a rule; NULL if there is none long enough."""
    plain = _plain_text(df, html, rule)
    read = _reader(rule)(F.when(F.col("plain_text").isNull(), F.col(html)))
    text = compute_once(plain, **{into: F.coalesce("plain_text", read)}).drop("plain_text")
    return text.withColumn(into, F.when(F.char_length(into) > rule.min_chars, F.col(into)))


def _plain_text(df: DataFrame, html: str, rule: TextRule) -> DataFrame:
    """Adds `plain_text`: what built-ins read, NULL where the reader is needed."""
    plain = _plain_article(df, html, rule, "plain_text")
    if rule.enough:
        long = F.char_length("plain_text") > rule.enough
        plain = plain.withColumn("plain_text", F.when(long, F.col("plain_text")))
    return plain


# ---------------------------------------------------------------------------
# Rules by page kind
# ---------------------------------------------------------------------------
def extract_news(df: DataFrame, into: str = "content", html: str = "html") -> DataFrame:
    return extract_text(df, NEWS_RULE, into, html)


def extract_legislation(df: DataFrame, into: str = "content", html: str = "html") -> DataFrame:
    return extract_text(df, LEGISLATION_RULE, into, html)


def extract_historical(df: DataFrame, into: str = "content", html: str = "html") -> DataFrame:
    return extract_text(df, HISTORICAL_RULE, into, html)


def extract_site_text(df: DataFrame, into: str = "text", html: str = "html") -> DataFrame:
    """Adds title and content of each page as the source checker searches them, lower-cased."""
    title = F.coalesce(element_text(F.col(html), "title"), F.lit(""))
    body = F.coalesce(F.col(into), F.lit(""))
    return extract_text(df, SITE_TEXT_RULE, into, html).withColumn(into, F.lower(F.concat(title, F.lit(" "), body)))


@F.pandas_udf(T.StringType())
def _senate_reader(html: pd.Series) -> pd.Series:
    return html.map(page_reader.senate_text, na_action="ignore").astype(object)


def extract_senate(html: Column) -> Column:
    """Title and text of a senate page as one body; NULL unless it has the text element."""
    return _senate_reader(F.when(html.contains("textoMateria"), html))


def extract_bill(xml: Column, html: Column, min_bytes: int = 1000) -> Column:
    """The bill's XML wrapped in a body, else the body of its HTML version."""
    wrapped = F.concat(F.lit("<body><div class='govinfo-content'>"), xml, F.lit("</div></body>"))
    body = F.nullif(F.regexp_extract(html, r"(?is)<body\b.*</body\s*>", 0), F.lit(""))
    return F.coalesce(
        F.when(F.octet_length(xml) > min_bytes, wrapped),
        F.when(F.octet_length(html) > min_bytes, body),
    )


def extract_content(df: DataFrame, rule: TextRule = LEGISLATION_RULE, into: str = "content") -> DataFrame:
    """Bill rule, then senate rule, then the generic one, each falling through when it finds
    nothing. Takes url and html, and bill_xml and bill_html where bills are read."""
    none = F.lit(None).cast("string")
    xml, version = (F.col(c) if c in df.columns else none for c in ("bill_xml", "bill_html"))
    url, html = F.col("url"), F.col("html")
    bill = F.when(url.contains(BILL_PATH), extract_bill(xml, version))
    ruled = compute_once(df, bill_text=bill)
    plain = _plain_text(ruled.withColumn("page_html", F.when(F.col("bill_text").isNull(), html)), "page_html", rule)
    page = F.col("page_html")
    senate = F.when(url.contains("senado.leg.br") & page.contains("textoMateria"), page)
    # Both readers are in one Python step: each step has workers of its own.
    texts = compute_once(plain, texts=_senate_or_main(rule)(senate, F.when(F.col("plain_text").isNull(), page)))
    generic = F.coalesce("plain_text", "texts.main")
    generic = F.when(F.char_length(generic) > rule.min_chars, generic)
    return texts.withColumn(into, F.coalesce("bill_text", "texts.special", generic)).drop("bill_text", "plain_text", "texts", "page_html")


# ---------------------------------------------------------------------------
# Title, date, links
# ---------------------------------------------------------------------------
def element_text(html: Column, tag: str) -> Column:
    """All text of the first such element, stripped; NULL if there is none."""
    found = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    text = strip_blanks(decode_text(F.regexp_replace(found, TAG, "")))
    return F.when(html.rlike(rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>"), text)


def page_title(html: Column) -> Column:
    return F.coalesce(element_text(html, "title"), element_text(html, "h1"), F.lit("No Title"))


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    return decode_entities(F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)]))


def page_date(html: Column) -> Column:
    """First of: any datetime attribute, the known date classes, ``<time>``; else ``Unknown``. Scripts, styles and
    comments hold no dates."""
    return bind(cut_elements(html, ("script", "style")), _date_in)


def _date_in(html: Column) -> Column:
    start = r"(?is)<(\w+)\b[^>]*\s{attr}[^>]*>"
    opening = F.regexp_extract(html, r"(?is)<\w+\b[^>]*\sdatetime\s*=[^>]*>", 0)
    shown = F.nullif(_attribute(opening, "datetime"), F.lit(""))
    date = F.when(opening != "", F.coalesce(shown, _inner(html, start.format(attr="datetime\\s*="))))
    for name in DATE_CLASSES:
        quoted = [rf"{q}(?:[^{q}]*\s)?{name}(?:\s[^{q}]*)?{q}" for q in ('"', "'")]
        pattern = start.format(attr=rf"class\s*=\s*(?:{'|'.join(quoted)}|{name}(?=[\s/>]))")
        date = date.when(html.rlike(pattern + r".*?</\1\s*>"), _inner(html, pattern))
    time = r"(?is)<(time)\b[^>]*>"
    date = date.when(html.rlike(time + r".*?</time\s*>"), _inner(html, time))
    return F.coalesce(F.nullif(date, F.lit("")), F.lit("Unknown"))


def _inner(html: Column, start: str) -> Column:
    """Text of the element whose start tag is the first to match (its name is group 1), up to its own end tag."""
    opening, name = F.regexp_extract(html, start, 0), F.lower(F.regexp_extract(html, start, 1))

    def inside(behind: Column) -> Column:
        # Of the tags of this name that follow, the one that closes the element: as many end tags as start tags.
        marks = F.regexp_extract_all(behind, F.concat(F.lit("(?is)<(/?)"), name, F.lit(r"\b[^>]*>")), F.lit(1))
        seen = F.aggregate(
            marks,
            F.struct(F.lit(1).alias("open"), F.lit(0).alias("ends")),
            lambda s, mark: F.when(s["open"] == 0, s)
            .when(mark == "/", F.struct((s["open"] - 1).alias("open"), (s["ends"] + 1).alias("ends")))
            .otherwise(F.struct((s["open"] + 1).alias("open"), s["ends"].alias("ends"))),
        )
        ends = F.regexp_replace(behind, F.concat(F.lit("(?i)</"), name, F.lit(r"\s*>")), F.lit("\u0000"))
        parts = F.split(ends, "\u0000")
        return F.array_join(F.slice(parts, 1, F.greatest(seen["ends"], F.lit(1))), "")

    behind = F.substr(html, F.instr(html, opening) + F.char_length(opening))
    return decode_entities(F.regexp_replace(bind(behind, inside), TAG, ""))


def resolve_url(base: Column, href: Column) -> Column:
    """`href` as seen from the page `base`."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    host = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    page = F.regexp_extract(base, r"^[^?#]*", 0)
    folder = F.when(page == host, F.concat(host, F.lit("/"))).otherwise(
        F.regexp_extract(page, r"^.*/", 0)
    )
    resolved = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(host, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^[^#]*", 0), href))
        .when(href == "", base)
        .otherwise(F.concat(folder, href))
    )
    return bind(resolved, without_dots)


def without_dots(url: Column) -> Column:
    """A URL without the path segments ``.`` and ``..``, so that a page has one URL however it is linked."""
    parts = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)(/[^?#]*)(.*)$"
    part = lambda n: F.regexp_extract(url, parts, n)
    segments = F.split(F.substr(part(2), F.lit(2)), "/")
    none = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        none,
        lambda path, s: F.when(s == "..", F.slice(path, 1, F.greatest(F.size(path) - 1, F.lit(0))))
        .when(s == ".", path)
        .otherwise(F.concat(path, F.array(s))),
    )
    folder = F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    shorter = F.concat(part(1), F.lit("/"), F.array_join(kept, "/"), folder, part(3))
    return F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/(?:[^?#]*/)?\.{1,2}(?:[/?#]|$)"), shorter).otherwise(url)


ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+)"""


def _hrefs(markup: Column) -> Column:
    anchors = F.regexp_extract_all(markup, F.lit(ANCHOR), F.lit(0))
    return F.transform(anchors, lambda anchor: _attribute(anchor, "href"))


def link_hrefs(html: Column, href_parts: list[str], classes: list[str]) -> Column:
    """hrefs of links that carry one of the parts, or stand in a heading or in an element
    of one of the classes."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: page_reader.links_within(p, classes), na_action="ignore").astype(object)

    names = "|".join(classes)
    headings = r"(?is)<h([1-3])\b[^>]*>.*?</h\1\s*>"
    has_class = html.rlike(rf"""(?i)\bclass\s*=\s*["']?[^"'>]*\b(?:{names})\b""")
    even = F.regexp_count(html, F.lit(r"(?i)<h[1-3]\b")) == F.regexp_count(html, F.lit(headings))
    plain = ~has_class & even

    def collect(kept: Column) -> Column:
        by_href = F.filter(_hrefs(kept), lambda h: any_contains(h, href_parts))
        in_headings = _hrefs(F.array_join(F.regexp_extract_all(kept, F.lit(headings), F.lit(0)), " "))
        # Where headings do not close, only the reader knows what stands in them.
        return F.when(plain, F.concat(by_href, in_headings)).otherwise(by_href)

    within = read(F.when(~plain, html))
    nested = F.coalesce(within, F.array().cast("array<string>"))
    return F.concat(bind(cut_elements(html, ("script", "style")), collect), nested)


def discover_links(url: Column, html: Column, max_links: int = 50) -> Column:
    """Article links of a section page: absolute, distinct, the first `max_links` by URL."""
    hrefs = link_hrefs(html, LINK_HREF_PARTS, LINK_CLASSES)
    absolute = F.transform(
        hrefs, lambda h: F.when(h.startswith("/"), resolve_url(url, h)).otherwise(h)
    )
    kept = F.filter(absolute, lambda h: h.startswith("http") & (F.char_length(h) > 10))
    return F.slice(F.array_sort(F.array_distinct(kept)), 1, max_links)


def discover_article_links(url: Column, html: Column, max_links: int = 20) -> Column:
    """The source checker's variant: all hrefs resolved, article-like URLs only."""
    from presslake.functions.predicates import is_article_url

    hrefs = link_hrefs(html, TESTER_HREF_PARTS, TESTER_LINK_CLASSES)
    absolute = F.transform(hrefs, lambda h: resolve_url(url, h))
    kept = F.filter(absolute, lambda link: is_article_url(link))
    return F.slice(F.array_sort(F.array_distinct(kept)), 1, max_links)
