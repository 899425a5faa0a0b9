"""Feed documents (RSS and Atom) as rows, one per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions.match import bind
from presslake.operators.shape import compute_once

_LINK = "array<struct<_VALUE: string, _href: string>>"
_ITEM = (
    f"struct<title: array<string>, link: {_LINK}, pubDate: array<string>,"
    " published: array<string>, updated: array<string>, description: array<string>,"
    " summary: array<string>, content: array<string>>"
)
FEED_SCHEMA = (
    f"channel array<struct<item: array<{_ITEM}>>>, item array<{_ITEM}>, entry array<{_ITEM}>"
)
# Blanks inside elements are data here.
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}
ELEMENT = r"(?is)<(item|entry)(?=[\s>])[^>]*>.*?</\1\s*>"
CDATA = r"(?s)<!\[CDATA\[(.*?)\]\]>"


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """(feed_url, xml): each file is one fetched feed document, named by its path."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("feed_url"), F.col("value").alias("xml"))


def explode_feed(documents: DataFrame, xml_col: str = "xml", keep_cut: bool = False) -> DataFrame:
    """One row per item in document order; a document without items gives its Atom entries.

    A document that is not well-formed gives the items that are complete in it, each
    repaired on its own (`salvaged`), and with `keep_cut` the one in which it ends, with the fields
    and the part of a field that are there. The document itself is dropped from the output.
    """
    parsed = F.from_xml(F.col(xml_col), FEED_SCHEMA, XML_OPTIONS)
    keep = [c for c in documents.columns if c != xml_col]
    nested = F.flatten(
        F.filter(F.transform("feed.channel", lambda c: c["item"]), lambda items: items.isNotNull())
    )
    empty = F.array().cast(f"array<{_ITEM}>")
    items = F.concat(F.coalesce(nested, empty), F.coalesce(F.col("feed.item"), empty))
    items = F.when(_is_feed(F.col("feed")), items).otherwise(salvaged(F.col(xml_col), keep_cut))
    return (
        compute_once(compute_once(documents, feed=parsed), items=items, entries=F.col("feed.entry"))
        .select(
            *keep,
            F.posexplode_outer(F.when(F.size("items") > 0, F.col("items")).otherwise(F.col("entries")))
            .alias("item_pos", "item"),
        )
        .where(F.col("item_pos").isNotNull())
    )


def _is_feed(feed: Column) -> Column:
    """Did a document parse? One that did not has none of the outer elements."""
    return F.coalesce(feed["channel"].isNotNull() | feed["item"].isNotNull() | feed["entry"].isNotNull(), F.lit(False))


def repaired(markup: Column) -> Column:
    """Bare ampersands and unknown entities escaped, CDATA as plain text, prefixes that may lack a declaration made
    part of the name."""
    plain = F.regexp_replace(markup, CDATA, "$1")
    known = F.regexp_replace(plain, "&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)", "&amp;")
    names = F.regexp_replace(known, r"(</?[A-Za-z][\w.-]*):(?=[A-Za-z])", "$1_")
    return F.regexp_replace(names, r"(\s[A-Za-z][\w.-]*):([A-Za-z][\w.-]*\s*=)", "$1_$2")


def salvaged(xml: Column, keep_cut: bool = False) -> Column:
    """The complete item and entry elements of a document that is not well-formed, each parsed by itself, and the cut one."""
    markup = F.coalesce(xml, F.lit(""))
    elements = F.regexp_extract_all(markup, F.lit(ELEMENT), F.lit(0))
    if keep_cut:
        elements = bind(closed(markup), lambda last: F.when(last != "", F.concat(elements, F.array(last))).otherwise(elements))
    each = F.transform(elements, lambda e: F.from_xml(repaired(e), _ITEM, XML_OPTIONS))
    return F.filter(each, lambda x: x["title"].isNotNull() | x["link"].isNotNull())


def closed(markup: Column) -> Column:
    """The item in which a document ends, with all that is open in it closed; empty if there is none.

    What stands of a tag, an entity or a CDATA mark at the cut is dropped; text of a field that was cut is kept.
    """
    behind = F.regexp_replace(markup, r"(?is)^.*</(?:item|entry)\s*>", "")
    item = F.regexp_extract(behind, r"(?is)<(?:item|entry)(?=[\s>])[^>]*>.*$", 0)
    in_cdata = item.contains("<![CDATA[") & ~F.substring_index(item, "<![CDATA[", -1).contains("]]>")
    ended = F.when(in_cdata, F.concat(F.regexp_replace(item, r"\]{1,2}$", ""), F.lit("]]>"))).otherwise(item)
    # As `repaired` reads it: what CDATA holds is markup.
    plain = F.regexp_replace(F.regexp_replace(ended, CDATA, "$1"), "(?s)<!--.*?-->", "")
    whole = F.regexp_replace(F.regexp_replace(plain, "<[^<>]*$", ""), "&#?[A-Za-z0-9]*$", "")

    def close(text: Column) -> Column:
        tags = F.regexp_extract_all(text, F.lit(r"<(/?[A-Za-z_][\w.:-]*)(?:\s[^<>]*)?(?<!/)>"), F.lit(1))
        # Open elements, the innermost first.
        still = F.aggregate(
            tags,
            F.array().cast("array<string>"),
            lambda up, tag: F.when(~tag.startswith("/"), F.concat(F.array(tag), up))
            .when(F.get(up, 0) == F.substr(tag, F.lit(2)), F.slice(up, 2, F.greatest(F.size(up) - 1, F.lit(0))))
            .otherwise(up),
        )
        return F.concat(text, F.array_join(F.transform(still, lambda tag: F.concat(F.lit("</"), tag, F.lit(">"))), ""))

    return bind(whole, close)


def unreadable(documents: DataFrame, xml_col: str = "xml", keep_cut: bool = False) -> DataFrame:
    """Documents that neither parse nor hold an item (a complete one, without `keep_cut`)."""
    feed = F.from_xml(F.col(xml_col), FEED_SCHEMA, XML_OPTIONS)
    checked = compute_once(documents, feed=feed)
    bad = checked.where(~_is_feed(F.col("feed")) & (F.size(salvaged(F.col(xml_col), keep_cut)) == 0))
    return bad.drop("feed")


def _first_text(element: Column) -> Column:
    """Text of the first such element: empty for an empty one, NULL for a missing one."""
    return F.when(element.isNotNull(), F.coalesce(F.get(element, 0), F.lit("")))


def normalize_items(items: DataFrame) -> DataFrame:
    """Title, link, date and description, each by the first element present."""
    item = F.col("item")
    link = F.get(item["link"], 0)
    href = F.nullif(link["_href"], F.lit(""))
    keep = [c for c in items.columns if c != "item"]

    def first_of(names: list[str], default: str) -> Column:
        return F.coalesce(*[_first_text(item[n]) for n in names], F.lit(default))

    columns = {
        "title": first_of(["title"], "No Title"),
        "link": F.when(item["link"].isNotNull(), F.coalesce(href, link["_VALUE"], F.lit(""))),
        "pub_date": first_of(["pubDate", "published", "updated"], ""),
        "description": first_of(["description", "summary", "content"], ""),
    }
    return compute_once(items, **columns).select(*keep, *columns)
