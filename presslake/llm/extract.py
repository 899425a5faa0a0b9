"""Main text of HTML pages by the maximum-scoring subsequence.

A page is a sequence of tags and words. Words score by the element they stand in, as a
rule positively, tags negatively; one linear scan finds the contiguous stretch of the
highest sum (and takes all of the <article> it lies in, if it lies in one). The scores are log-odds counted on labelled pages: those whose one
<article> says which tokens are content. Inside the stretch, menus, adverts, forms and
the like are left out, and the words are joined block by block.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import fresh, whole_text

#: Labelled pages the weights are counted on, at most about so many.
LABELLED_PAGES = 2_000
WORD_RANGE, TAG_RANGE = (-4.0, 2.0), (-4.0, -0.1)
#: Scores where no page is labelled.
PLAIN_WORD, PLAIN_TAG = 1.0, -3.25

# Element names by what they do.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")
DROPPED = {
    *RAW, "head", "nav", "footer", "aside", "form", "button", "select", "option", "input", "menu", "dialog", "canvas", "audio",
    "video",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "aside",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "cite", "code", "del", "em", "font", "i", "ins", "label", "mark", "math", "q", "s", "small", "span", "strong", "sub",
    "sup", "time", "u",
}
KNOWN = DROPPED | BLOCKS | VOID | INLINE
#: Names in class, id or role that mark what is not part of an article.
DROPPED_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adslot", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "contentinfo", "cookie", "cookies", "consent", "disqus", "footer", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promoted", "related", "replies", "respond", "share", "sharing",
    "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Last parts of a class that say nothing by themselves: the part before them names it (ad-box, comment-list).
HOLDER_NAMES = {
    "area", "bar", "block", "bottom", "box", "button", "buttons", "container", "form", "icons", "inner", "item", "items", "left", "link", "links",
    "list", "outer", "panel", "posts", "right", "section", "signup", "slot", "stories", "thread", "top", "unit", "wrap", "wrapper",
}
#: Parts that make the name after them a state of the element, not what it is.
STATE_NAMES = {"no", "not", "has", "have", "with", "without", "hide", "show", "is"}
#: Elements a start tag ends when they are still open.
ENDED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

def _token_pattern(attrs: str) -> re.Pattern:
    return re.compile(
        r"<!--.*?(?:-->|\Z)"
        rf"|<(?P<raw>{'|'.join(RAW)})\b{attrs}>.*?(?:</(?P=raw)\s*>|\Z)"
        rf"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>{attrs})>"
        r"|<[!?/][^>]*(?:>|\Z)"
        r"|(?P<text>[^<]+|<)",
        re.DOTALL | re.IGNORECASE,
    )


#: Quotation marks count behind "=" only; in a page whose tags do not end that way, not at all.
_TOKEN = _token_pattern(r"(?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^>])*+")
_UNQUOTED_TOKEN = _token_pattern(r"[^>]*+")
_TAIL_TOKEN = re.compile(r"<[!?/].*|(?P<text>[^<]+|<)|(?P<name>(?!))", re.DOTALL)


def _matches(page: str) -> Iterator[re.Match]:
    """Tags, comments and text runs, in time linear in the page: a tag that does not end is looked for once."""
    at, pattern, last = 0, _TOKEN, page.rfind(">")
    while at < len(page):
        if at > last:
            pattern = _TAIL_TOKEN
        m = pattern.match(page, at)
        if pattern is _TOKEN and m["text"] == "<" and page[at + 1 : at + 2].isalpha():
            pattern = _UNQUOTED_TOKEN
            m = pattern.match(page, at)
        yield m
        at = m.end()


_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_WORD_BREAK = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")


def _names_part(token: str) -> bool:
    """Does a class, id or role name something that is not part of an article?"""
    parts = [x.lower() for x in _WORD_BREAK.split(token) if x]
    if "-".join(parts) in DROPPED_NAMES:
        return True
    if any(x in STATE_NAMES for x in parts[:-1]):
        return False
    while len(parts) > 1 and (parts[-1] in HOLDER_NAMES or parts[-1].isdigit()):
        parts.pop()
    return bool(parts) and parts[-1] in DROPPED_NAMES


def _drop_of(name: str, attrs: str) -> str:
    """Why an element is left out: "always" by its kind, "name" by a name it bears, else ""."""
    if name in DROPPED:
        return "always"
    if name in ("html", "body", "article", "main") or not attrs:
        return ""
    if _HIDDEN.search(attrs):
        return "always"
    names = (x for m in _NAMES.findall(attrs) for x in (m[0] or m[1] or m[2]).split())
    return "name" if any(map(_names_part, names)) else ""


Token = tuple[str, str, str, bool, bool]


def tokens(page: str) -> list[Token]:
    """(kind, class, text, dropped, in article) of every tag and text run.

    The kind is "tag" or "word"; the class is the tag with its direction, or the element
    the words stand in. Start tags end what they cannot stand in; an end tag without
    a start ends nothing. An element is not dropped for its name when it holds the <main>, all articles, or more than half of
    the words in them (of the page where it has neither): such a name is that of a layout.
    """
    items, named, total = _scan(page, frozenset())
    spared = {
        at
        for at, (words, inside, articles, mains) in named.items()
        if (mains and mains == total[3]) or (articles and articles == total[2]) or 2 * (inside if total[1] else words) > (total[1] or total[0]) > 0
    }
    return _scan(page, frozenset(spared))[0] if spared else items


def _scan(page: str, spared: frozenset[int]) -> tuple[list[Token], dict[int, list[int]], list[int]]:
    """Tokens, and what each element dropped by its name, and the page, hold: words, words in articles or main, articles, mains."""
    items: list[Token] = []
    # Of each open element its name, why it is dropped, its place, and the nearest known and the nearest other than inline one.
    stack: list[tuple[str, str, int, str, str]] = []
    open_names: dict[str, int] = {}
    named: dict[int, list[int]] = {}
    total = [0, 0, 0, 0]
    dropped = article = always = 0
    #: Totals where the open elements that are dropped by name began.
    begun: dict[int, list[int]] = {}

    def leave() -> None:
        nonlocal dropped, article, always
        name, why, at, _, _ = stack.pop()
        open_names[name] -= 1
        dropped -= why != ""
        always -= why == "always"
        article -= name == "article"
        if at in begun:
            named[at] = [now - then for now, then in zip(total, begun.pop(at), strict=True)]

    for m in _matches(page):
        if (text := m["text"]) is not None:
            place = "dropped" if dropped else stack[-1][3] if stack else "none"
            items.append(("word", place, text, dropped > 0, article > 0))
            if not always:
                n = len(text.split())
                total[0] += n
                total[1] += n * (article > 0 or open_names.get("main", 0) > 0)
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        shown = name if name in KNOWN else "other"
        if m["close"]:
            if open_names.get(name):
                items.append(("tag", f"/{shown}", name, dropped > 0, article > 0))
                while stack[-1][0] != name:
                    leave()
                leave()
            elif name == "p":
                items.append(("tag", "/p", name, dropped > 0, article > 0))
            continue
        while stack and (ended := stack[-1][4]) and name in ENDED_BY.get(ended, ()):
            while stack[-1][0] != ended:
                leave()
            leave()
        why = _drop_of(name, m["attrs"])
        if why == "name" and m.start() in spared:
            why = ""
        items.append(("tag", shown, name, dropped > 0 or why != "", article > 0))
        if name not in VOID and not m["attrs"].endswith("/"):
            if why == "name":
                begun[m.start()] = list(total)
            if not always:
                total[2] += name == "article"
                total[3] += name == "main"
            _, _, _, known, outer = stack[-1] if stack else ("", "", 0, "none", "")
            stack.append((name, why, m.start(), name if name in KNOWN else known, outer if name in INLINE else name))
            open_names[name] = open_names.get(name, 0) + 1
            dropped += why != ""
            always += why == "always"
            article += name == "article"
    while stack:
        leave()
    return items, named, total


def token_counts(page: str) -> dict[tuple[str, str, bool], int] | None:
    """(kind, class, is content) -> tokens of a labelled page; None when it is not one."""
    if len(re.findall(r"<article\b", page, re.IGNORECASE)) != 1 or not re.search(r"</article\s*>", page, re.IGNORECASE):
        return None
    out: dict[tuple[str, str, bool], int] = {}
    for kind, shown, text, dropped, inside in tokens(page):
        n = len(text.split()) if kind == "word" else 1
        if n:
            key = (kind, shown, inside and not dropped)
            out[key] = out.get(key, 0) + n
    return out


def weights_of(counts: dict[tuple[str, str, bool], int]) -> dict[tuple[str, str], float]:
    """Log-odds of each class, words and tags held to their ranges."""
    total = {c: sum(n for (_, _, content), n in counts.items() if content == c) for c in (True, False)}
    classes = {(kind, shown) for kind, shown, _ in counts}
    out = {}
    for kind, shown in classes:
        inside = (counts.get((kind, shown, True), 0) + 0.5) / (total[True] + 1)
        outside = (counts.get((kind, shown, False), 0) + 0.5) / (total[False] + 1)
        low, high = WORD_RANGE if kind == "word" else TAG_RANGE
        out[kind, shown] = min(high, max(low, math.log(inside / outside)))
    return out


def _article_around(items: list, first: int, last: int) -> tuple[int, int]:
    """The article element most of the stretch's words stand in, if most stand in one; else the stretch."""
    inside, words, most = 0, 0, (0, first, last)
    start = None
    for i in range(len(items) + 1):
        here = i < len(items) and items[i][4]
        if here and start is None:
            start, inside = i, 0
        if not here and start is not None:
            most, start = max(most, (inside, start, i)), None
        if i < len(items) and items[i][0] == "word" and first <= i < last:
            n = len(items[i][2].split())
            words += n
            inside += n * here
    return most[1:] if 2 * most[0] > words else (first, last)


def main_text(page: str, weights: dict[tuple[str, str], float]) -> str:
    """Blocks of the best stretch of a page, one to a line."""
    items = tokens(page)
    best = total = 0.0
    first = last = start = 0
    for i, (kind, shown, text, dropped, _) in enumerate(items):
        n = len(text.split()) if kind == "word" else 1
        total += n * weights.get((kind, shown), PLAIN_TAG if kind == "tag" else PLAIN_WORD if not dropped else -PLAIN_WORD)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, first, last = total, start, i + 1
    first, last = _article_around(items, first, last)
    blocks, held = [], []
    for kind, _, text, dropped, _ in items[first:last]:
        if kind == "word":
            if not dropped:
                held.append(text)
        elif text in BLOCKS:
            blocks.append("".join(held))
            held = []
        elif text == "br":
            held.append(" ")
    blocks.append("".join(held))
    lines = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def fit_weights(pages: DataFrame, html_col: str = "html", max_pages: int = LABELLED_PAGES) -> dict[tuple[str, str], float]:
    """Weights counted over labelled pages, about `max_pages` of them by the hash of their text.

    Without labelled pages there are no weights, and words and tags score alike everywhere.
    """
    total = pages.count()
    share = min(1.0, max_pages / max(total, 1))
    part = pages.select(whole_text(html_col).alias("page"))
    part = part.filter(F.pmod(F.xxhash64("page"), F.lit(1_000_000)) < math.ceil(share * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, bool], int] = {}
        for batch in batches:
            for page in batch.column("page"):
                for key, n in (token_counts(page.as_py()) or {}).items():
                    sums[key] = sums.get(key, 0) + n
        rows = [{"kind": k, "shown": c, "content": x, "n": n} for (k, c, x), n in sums.items()]
        schema = pa.schema([("kind", pa.string()), ("shown", pa.string()), ("content", pa.bool_()), ("n", pa.int64())])
        yield pa.RecordBatch.from_pylist(rows, schema)

    counted = part.mapInArrow(run, "kind string, shown string, content boolean, n long").groupBy("kind", "shown", "content")
    # One row per known element and direction: bounded by the list of elements.
    counts = {(r["kind"], r["shown"], r["content"]): r["n"] for r in counted.agg(F.sum("n").alias("n")).collect()}
    return weights_of(counts)


def extract_pages(df: DataFrame, weights: dict[tuple[str, str], float], html_col: str = "html") -> DataFrame:
    """Every row of `df` with the added column text: the main text, empty if there is none.

    Character references are decoded, white space inside a block is one space, blocks
    are joined by one line feed. Null and empty pages have an empty text. A clashing column name
    gets an underscore in front; an empty table gives an empty table.
    """
    (name,) = fresh(df, "text")

    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(page.as_py(), weights) for page in pages], pa.string())

    return df.withColumn(name, extracted(whole_text(html_col)))
