"""A small reader for the few pages whose structure needs an element stack.

Runs inside Arrow batches. Unclosed elements stay open until an enclosing one
ends; an end tag closes back to its latest start tag or is ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from html.entities import html5
from html.parser import HTMLParser
from itertools import accumulate

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNSEEN_TEXT = frozenset(("script", "style", "template"))


@dataclass(frozen=True)
class TextRule:
    """How to find a page's main text."""

    selectors: tuple[str, ...]
    drop: tuple[str, ...]
    separator: str = ""
    enough: int = 0  # a selected text longer than this ends the search
    min_chars: int = 0  # the result must be longer than this
    fallback: str = "body"  # "p": all paragraphs; "body": the body, then the page; `selected_text` has none
    as_html: bool = False
    strip: bool = True  # strip each piece of text and drop empty ones


_ENTITY = re.compile(r"&(?:([a-zA-Z][-.a-zA-Z0-9]*)|(#[0-9]+|#[xX][0-9a-fA-F]+));?")


def _entity(name: str) -> str:
    """A named entity's text, with or without its semicolon; an unknown name stays as it is."""
    return html5.get(f"{name};") or html5.get(name) or f"&{name}"


def unescape(text: str) -> str:
    return _ENTITY.sub(lambda m: _entity(m[1]) if m[1] else html.unescape(f"&{m[2]};"), text)


def _selector_test(selector: str) -> Callable[[str, dict], bool]:
    if selector.startswith("."):
        return lambda tag, attrs: selector[1:] in (attrs.get("class") or "").split()
    if selector.startswith("#"):
        return lambda tag, attrs: attrs.get("id") == selector[1:]
    if selector.startswith("["):
        name, value = re.fullmatch(r'\[([\w-]+)="(.*)"\]', selector).groups()
        return lambda tag, attrs: attrs.get(name) == value
    return lambda tag, attrs: tag == selector


class _Taken:
    """One selected element: where it lies in the source, and which of the page's text pieces are its own."""

    def __init__(self, start: int, first: int):
        self.start, self.end, self.first, self.last = start, None, first, first


class PageReader(HTMLParser):
    """Collects, for each selector, the first matching element (or all of them)."""

    def __init__(self, page: str, selectors, drop=(), every=()):
        super().__init__(convert_charrefs=False)
        self.tests = {s: _selector_test(s) for s in selectors}
        self.every = frozenset(every)
        self.drop = frozenset(drop)
        self.found: dict[str, list[_Taken]] = {s: [] for s in selectors}
        self.dropped: list[tuple[int, int]] = []
        self.stack: list[tuple[str, list[_Taken]]] = []
        self.depth: Counter[str] = Counter()
        # Elements lie within each other, so what one of them holds is a range of these.
        self.pieces: list[str] = []
        self.drop_depth = self.unseen = 0
        self.drop_start = 0
        self.buffer: list[str] = []
        self.lines = [0]
        for line in page.split("\n")[:-1]:
            self.lines.append(self.lines[-1] + len(line) + 1)
        self.page, self.size = page, len(page)
        self.feed(page)
        self.close()
        self._flush()
        while self.stack:
            self._pop(self.size)
        stripped = [piece.strip() for piece in self.pieces]
        self.shown = [piece for piece in stripped if piece]
        self.before = [0, *accumulate(map(bool, stripped))]

    def text(self, taken: _Taken, separator: str, strip: bool = True) -> str:
        """An element's pieces, joined; with `strip` each without blanks around it, and no empty ones."""
        if not strip:
            return separator.join(self.pieces[taken.first : taken.last])
        return separator.join(self.shown[self.before[taken.first] : self.before[taken.last]])

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _flush(self) -> None:
        if self.buffer:
            text = "".join(self.buffer)
            self.buffer.clear()
            if not self.drop_depth and not self.unseen:
                self.pieces.append(text)

    def _pop(self, end: int) -> None:
        tag, started = self.stack.pop()
        self.depth[tag] -= 1
        for taken in started:
            taken.end, taken.last = end, len(self.pieces)
        if tag in UNSEEN_TEXT:
            self.unseen -= 1
        if tag in self.drop:
            self.drop_depth -= 1
            if not self.drop_depth:
                self.dropped.append((self.drop_start, end))

    def handle_starttag(self, tag, attrs):
        self._flush()
        start = self._at()
        if tag in self.drop:
            if not self.drop_depth:
                self.drop_start = start
            self.drop_depth += 1
        started = []
        if not self.drop_depth:
            values = dict(reversed(attrs))
            for selector, test in self.tests.items():
                seen = self.found[selector]
                if (not seen or selector in self.every) and test(tag, values):
                    taken = _Taken(start, len(self.pieces))
                    seen.append(taken)
                    started.append(taken)
        if tag in UNSEEN_TEXT:
            self.unseen += 1
        self.stack.append((tag, started))
        self.depth[tag] += 1
        if tag in VOID_TAGS:
            self._pop(start + len(self.get_starttag_text()))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._pop(self._at() + len(self.get_starttag_text()))

    def handle_endtag(self, tag):
        self._flush()
        if self.depth[tag]:
            start = self._at()
            while self.stack[-1][0] != tag:
                self._pop(start)
            close = self.page.find(">", start)
            self._pop(self.size if close < 0 else close + 1)

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_entityref(self, name):
        self.buffer.append(_entity(name))

    def handle_charref(self, name):
        self.buffer.append(unescape(f"&#{name};"))

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()


def _markup(page: str, taken: _Taken, dropped) -> str:
    out, at = [], taken.start
    for start, end in dropped:
        if start >= taken.start and end <= taken.end:
            out.append(page[at:start])
            at = end
    out.append(page[at : taken.end])
    return "".join(out)


def main_text(page: str, rule) -> str | None:
    """The page's main text by an extraction rule."""
    extra = ("p",) if rule.fallback == "p" else ("body",)
    reader = PageReader(page, rule.selectors + extra, drop=rule.drop, every=("p",) if rule.fallback == "p" else ())
    text = None
    for selector in rule.selectors:
        for taken in reader.found[selector]:
            text = _markup(page, taken, reader.dropped) if rule.as_html else reader.text(taken, rule.separator, rule.strip)
        if reader.found[selector] and (rule.enough == 0 or len(text) > rule.enough):
            return text
    if rule.fallback == "p":
        if not text:
            paragraphs = (reader.text(p, "") for p in reader.found["p"])
            text = "\n".join(p for p in paragraphs if p)
    elif text is None:
        body = reader.found["body"]
        if body:
            text = _markup(page, body[0], reader.dropped) if rule.as_html else reader.text(body[0], rule.separator, rule.strip)
        elif not rule.as_html:
            whole = PageReader(f"<body>{page}", ("body",), drop=rule.drop)
            text = whole.text(whole.found["body"][0], rule.separator, rule.strip)
    return text


def selected_text(page: str, rule) -> str | None:
    """Text of the first element of the first selector that gives enough; no fallback."""
    reader = PageReader(page, rule.selectors, drop=rule.drop)
    for selector in rule.selectors:
        for taken in reader.found[selector]:
            text = reader.text(taken, rule.separator, rule.strip)
            if len(text) > rule.min_chars:
                return text
    return None


def senate_text(page: str) -> str | None:
    reader = PageReader(page, ("#textoMateria", "#materia", "h1"), drop=("script", "style"), every=("h1",))
    if not reader.found["#textoMateria"]:
        return None
    title = ""
    for outer in reader.found["#materia"]:
        inside = [h for h in reader.found["h1"] if outer.start < h.start < outer.end]
        title = reader.text(inside[0], "") if inside else ""
    text = reader.text(reader.found["#textoMateria"][0], "\n")
    return (
        f"<body><div class='senado-content'><h1>{title}</h1>"
        f"<div id='textoMateria'>{text}</div></div></body>"
    )


class _LinkReader(HTMLParser):
    def __init__(self, classes):
        super().__init__(convert_charrefs=True)
        self.classes = frozenset(classes)
        self.stack: list[tuple[str, bool]] = []
        self.depth: Counter[str] = Counter()
        self.wanted = 0
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs):
        values = dict(reversed(attrs))
        if tag == "a" and values.get("href") and self.wanted:
            self.hrefs.append(values["href"])
        if tag not in VOID_TAGS:
            wanted = tag in ("h1", "h2", "h3") or bool(self.classes & set((values.get("class") or "").split()))
            self.stack.append((tag, wanted))
            self.depth[tag] += 1
            self.wanted += wanted

    def _pop(self) -> str:
        tag, wanted = self.stack.pop()
        self.depth[tag] -= 1
        self.wanted -= wanted
        return tag

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._pop()

    def handle_endtag(self, tag):
        if self.depth[tag]:
            while self._pop() != tag:
                pass


def links_within(page: str, classes) -> list[str]:
    """hrefs of links inside headings or inside elements of these classes."""
    reader = _LinkReader(classes)
    reader.feed(page)
    reader.close()
    return reader.hrefs
