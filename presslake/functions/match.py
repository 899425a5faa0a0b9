"""Finding lexicon terms in text with one pass over each text.

All terms of a lexicon become one regular expression: a prefix tree behind a
look-ahead, so a scan reports, at each position, the longest term that starts
there. Shorter terms that start at the same place follow from the longer one
without looking at the text again, so the result is exactly that of testing
every term on its own, while the cost hardly depends on the lexicon's size.

A "word character" is ``[\\p{L}\\p{N}_]``, spelled out because the engines'
own ``\\b`` differ on non-ASCII text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"

# How a term must sit in the text.
WHOLE_WORD, WORD_START, ANYWHERE = "word", "start", "anywhere"

_META = re.compile(r"([\\.\[\]{}()*+?^$|&~#\-])")


def escape(text: str) -> str:
    """Escape for Java and RE2 alike."""
    return _META.sub(r"\\\1", text)


def is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def _start_check(term: str) -> str:
    return f"(?<!{WORD})" if is_word(term[0]) else f"(?<={WORD})"


def _end_check(term: str, mode: str) -> str:
    if mode != WHOLE_WORD:
        return ""
    return f"(?!{WORD})" if is_word(term[-1]) else f"(?={WORD})"


def term_pattern(term: str, mode: str = WHOLE_WORD) -> str:
    """One term as a pattern without look-around, for engines that have none."""
    start = end = ""
    if mode != ANYWHERE:
        start = f"(?:^|{NOT_WORD})" if is_word(term[0]) else WORD
    if mode == WHOLE_WORD:
        end = f"(?:{NOT_WORD}|$)" if is_word(term[-1]) else WORD
    return start + escape(term) + end


def _prefix_tree(terms: Iterable[tuple[str, str]]) -> str:
    """Alternation over ``(term, check at its end)`` that prefers the longest term."""
    tree: dict = {}
    for term, check in terms:
        node = tree
        for char in term:
            node = node.setdefault(char, {})
        node[""] = check

    def render(node: dict) -> str:
        branches = [escape(c) + render(node[c]) for c in sorted(k for k in node if k)]
        if "" in node:
            branches.append(node[""])
        return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"

    return render(tree)


def _first_chars(terms: Iterable[str]) -> str:
    """A class per place for the first characters all terms have, at most three: most places fail here, before the tree."""
    terms = list(terms)
    places = range(min(3, min(map(len, terms))))
    return "".join("[" + "".join(escape(c) for c in sorted({t[i] for t in terms})) + "]" for i in places)


def _implied(shorter: str, mode: str, longer: str) -> bool:
    """Does a hit of `longer` mean that `shorter` sits at the same place too?"""
    if not longer.startswith(shorter):
        return False
    if mode != WHOLE_WORD or len(longer) == len(shorter):
        return True
    return is_word(longer[len(shorter)]) != is_word(shorter[-1])


class TermScanner:
    """A compiled set of lower-case terms, each with its matching mode."""

    def __init__(self, terms: Mapping[str, str]):
        if any(not t for t in terms):
            raise ValueError("empty term")
        self.modes = dict(terms)
        bound = {t: m for t, m in terms.items() if m != ANYWHERE}
        floating = {t: m for t, m in terms.items() if m == ANYWHERE}
        # A bound term reported at a place must not hide a longer floating one.
        clash = any(
            len(f) > len(b) and _implied(b, m, f) for b, m in bound.items() for f in floating
        )
        groups = [bound, floating] if clash else [self.modes]
        self.patterns = [self._pattern(group) for group in groups if group]

    def _pattern(self, group: Mapping[str, str]) -> str:
        by_check: dict[str, list[tuple[str, str]]] = {}
        for term, mode in group.items():
            start = "" if mode == ANYWHERE else _start_check(term)
            by_check.setdefault(start, []).append((term, _end_check(term, mode)))
        if len(by_check) == 1:
            start, entries = next(iter(by_check.items()))
            first = _first_chars(t for t, _ in entries)
            return f"{start}(?={first})(?=({_prefix_tree(entries)}))"
        parts = [
            f"(?={_first_chars(t for t, _ in entries)}){start}{_prefix_tree(entries)}"
            for start, entries in sorted(by_check.items(), key=lambda item: item[0] == "")
        ]
        return f"(?={_first_chars(group)})(?=({'|'.join(parts)}))"

    def hits(self, lowered: Column) -> Column:
        """Every reported term of the text, as array<string>; see `evidence`."""
        found = [F.regexp_extract_all(lowered, F.lit(p), F.lit(1)) for p in self.patterns]
        return found[0] if len(found) == 1 else F.concat(*found)

    def matches(self, lowered: Column) -> Column:
        """Does any term occur? Stops at the first one."""
        test = lowered.rlike(self.patterns[0])
        for pattern in self.patterns[1:]:
            test = test | lowered.rlike(pattern)
        return test

    def evidence(self, term: str) -> list[str]:
        """The reported terms that show `term` to be in the text."""
        mode = self.modes[term]
        return [
            t
            for t, other in self.modes.items()
            # A floating hit says nothing about what stands before it.
            if (t == term or mode == ANYWHERE or other != ANYWHERE) and _implied(term, mode, t)
        ]

    def values(
        self, hits: Column, entries: Sequence[tuple[str, Iterable[str]]]
    ) -> Column:
        """The values, in the order given, any of whose terms is shown by `hits`."""
        rows = [
            (value, list(dict.fromkeys(e for t in terms for e in self.evidence(t))))
            for value, terms in entries
        ]
        table = literal_table("value", "evidence", rows)
        found = F.filter(table, lambda entry: F.arrays_overlap(hits, entry["evidence"]))
        return F.transform(found, lambda entry: entry["value"])


def literal_table(key: str, listed: str, rows: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Constant array<struct<key: string, listed: array<string>>>, as one expression."""

    def quote(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    structs = (
        f"named_struct('{key}', {quote(value)}, '{listed}', array({', '.join(map(quote, texts))}))"
        for value, texts in rows
    )
    return F.expr(f"array({', '.join(structs)})")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and hand it to `body`, however often that uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def any_contains(column: Column, parts: Sequence[str]) -> Column:
    """Is any of the parts a substring? One scan for all parts."""
    return column.rlike(_prefix_tree((p, "") for p in parts))


def no_strings() -> Column:
    return F.array().cast("array<string>")
