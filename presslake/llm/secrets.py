"""Secret scan: fixed patterns, and values in a credential's context that are costly to guess.

The cost of guessing a value is that of its cheapest segmentation, found by dynamic
programming: words of a list, dates, repeats, keyboard walks and sequences, and
brute-forced characters, each segment with its number of guesses. A value behind a credential
word counts as a secret when even the cheapest way takes `least_guesses` or more.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import fresh, whole_text

# The base patterns, the shortest value of each, and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "guess")
#: A text without any of these holds no match of ASSIGN, or no credential context.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "bearer", "key", "pin")

#: A credential word is a whole part of a name (DB_PWD, x-api-key2); the longer words also end one (dbPassword).
CONTEXT = re.compile(
    r"""(?:(?:(?<![A-Za-z0-9])pass(?:phrase|code)?|(?<![A-Za-z0-9])(?:pwd|pin|auth(?:orization)?)|password|passwd|passphrase|secrets?|tokens?|credentials?"""
    r"""|(?<![A-Za-z0-9])(?:api|access|private|secret|client|encryption|signing|master|account)[_ -]?(?:keys?|secret))"""
    r"""\d*(?:(?-i:[A-Z][A-Za-z0-9]{0,64}))?(?:[_.-][A-Za-z0-9_.-]{0,128})?)["']?[ \t]{0,4}(?::=|=>|[:=]|\bis\b)[ \t]{0,4}["'`<]?"""
    r"""(?!(?:bearer|basic)[ \t])([^\s"'`<>]{6,})|\b(?:bearer|basic)[ \t]+([A-Za-z0-9+/_.=~-]{6,})""",
    re.IGNORECASE | re.ASCII,
)
LEAST_GUESSES = 1e10

# Words people put into passwords, the most used first.
COMMON_WORDS = [
    "password", "pass", "admin", "qwerty", "letmein", "welcome", "monkey", "dragon", "master", "login", "abc", "iloveyou",
    "sunshine", "princess", "football", "baseball", "shadow", "superman", "trustno", "hello", "freedom", "whatever", "secret",
    "test", "guest", "root", "user", "default", "changeme", "example", "demo", "sample", "summer", "winter", "spring",
    "autumn", "love", "angel", "flower", "cheese", "computer", "internet", "server", "system", "public", "private", "key",
    "token", "none", "null", "true", "false", "required", "value", "string", "here", "your", "my", "the", "and",
]
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
#: Guesses for a word that is not in the list, up to a length of WORD_LETTERS; longer ones cost as much per WORD_LETTERS.
OTHER_WORD, WORD_LETTERS = 1e6, 13
#: Consonants that follow each consonant in words of English, French, Spanish and German; all others count as odd.
NEXT_CONSONANTS = {
    "b": "bdfghjlmnrstvw", "c": "chklnqrstz", "d": "bdfghjklmnrstvwz", "f": "fghlrst", "g": "bdfghlmnprstwz", "h": "bdfhklmnrstwz", "j": "",
    "k": "bfhklmnprstvw", "l": "bcdfghklmnpqrstvwxz", "m": "bcdflmnprstvw", "n": "bcdfghjklmnpqrstvwxz", "p": "bcdfhklmnprstwz", "q": "",
    "r": "bcdfghjklmnpqrstvwxz", "s": "bcdfghklmnpqrstvwz", "t": "bcdfghklmnprstvwz", "v": "lr", "w": "bdfhklnrst", "x": "cfhpt", "z": "bhklntuvwz",
}
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]")
#: Each further segment multiplies the guesses.
JOINT = 2.0

_DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01]))?|(?:0?[1-9]|[12]\d|3[01])([-/._])(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d")


@dataclass
class GuessCost:
    """Log10 of the guesses a value takes at least."""

    words: list[str] = field(default_factory=lambda: COMMON_WORDS)

    def __post_init__(self):
        self.rank = {w: i + 1 for i, w in enumerate(self.words)}
        self.longest = max(map(len, self.words), default=0)
        self.next_key = {(row[i], row[i + d]) for row in KEY_ROWS for d in (1, -1) for i in range(len(row)) if 0 <= i + d < len(row)}

    @staticmethod
    def _brute(c: str) -> float:
        return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 1000)

    @staticmethod
    def _other_word(run: str) -> float | None:
        """Log10 of the guesses for a run of letters read as words; None when it does not look like words."""
        low, pieces = run.lower(), len(_PIECE.findall(run))
        odd = sum(a in NEXT_CONSONANTS and b in NEXT_CONSONANTS and b not in NEXT_CONSONANTS[a] for a, b in zip(low, low[1:], strict=False))
        if 4 * pieces > len(run) or 10 * odd > len(run) or not re.search("[aeiouy]", low):
            return None
        return math.log10(OTHER_WORD) * max(1.0, len(run) / WORD_LETTERS) + math.log10(JOINT) * (pieces - 1)

    def spans(self, value: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, log10 of guesses) of everything cheaper than brute force."""
        low, n = value.lower(), len(value)
        if len(low) != n:  # a few characters grow in lower case
            low = value
        for i in range(n):
            for j in range(i + 2, min(n, i + self.longest) + 1):
                if rank := self.rank.get(low[i:j]):
                    yield i, j, math.log10(rank * (1 if value[i:j] == low[i:j] else 2 if value[i:j].istitle() or value[i:j].isupper() else 2 ** (j - i)))
        for m in re.finditer(r"[A-Za-z]{4,}", value):
            if (guesses := self._other_word(m[0])) is not None:
                yield m.start(), m.end(), guesses
        for i in range(n):
            if (m := _DATE.match(value, i)) and m.end() - i >= 4:
                yield i, m.end(), math.log10(365 * 60 * (4 if m[1] or m[2] else 1) if m.end() - i > 4 else 120)
        # Walks: runs in which each character stands beside the one before it.
        start = 0
        for i in range(1, n + 1):
            if i == n or (low[i - 1], low[i]) not in self.next_key:
                if i - start >= 3:
                    yield start, i, math.log10(20 * (i - start))
                start = i

    def repeats(self, value: str, cost) -> Iterator[tuple[int, int, float]]:
        for unit in (1, 2, 3, 4):
            start = 0
            for i in range(unit, len(value) + 1):
                if i == len(value) or value[i] != value[i - unit]:
                    times = (i - start) // unit
                    if times >= 2 and times * unit >= 3:
                        yield start, start + times * unit, cost(value[start : start + unit]) + math.log10(times)
                    start = i - unit + 1

    def log10(self, value: str) -> float:
        """Cheapest segmentation; the work is proportional to the length of the value."""
        joint = math.log10(JOINT)
        ending: dict[int, list[tuple[int, float]]] = {}
        brute_unit = lambda unit: sum(map(self._brute, unit))
        for i, j, cost in (*self.spans(value), *self.repeats(value, brute_unit)):
            ending.setdefault(j, []).append((i, cost))
        closed, brute = [0.0], [0.0]  # cheapest ways up to here; those that end in a brute-forced character
        for j in range(1, len(value) + 1):
            one = self._brute(value[j - 1])
            open_new = closed[j - 1] + one + (joint if j > 1 else 0)
            brute.append(min(brute[j - 1] + one, open_new) if j > 1 else one)
            best = brute[j]
            for i, cost in ending.get(j, ()):
                best = min(best, closed[i] + cost + (joint if i else 0))
            closed.append(best)
        return closed[-1]


@lru_cache(maxsize=1)
def _default_cost() -> GuessCost:
    return GuessCost()


def secret_spans(text: str, least_guesses: float = LEAST_GUESSES, cost: GuessCost | None = None) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) of a text in code points, by start, then kind."""
    cost = cost or _default_cost()
    low = text.lower()
    found: list[tuple[int, int, str]] = []
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    if any(hint in low for hint in CONTEXT_HINTS):
        base = sorted(found)
        for m in CONTEXT.finditer(text):
            group = 1 if m[1] is not None else 2
            value = m[group].rstrip(".,;:!?)]}")
            start, end = m.start(group), m.start(group) + len(value)
            if len(value) < LEAST_VALUE or any(s < end and start < e for s, e, _ in base):
                continue
            if cost.log10(value) >= math.log10(least_guesses):
                found.append((start, end, "guess"))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def scan_secrets(df: DataFrame, text_col: str = "text", least_guesses: float = LEAST_GUESSES) -> DataFrame:
    """Every row of `df` with the added column secrets: an array of (start, end, kind).

    Starts and ends are code points, ends exclusive. Kinds assign, access and hex are
    the base patterns, guess is a value in a credential's context, not overlapping
    any of those. Null and empty texts have none. A clashing column name gets an
    underscore in front; an empty table gives an empty table.
    """
    (name,) = fresh(df, "secrets")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    @F.arrow_udf("array<struct<start:int,end:int,kind:string>>")
    def spans(texts: pa.Array) -> pa.Array:
        rows = [[{"start": s, "end": e, "kind": k} for s, e, k in secret_spans(t.as_py(), least_guesses)] for t in texts]
        return pa.array(rows, kind)

    return df.withColumn(name, spans(whole_text(text_col)))


