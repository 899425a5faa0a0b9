"""Publication dates: parsing, display, year and recency tests.

Feeds write dates in many ways. Each known shape is recognised by a pattern,
rewritten into one wall-clock string and parsed once; a text of no known shape
is NULL. The session time zone is expected to be UTC (`session.configure`).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.match import bind

_CLOCK = r"(\d{1,2}:\d{2}(?::\d{2})?)(?:\.\d+)?(?:\s*([AaPp])\.?[Mm]\b\.?)?"
_ZONE = r"\s*([A-Za-z]{1,5}|(?:GMT|UTC)?[+-]\d{2}(?::?\d{2})?)?"
_DAY_NAME = r"(?:[A-Za-z]{3,9},?\s+)?"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_LATER = rf"(?:,?\s+(?:at\s+)?{_CLOCK}{_ZONE})?"

ISO = rf"^\s*(\d{{4}})([-/])(\d{{1,2}})\2(\d{{1,2}})(?:[Tt ]{_CLOCK}{_ZONE})?\s*$"
COMPACT = rf"^\s*((?:19|20)\d{{2}})(\d{{2}})(\d{{2}})(?:[Tt ](\d{{2}})(\d{{2}})(\d{{2}})?{_ZONE})?\s*$"
DAY_FIRST = rf"^\s*{_DAY_NAME}{_DAY}[ -]([A-Za-z]{{3}})[a-z]*,?[ -](\d{{4}}){_LATER}\s*$"
DAY_FIRST_SHORT = rf"^\s*{_DAY_NAME}{_DAY}[ -]([A-Za-z]{{3}})[a-z]*,?[ -](\d{{2}}){_LATER}\s*$"
MONTH_FIRST = rf"^\s*{_DAY_NAME}([A-Za-z]{{3}})[a-z]*\.?\s+{_DAY},?\s+(\d{{4}}){_LATER}\s*$"
YEAR_LAST = rf"^\s*{_DAY_NAME}([A-Za-z]{{3}})[a-z]*\.?\s+{_DAY}\s+{_CLOCK}{_ZONE}\s+(\d{{4}})\s*$"
# Numbers with slashes: the month first, unless it can only be the day.
MONTH_NUMBER_FIRST = rf"^\s*(0?[1-9]|1[0-2])/(\d{{1,2}})/(\d{{4}}){_LATER}\s*$"
DAY_NUMBER_FIRST = rf"^\s*(1[3-9]|2\d|3[01])/(\d{{1,2}})/(\d{{4}}){_LATER}\s*$"

# Each shape and how it is rewritten: wall clock, half of the day and zone, split by bars.
SHAPES = [
    (ISO, "$1-$3-$4 $5|$6|$7"),
    (COMPACT, "$1-$2-$3 $4:$5:$6||$7"),
    (DAY_FIRST, "$3-$2-$1 $4|$5|$6"),
    (DAY_FIRST_SHORT, "20$3-$2-$1 $4|$5|$6"),
    (MONTH_FIRST, "$3-$1-$2 $4|$5|$6"),
    (YEAR_LAST, "$6-$1-$2 $3|$4|$5"),
    (MONTH_NUMBER_FIRST, "$3-$1-$2 $4|$5|$6"),
    (DAY_NUMBER_FIRST, "$3-$2-$1 $4|$5|$6"),
]


def _rewritten(column: Column) -> Column:
    """The text as `wall|half|zone`; a rewritten text has no other shape, one of no known shape stays as it is."""
    for shape, rewrite in SHAPES:
        column = F.regexp_replace(column, shape, rewrite)
    return column


def _part(rewritten: Column, n: int) -> Column:
    return F.coalesce(F.get(F.split(rewritten, r"\|"), n), F.lit(""))


def _wall_of(rewritten: Column) -> Column:
    """Timestamp as written, ignoring any zone; NULL if of no known shape."""
    # A clock that is not there leaves its colons.
    text = F.regexp_replace(_part(rewritten, 0), r"[ :]+$", "")
    clock = "[ H:mm[:ss]]"
    numbers = F.try_to_timestamp(text, F.lit(f"yyyy-M-d{clock}"))
    ts = F.coalesce(numbers, F.try_to_timestamp(text, F.lit(f"yyyy-MMM-d{clock}")))
    return F.when(F.contains(rewritten, F.lit("|")), _half_day(ts, F.lower(_part(rewritten, 1))))


def _half_day(ts: Column, letter: Column) -> Column:
    """A twelve-hour clock's time, by the first letter of its AM or PM, if it has one."""
    hours = F.when((letter == "p") & (F.hour(ts) < 12), 12).when((letter == "a") & (F.hour(ts) == 12), -12)
    return ts + F.make_dt_interval(hours=hours.otherwise(0))


def _offset_minutes(rewritten: Column) -> Column:
    """Minutes east of UTC; a missing or unknown zone counts as UTC."""
    zone = _part(rewritten, 2)
    sign = F.when(zone.contains("-"), -1).otherwise(1)
    hours = F.regexp_extract(zone, r"[+-](\d{2})(?::?(\d{2}))?$", 1).try_cast("int")
    minutes = F.regexp_extract(zone, r"[+-](\d{2})(?::?(\d{2}))?$", 2).try_cast("int")
    return F.coalesce(sign * (hours * 60 + F.coalesce(minutes, F.lit(0))), F.lit(0))


def _wall_clock(column: Column) -> Column:
    return bind(_rewritten(column), _wall_of)


def parse_pub_date(column: Column, keep_wall_clock: bool = False) -> Column:
    """The instant a date text names (UTC if it names no zone), or its wall clock."""
    if keep_wall_clock:
        return _wall_clock(column)
    return bind(_rewritten(column), lambda text: _wall_of(text) - F.make_dt_interval(mins=_offset_minutes(text)))


def display_date(column: Column) -> Column:
    """``November 03, 2025 at 10:00 AM``; the text itself if unparseable, ``Unknown`` if missing."""
    shown = F.date_format(_wall_clock(column), "MMMM dd, yyyy 'at' hh:mm a")
    return F.coalesce(shown, column, F.lit("Unknown"))


def display_day(column: Column) -> Column:
    """``November 03, 2025`` for a date column."""
    return F.date_format(column, "MMMM dd, yyyy")


def year_filter(column: Column, min_year: int = 2025, strict: bool = False) -> Column:
    """Keep by year. Without `strict` everything stays, as the collecting runs have always
    behaved; with it, texts naming an earlier year go and undated ones stay."""
    if not strict:
        return F.lit(True)
    year = F.nullif(F.regexp_extract(column, r"(20\d\d)", 1), F.lit("")).cast("int")
    return F.coalesce(year >= min_year, F.lit(True))


def recent(column: Column, as_of: datetime | Column, days: int = 1, min_year: int = 2025) -> Column:
    """At most `days` old at `as_of` (inclusive). Undated stays; an unparseable date falls
    back to its first four digits, and stays if it has none."""
    year = F.regexp_extract(column, r"(\d{4})", 1)
    parsed = parse_pub_date(column)
    cutoff = as_of_column(as_of) - F.make_dt_interval(days=F.lit(days))
    return (
        F.when(F.coalesce(column, F.lit("")) == "", True)
        .when(parsed.isNotNull(), parsed >= cutoff)
        .when(year != "", year.cast("int") >= min_year)
        .otherwise(True)
    )


def entry_recent(column: Column, as_of: datetime | Column, days: int = 7) -> Column:
    """Strictly newer than `days` before `as_of`; undated or unparseable is not recent."""
    cutoff = as_of_column(as_of) - F.make_dt_interval(days=F.lit(days))
    return F.coalesce(parse_pub_date(column) > cutoff, F.lit(False))


def as_of_column(as_of: datetime | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
