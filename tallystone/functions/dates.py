"""Date expressions: a settings-free parser for mixed date texts, and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_BLANK = r"[T\s]"
_CLOCK = r"(?:[01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d"
# Year-first or month-first date, then an optional full time of day. The empty alternative makes every
# text match, so that an unreadable one is replaced by bare separators, which no cast accepts.
_DATE_TIME = (
    rf"(?s)^{_BLANK}*(?:"
    r"(?:(\d{4})([/-])(\d{1,2})\2(\d{1,2})|(\d{1,2})/(\d{1,2})/(\d{4}))(?!\d)"
    rf"(?:{_BLANK}+({_CLOCK})(?!\d))?"
    r")?.*$"
)
_AS_ISO = "$1$7-$3$5-$4$6 $8"
_ZERO_OFFSET = r"\s*(Z|\+00|\+00:00)\s*$"


def normalize_date_text(raw: Column) -> Column:
    """Drop a zero-offset suffix, turn ISO ``T`` into a blank and squeeze blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(raw), _ZERO_OFFSET, ""), rf"{_BLANK}+", " "))


def parse_timestamp(raw: Column) -> Column:
    """Timestamp (without zone) of a date text, normalised or not, else NULL.

    Reads y/M/d, y-M-d and M/d/y, one- or two-digit parts, with or without h:m:s. Text after the
    recognised part is ignored, offsets included. A missing, partial or out-of-range time means
    midnight; a date that is not on the calendar, or a two-digit year, means NULL.

    One regex pass and one native cast: it depends neither on the session's time-parser policy nor
    on its zone, and the text is mentioned only once, so Catalyst cannot duplicate the work.
    """
    return F.regexp_replace(raw, _DATE_TIME, _AS_ISO).try_cast("timestamp_ntz")


def yyyymm(year: Column, month: Column) -> Column:
    return year * 100 + month


def first_of_month(year: Column, month: Column) -> Column:
    """NULL for a month that is not on the calendar, whatever the session's ANSI setting."""
    on_calendar = month.between(1, 12) & year.between(1, 9999)
    return F.make_date(F.when(on_calendar, year), F.when(on_calendar, month), F.lit(1))


def is_weekend(day_of_week: Column) -> Column:
    """For Spark's numbering: 1 = Sunday .. 7 = Saturday."""
    return day_of_week.isin(1, 7)
