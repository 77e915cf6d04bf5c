"""Time and calendar rules. Sessions run in UTC (see ``session.configure``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_MAIL_DATE = r"^\s*(?:[A-Za-z]{3,9},?\s+)?\d{1,2}\s+[A-Za-z]{3}\s+\d{4}\s+\d{1,2}:\d{2}"
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}"
_MAIL_FORMATS = ["d MMM yyyy H:mm:ss Z", "d MMM yyyy H:mm:ss z", "d MMM yyyy H:mm Z",
                 "d MMM yyyy H:mm z", "d MMM yyyy H:mm:ss", "d MMM yyyy H:mm"]


def parse_iso(value: Column) -> Column:
    """ISO 8601 date or time; without an offset it is UTC; NULL when unreadable."""
    clean = F.trim(value)
    return F.when(clean.rlike(_ISO_DATE), F.try_to_timestamp(clean))


def parse_mail_date(value: Column) -> Column:
    """RFC 822 date. The weekday is dropped: the parser rejects pattern letter E."""
    bare = F.regexp_replace(F.trim(value), r"^[A-Za-z]{3,9},?\s+(?=\d)", "")
    bare = F.regexp_replace(bare, r"\s+", " ")
    bare = F.regexp_replace(bare, r"\s+\([^)]*\)$", "")
    return F.when(value.rlike(_MAIL_DATE),
                  F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in _MAIL_FORMATS]))


def parse_published(value: Column) -> Column:
    """Mail date first, then ISO; unreadable dates are NULL and their rows are kept."""
    return F.coalesce(parse_mail_date(value), parse_iso(value))


def parse_iso_first(value: Column) -> Column:
    return F.coalesce(parse_iso(value), parse_mail_date(value))


def short_iso(value: Column) -> Column:
    """ISO only, and only texts of at most 64 characters."""
    clean = F.trim(F.coalesce(value, F.lit("")))
    return F.when(F.length(clean) <= 64, parse_iso(clean))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3_600_000_000.0)


def previous_month(day: Column) -> Column:
    """The last complete calendar month before a day, as yyyy-MM."""
    return F.date_format(F.add_months(F.trunc(day, "month"), -1), "yyyy-MM")


def day_ordinal(day: Column) -> Column:
    """Days counted from 0001-01-01 as day 1."""
    return F.datediff(day, F.lit("0001-01-01").cast("date")) + 1
