"""Date and time parsing. Every bound is an explicit ``as_of`` moment."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = r"^\d{4}-\d{2}-\d{2}"
_MOMENT = _DAY + r"([T ]\d{2}:\d{2}:\d{2}.*)?$"
_DAY_TEXT = _DAY + r"([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def moment(value: str | date | datetime | Column) -> Column:
    """Wall-clock literal, e.g. ``moment("2001-08-02")``."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def parse_day(value: Column) -> Column:
    """Date from ``yyyy-MM-dd``, alone or with a time of day; nothing else may follow."""
    text = F.trim(value)
    return F.when(text.rlike(_DAY_TEXT), F.substring(text, 1, 10).try_cast("date"))


def parse_moment(value: Column) -> Column:
    """Wall clock, microseconds kept, from ISO text without an offset."""
    text = F.trim(value)
    return F.when(text.rlike(_MOMENT), text.try_cast("timestamp_ntz"))


def day_until(value: Column, as_of, earliest: str | None = None) -> Column:
    """Date not after ``as_of`` (and not before ``earliest``) or NULL."""
    day = parse_day(value)
    fits = day <= F.to_date(moment(as_of))
    if earliest is not None:
        fits = fits & (day >= F.lit(earliest).cast("date"))
    return F.when(fits, day)


def seconds_moment(value: Column) -> Column:
    """Wall clock read from the first 19 characters."""
    return parse_moment(F.substring(F.trim(value), 1, 19))


def moment_or(value: Column, as_of) -> Column:
    """Parsed wall clock, replaced by ``as_of`` if missing, broken or later."""
    parsed = parse_moment(value)
    limit = moment(as_of)
    return F.when(parsed <= limit, parsed).otherwise(limit)


def fixed_offset_clock(value: Column, hours: int = 3) -> Column:
    """Wall clock at a whole-hour offset of ISO text; text without a zone is kept.

    Plain microsecond arithmetic: no zone lookup per row and no dependence on
    the session time zone.
    """
    micros = F.unix_micros(value.try_cast("timestamp")) + hours * 3_600_000_000
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    clock = F.timestamp_add("MICROSECOND", micros, epoch)
    return F.when(value.rlike(_OFFSET), clock).otherwise(parse_moment(value))


def date_key(day: Column) -> Column:
    """Integer ``yyyyMMdd``."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(ts: Column) -> Column:
    """Integer ``yyyyMM``, the partition value of raw tables."""
    return F.year(ts) * 100 + F.month(ts)


def days_before(as_of, ts: Column) -> Column:
    """Whole calendar days from ``ts`` to ``as_of``; negative in the future."""
    return F.datediff(F.to_date(moment(as_of)), F.to_date(ts))


def within_days(as_of, ts: Column, days: int, past_only: bool = False) -> Column:
    age = days_before(as_of, ts)
    return age.between(0, days) if past_only else age <= days
