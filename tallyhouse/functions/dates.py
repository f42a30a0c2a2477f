"""Day/month/year text to dates, recency, and epoch seconds."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.columns import ColumnLike, as_column

# Days and months may roll over, so any number of digits is read.
_DAY_MONTH_YEAR = r"^[\x00-\x20]*(\d+/\d+/\d+)"
_CLOCK = r"^[\x00-\x20]*\S+\s+(\d{1,2}:\d{1,2}(?::\d{1,2})?)(?![\d:])"
# Years that a date can hold, and bounds of what may roll over within them.
_LAST_YEAR = 9999
_MOST_MONTHS, _MOST_DAYS = 12 * _LAST_YEAR, 366 * _LAST_YEAR
RECENT_DAYS = 30


def default_pivot_year(today: datetime.date | None = None) -> int:
    """Two-digit years from the pivot on belong to the 1900s: 20 years ahead of today."""
    return ((today or datetime.date.today()).year + 20) % 100


def _matched(text: ColumnLike, pattern: str, group: int) -> Column:
    """What a group matched, null where it did not match."""
    return F.nullif(F.regexp_extract(as_column(text), pattern, group), F.lit(""))


def date_parts(text: ColumnLike) -> Column:
    """Day, month and year digits of ``d/M/y`` text as an array, null where it is no such date."""
    return F.split(_matched(text, _DAY_MONTH_YEAR, 1), "/")


def _numbers(parts: ColumnLike, pivot_year: int | None) -> tuple[Column, Column, Column]:
    """Day, month and full year."""
    pivot = default_pivot_year() if pivot_year is None else pivot_year
    day, month, year_text = (F.get(as_column(parts), position) for position in range(3))
    number = year_text.try_cast("int")
    century = F.when(F.length(year_text) != 2, 0).when(number < pivot, 2000).otherwise(1900)
    return day.try_cast("int"), month.try_cast("int"), number + century


def date_of_parts(parts: ColumnLike, pivot_year: int | None = None) -> Column:
    """:func:`lenient_date` of parts found before; as a column of their own they are found once."""
    day, month, year = _numbers(parts, pivot_year)
    near = (year <= _LAST_YEAR) & (month <= _MOST_MONTHS) & (day <= _MOST_DAYS)
    date = F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1), day - 1)
    return F.when(near & (F.year(date) <= _LAST_YEAR), date)


def lenient_date(text: ColumnLike, pivot_year: int | None = None) -> Column:
    """Date from ``d/M/y`` text, rolling over-large days and months forward.

    Text after the date is ignored. Exactly two year digits fall in the hundred
    years that start at the pivot; other digit counts are taken literally.
    Text that is no such date, or one after the year 9999, gives null.
    """
    return date_of_parts(date_parts(text), pivot_year)


def strict_date_of_parts(parts: ColumnLike, pivot_year: int | None = None) -> Column:
    """:func:`strict_date` of parts found before."""
    day, month, year = _numbers(parts, pivot_year)
    possible = month.between(1, 12) & day.between(1, 31)
    return F.when(possible, F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month, day)).try_cast("date")


def strict_date(text: ColumnLike, pivot_year: int | None = None) -> Column:
    """As :func:`lenient_date`, but days and months that do not exist give null."""
    return strict_date_of_parts(date_parts(text), pivot_year)


def clock_of(text: ColumnLike) -> Column:
    """The ``H:mm[:ss]`` after a date text as an interval, null if there is none that can be read."""
    parts = F.split(_matched(text, _CLOCK, 1), ":")
    hours, minutes = F.get(parts, 0).cast("int"), F.get(parts, 1).cast("int")
    seconds = F.coalesce(F.get(parts, 2).cast("int"), F.lit(0))
    readable = (hours < 24) & (minutes < 60) & (seconds < 60)
    return F.when(readable, F.make_dt_interval(F.lit(0), hours, minutes, seconds.cast("decimal(18,6)")))


def is_recent(
    date: ColumnLike,
    as_of: ColumnLike | datetime.date | None = None,
    days: int = RECENT_DAYS,
    exclude_future: bool = False,
) -> Column:
    """True for dates less than ``days`` before ``as_of`` (today by default).

    Later dates count as recent unless ``exclude_future``; null dates never do.
    """
    if as_of is None:
        as_of = F.current_date()
    elif isinstance(as_of, datetime.date):
        as_of = F.lit(as_of)
    date, as_of = as_column(date).cast("date"), as_column(as_of)
    # Kept as a bound on the bare column so that it reaches the file scan.
    recent = date > F.date_sub(as_of, days)
    return recent & (date <= as_of) if exclude_future else recent


def epoch_seconds(moment: ColumnLike) -> Column:
    """Whole seconds since 1970, of zoned and zone-less timestamps alike, whatever the session zone.

    A zone-less timestamp is read as UTC. The column's type picks the way when the query is planned.
    """
    given = as_column(moment)
    local = given.cast("timestamp_ntz")
    of_local = (
        F.unix_date(local.cast("date")).cast("long") * 86400
        + F.hour(local) * 3600
        + F.minute(local) * 60
        + F.second(local)
    )
    return F.when(F.typeof(given) == "timestamp", F.unix_seconds(given.cast("timestamp"))).otherwise(of_local)
