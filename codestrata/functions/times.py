"""Time expressions.  Nothing here reads the clock: ``as_of`` is always passed in."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def instant(value: str | dt.datetime | Column) -> Column:
    """An instant from a column, an aware or naive (UTC) datetime, or an ISO text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    since_epoch = value - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(since_epoch // dt.timedelta(microseconds=1)))


#: A full date, a time, and ``Z`` or an offset.  Spark alone would also take a bare date, a bare time (of today), or a zone's name.
COMPLETE = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d+)? ?(Z|[+-]\d\d:?\d\d)$"
WEEK_DATE = r"^(\d{4})-?W(\d\d)(?:-?([1-7]))?(?=[T ])"
#: Shorter and other forms of the same, one after another, each as the next longer one.
FORMS = [
    (r"^(\d{4})(\d\d)(\d\d)(?=[T ])", "$1-$2-$3"),  # 20240131
    (r"^(.{10}[T ]\d\d)(\d\d)(\d\d)(?!\d)", "$1:$2:$3"),  # 101500
    (r"^(.{10}[T ]\d\d)(\d\d)(?!\d)", "$1:$2"),  # 1015
    (r"^(.{10}[T ]\d\d)(?= ?[Z+-])", "$1:00"),
    (r"^(.{10}[T ]\d\d:\d\d)(?= ?[Z+-])", "$1:00"),
    (r"^(.{19}),(?=\d)", "$1."),
    (r"^(.{19}.*[+-]\d\d)$", "$1:00"),
]
#: An offset that goes on with seconds.
OFFSET_SECONDS = r"^(.{19}.*[+-]\d\d:?\d\d):?(\d\d)$"


def _calendar_date(text: Column) -> Column:
    """``2024-W05-3...`` with the calendar date instead; other texts as they are."""
    part = lambda i: F.nullif(F.regexp_extract(text, WEEK_DATE, i), F.lit("")).try_cast("int")
    january = F.make_date(part(1), F.lit(1), F.lit(4))  # always in the first week
    week = part(2)
    date = F.date_add(january, (week - 1) * 7 + F.coalesce(part(3), F.lit(1)) - 1 - F.weekday(january))
    thursday = F.date_add(january, (week - 1) * 7 + 3 - F.weekday(january))
    there = (week >= 1) & (F.year(thursday) == part(1))  # week 53 of some years only
    rest = F.regexp_replace(text, WEEK_DATE, "")
    return F.when(~text.rlike(WEEK_DATE), text).when(there, F.concat(F.date_format(date, "yyyy-MM-dd"), rest))


def parse_commit_time(text: Column) -> Column:
    """ISO 8601, extended or basic, also with week dates, with ``Z`` or an offset, or ``YYYY-MM-DD HH:MM:SS +HHMM``; null if neither.  A
    text without date, time or offset is null and never filled up from the clock."""
    full = _calendar_date(text)
    for form, longer in FORMS:
        full = F.regexp_replace(full, form, longer)
    seconds = F.nullif(F.regexp_extract(full, OFFSET_SECONDS, 2), F.lit("")).try_cast("int")
    ahead = F.when(F.regexp_extract(full, r"([+-])[\d:]+$", 1) == "-", seconds).otherwise(-seconds)
    full = F.regexp_replace(full, OFFSET_SECONDS, "$1")
    moment = F.try_to_timestamp(F.when(full.rlike(COMPLETE), full))
    return F.timestamp_micros(F.unix_micros(moment) + F.coalesce(ahead, F.lit(0)).cast("bigint") * 1_000_000)


def minus_days(moment: Column, days: int) -> Column:
    return F.timestamp_micros(F.unix_micros(moment) - F.lit(days * MICROS_PER_DAY))


def days_between(earlier: Column, later: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded down; negative if the order is reversed."""
    gap = F.unix_micros(later) - F.unix_micros(earlier)
    return F.round((gap - F.pmod(gap, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)).cast("int")


def iso_text(moment: Column, source: Column | None = None) -> Column:
    """``2024-01-31T10:00:00[.ffffff]+00:00``; the fraction only where there is one.  With the
    ``source`` text the moment was read from, in the offset of that text."""
    offset = F.lit("")
    if source is not None:
        offset = F.coalesce(F.regexp_extract(source, r"\d ?([+-]\d\d(?::?\d\d)?)$", 1), F.lit(""))
    offset = F.when(F.length(offset) == 3, F.concat(offset, F.lit("00"))).otherwise(offset)
    minutes = F.concat(F.substring(offset, 1, 1), F.right(offset, F.lit(2))).try_cast("int")
    hours = F.substring(offset, 1, 3).try_cast("int")
    seconds = F.coalesce(hours * 3600 + minutes * 60, F.lit(0))
    local = F.timestamp_micros(F.unix_micros(moment) + seconds.cast("bigint") * 1_000_000)
    fraction = F.when(
        F.pmod(F.unix_micros(moment), F.lit(1_000_000)) != 0, F.date_format(local, ".SSSSSS")
    ).otherwise(F.lit(""))
    shown = F.when(offset == "", F.lit("+00:00")).otherwise(
        F.concat(F.substring(offset, 1, 3), F.lit(":"), F.right(offset, F.lit(2)))
    )
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), fraction, shown)
