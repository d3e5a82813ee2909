"""ISO-ish text -> epoch milliseconds for datetime cells.

Accepted, in order: ``%Y-%m-%dT%H:%M:%S``, ``%Y-%m-%d %H:%M:%S``,
``%Y-%m-%d``, then ISO 8601 (``Z`` read as UTC, ``,`` as the decimal
separator, week dates). Naive values are wall-clock time in ``tz`` (a parameter, not the
session zone). Anything else is NULL. Text that Spark's cast accepts but the
original parser rejects (a bare year, a year and month) is gated out first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

# The accepted leading date shapes, strict (zero-padded) ISO
# 8601 text, and an explicit UTC offset.
_DATE_HEAD = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_COMPACT = r"^[0-9]{8}$"
_STRICT_ISO = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
               r"(?:[T ][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?)?)?"
               r"(?:Z|[+-][0-9]{2}(?::?[0-9]{2})?)?$")
_OFFSET = r"[+-][0-9]{2}(:?[0-9]{2})?$"
_NAIVE_FORMATS = ("y-M-d'T'H:m:s", "y-M-d H:m:s", "y-M-d")


# Week dates of ISO 8601, with marks or without, and the strict time that may follow.
_TIME_TAIL = r"((?:[T ][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?)?)?(?:Z|[+-][0-9]{2}(?::?[0-9]{2})?)?)$"
_WEEK_DATE = r"^([0-9]{4})(?:-W([0-9]{2})(?:-([1-7]))?|W([0-9]{2})([1-7])?)" + _TIME_TAIL


def _week_date(text: Column) -> Column:
    """The text with its ISO week date written as a calendar date; null if there is no such week."""
    def group(n: int) -> Column:
        return F.nullif(F.regexp_extract(text, _WEEK_DATE, n), F.lit("")).try_cast("int")

    week, day = F.coalesce(group(2), group(4)), F.coalesce(group(3), group(5), F.lit(1))
    # week 1 holds the 4th of January; weeks start on Monday
    first = F.date_trunc("week", F.try_make_timestamp(years=group(1), months=F.lit(1), days=F.lit(4), hours=F.lit(0),
                                                      mins=F.lit(0), secs=F.lit(0))).cast("date")
    date = F.date_add(first, (week - 1) * 7 + day - 1)
    return F.when((week > 0) & (F.weekofyear(date) == week),
                  F.concat(F.date_format(date, "yyyy-MM-dd"), F.regexp_extract(text, _WEEK_DATE, 6)))


def clean_datetime_text(c) -> Column:
    """The text stripped of Python whitespace at both ends, week dates as calendar dates."""
    text = py_strip(F.col(c) if isinstance(c, str) else c)
    return F.when(text.rlike(_WEEK_DATE), _week_date(text)).otherwise(text)


def _naive(fmt: str, sc: Column) -> Column:
    # parse, then back to wall-clock (NTZ): independent of the session zone
    return F.try_to_timestamp(sc, F.lit(fmt)).cast("timestamp_ntz")


def epoch_ms_from_clean(st: Column, tz: str = "UTC") -> Column:
    """Epoch ms of stripped text (see ``clean_datetime_text``)."""
    # the three strptime-style shapes: any run of spaces matches one space,
    # fields need not be zero-padded
    sc = F.regexp_replace(st, r"\s+", " ")
    naive_fmt = F.coalesce(*[_naive(f, sc) for f in _NAIVE_FORMATS])
    # ISO 8601: zero-padded fields, 'T' or one space, ',' or '.' before the
    # fraction, 'Z' or an offset
    iso_ok = st.rlike(_STRICT_ISO)
    iso = F.regexp_replace(F.regexp_replace(st, ",", "."), "Z$", "+00:00")
    # Spark's cast wants seconds when an offset follows: HH:MM -> HH:MM:00, HH -> HH:00:00
    day_hour = "^([0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}"
    iso = F.regexp_replace(iso, day_hour + ":[0-9]{2})(?![:0-9])", "$1:00")
    iso = F.regexp_replace(iso, day_hour + ")(?![:0-9])", "$1:00:00")
    naive_iso = F.when(iso_ok & ~iso.rlike(_OFFSET), iso.try_cast("timestamp_ntz"))
    naive = F.coalesce(naive_fmt, naive_iso)
    naive = F.when(st.rlike(_COMPACT), _naive("yyyyMMdd", st)).otherwise(naive)
    utc_wall = F.convert_timezone(F.lit(tz), F.lit("UTC"), naive)
    naive_ms = F.timestamp_diff("MILLISECOND",
                                F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), utc_wall)
    aware_ms = F.unix_millis(F.when(iso_ok & iso.rlike(_OFFSET), iso.try_cast("timestamp")))
    ms = F.coalesce(naive_ms, aware_ms)
    return F.when(st.rlike(_DATE_HEAD) | st.rlike(_COMPACT), ms)


def to_epoch_ms(c, tz: str = "UTC") -> Column:
    return epoch_ms_from_clean(clean_datetime_text(c), tz)
