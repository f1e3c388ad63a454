"""Clock strings (``HHMM``) to timestamps, and roll-over past midnight."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_UTC = ("UTC", "Etc/UTC", "Z", "GMT")


def clock_number(hhmm: Column) -> Column:
    """The clock as a number, 0610 being 610.

    Other characters are dropped, the digits zero-padded to four and cut after four; NULL when
    the text holds no digit. Up to four plain digits, the usual case, need no pattern matching. Blanks
    are left out first: for each text that is no number a cast raises and catches an exception.
    """
    length = F.length(F.trim(hhmm))
    plain = F.when(length <= 4, F.abs(hhmm.try_cast("int")))
    digits = F.regexp_replace(hhmm, r"[^0-9]", "")
    other = F.when(digits != "", F.lpad(digits, 4, "0").cast("int"))
    return F.when(length > 0, F.coalesce(plain, other))


def clock_timestamp(day: Column, hhmm: Column) -> Column:
    """The moment ``hhmm`` on ``day``; NULL for blanks and impossible clocks such as 2400."""
    return number_timestamp(day, clock_number(hhmm))


def number_timestamp(day: Column, clock: Column) -> Column:
    """The moment ``clock`` (a ``clock_number``) on ``day``.

    It refers to the number several times. Where several clocks of a row are parsed, numbers that are columns of their own
    are parsed once, and the code of the projection stays small. In UTC, the usual zone, seconds are added to the day;
    taking the day apart and looking up the offset costs several times as much, for each clock of each row.
    """
    minute = clock % 100
    if SparkSession.active().conf.get("spark.sql.session.timeZone") in _UTC:
        # 36 * (100 * hour + minute) + 24 * minute = 3600 * hour + 60 * minute
        moment = F.timestamp_seconds(F.unix_date(day).cast("long") * 86400 + clock * 36 + minute * 24)
    else:
        hour = (clock / 100).cast("int")
        moment = F.make_timestamp(F.year(day), F.month(day), F.day(day), hour, minute, F.lit(0))
    return F.when((clock < 2400) & (minute < 60), moment)


def roll_overnight(start: Column, end: Column) -> Column:
    """``end``, moved to the next day when its clock lies before ``start``."""
    return F.when(end < start, end + F.expr("INTERVAL 1 DAY")).otherwise(end)
