"""Wall-clock arithmetic.

All functions take and return ``timestamp_ntz`` and use interval arithmetic
only, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# First and last minute of a day as used for stays over midnight,
# the hours of the day band and its labels, and the accepted timestamp text.
DAY_START = 1  # 00:01, in minutes of the day
DAY_END = 23 * 60 + 59  # 23:59
DAY_BAND = (8, 19)
DAY_LABEL = "8AM-7PM"
NIGHT_LABEL = "8PM-7AM"
TIMESTAMP_TEXT = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def minutes(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def parse(c: Column, data_type: T.DataType) -> Column:
    """Typed timestamps pass; text must read ``yyyy-MM-dd HH:mm:ss``; the rest is null."""
    if isinstance(data_type, T.StringType):
        return F.when(c.rlike(TIMESTAMP_TEXT), c.try_cast("timestamp_ntz"))
    return c.cast("timestamp_ntz")


def _midnight(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def floor_second(ts: Column) -> Column:
    return _midnight(ts) + F.make_dt_interval(F.lit(0), F.hour(ts), F.minute(ts), F.second(ts))


def floor_minute(ts: Column) -> Column:
    return _midnight(ts) + F.make_dt_interval(F.lit(0), F.hour(ts), F.minute(ts))


def floor_hour(ts: Column) -> Column:
    return _midnight(ts) + F.make_dt_interval(F.lit(0), F.hour(ts))


def nearest_hour(ts: Column) -> Column:
    """Down below minute 30, up from minute 30 on."""
    return floor_hour(ts + minutes(30))


def off_midnight(ts: Column, direction: Column) -> Column:
    """Move swipes of the minute 00:00 one minute into the day they belong to."""
    at_midnight = (F.hour(ts) == 0) & (F.minute(ts) == 0)
    return (
        F.when(at_midnight & (direction == "in"), ts + minutes(1))
        .when(at_midnight & (direction == "out"), ts - minutes(1))
        .otherwise(ts)
    )


def signed_minutes(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, cut towards zero."""
    return (end - start).cast("interval minute").cast("bigint")


def stay_minutes(start: Column, end: Column) -> Column:
    return F.abs(signed_minutes(start, end))


def at_minute(ts: Column, minute_of_day: int) -> Column:
    """The given minute on the day of ts."""
    return _midnight(ts) + minutes(minute_of_day)


def hour_bins(first: Column, last: Column) -> Column:
    """Every hour from first to last, both included."""
    return F.sequence(first, last, F.make_dt_interval(F.lit(0), F.lit(1)))


def time_text(ts: Column) -> Column:
    """``HH:mm:ss``, cut from the text form because `date_format` would go through the zone."""
    return F.substring(ts.cast("string"), 12, 8)


def time_group(ts: Column) -> Column:
    return F.when(F.hour(ts).between(*DAY_BAND), DAY_LABEL).otherwise(NIGHT_LABEL)


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")
