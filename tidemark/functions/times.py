"""Dates and clocks. No function here reads the clock; callers pass the moment in."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Freshness deadline, its zone, the text that stands for "no time".
CUT_OFF = "11:59:00"
CUT_OFF_ZONE = "EST5EDT"
NOT_AVAILABLE = "NA"


def as_date(value: dt.date | str) -> dt.date:
    """A date argument as a date: accepts dates, ``2024-01-15`` and ``20240115``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def day_in(df: DataFrame, value: dt.date | str) -> Column:
    """A date literal of the type ``as_of_date`` has in ``df``.

    Comparing like with like lets the filter reach the partitions, also where the
    partition key is text.
    """
    return F.lit(as_date(value)).cast(df.schema["as_of_date"].dataType)


def timestamp(value: dt.datetime | str) -> Column:
    """A wall-clock moment as a timestamp literal in the session zone."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp")


def wall_clock(value: Column | dt.datetime | str) -> Column:
    """The same without a zone."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


# Forms a status time may have besides the standard one: the basic form, a day in front.
STATUS_PATTERNS = ("yyyyMMdd'T'HHmmss", "yyyyMMdd", "M/d/yyyy HH:mm[:ss]", "M/d/yyyy",
                   "yyyy-MM-dd'T'HH.mm.ss[.SSS]")


def status_time(column: Column, patterns: Sequence[str] = STATUS_PATTERNS) -> Column:
    """Parse a status time; "no time" and text of no known form become NULL.

    The date is the one written in the text, whatever the session zone.
    """
    text = F.nullif(column.cast("string"), F.lit(NOT_AVAILABLE))
    others = [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in patterns]
    return F.coalesce(text.try_cast("timestamp_ntz"), *others)


def next_ingest_at(day: Column) -> Column:
    """09:00 on the day after a snapshot date."""
    return day.cast("timestamp_ntz") + F.expr("INTERVAL 33 HOURS")


def previous_day(day: Column) -> Column:
    return F.date_sub(day, 1)


def local_time_of_day(now_utc: Column, zone: str = CUT_OFF_ZONE) -> Column:
    """``HH:mm:ss`` of a UTC moment in a zone, daylight saving included."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), now_utc.cast("timestamp_ntz"))
    return F.date_format(local, "HH:mm:ss")


def before_cut_off(now_utc: Column, cut_off: str = CUT_OFF, zone: str = CUT_OFF_ZONE) -> Column:
    return local_time_of_day(now_utc, zone) < F.lit(cut_off)


def run_variables(as_of: dt.date | str) -> dict[str, str]:
    """Values a stored query may refer to: the date, the next ingest time, the day before."""
    day = as_date(as_of)
    midnight = dt.datetime.combine(day, dt.time())
    return {
        "as_of_date": str(day),
        "next_ingest_date": str(midnight + dt.timedelta(days=1, hours=9)),
        "prev_ingest_date": str(day - dt.timedelta(days=1)),
    }
