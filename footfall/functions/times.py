"""Dates, epoch values and calendar attributes."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def epoch_ms(column: str) -> Column:
    """Epoch millis of a zone-free time column, read as UTC (the session zone)."""
    return F.unix_millis(F.col(column).cast("timestamp"))


def day_start_ms(day: str) -> int:
    """Epoch millis of the first instant of ``yyyy-MM-dd`` in UTC (a literal, so
    a filter on it is pushed to the scan)."""
    return (date.fromisoformat(day) - date(1970, 1, 1)).days * DAY_MS


def yesterday() -> str:
    return (date.today() - timedelta(days=1)).isoformat()


def ms_date(ms: Column) -> Column:
    """Day of an epoch value as DATE: the narrow form to group by."""
    return F.date_from_unix_date(F.floor(ms / F.lit(DAY_MS)).cast("int"))


def ms_day(ms: Column) -> Column:
    """Day of an epoch value as ``yyyy-MM-dd`` text."""
    return ms_date(ms).cast("string")


def ms_hour(ms: Column) -> Column:
    return F.pmod(F.floor(ms / F.lit(HOUR_MS)), F.lit(24)).cast("bigint")


def nginx_ms(c: Column) -> Column:
    """``seconds.millis`` text to epoch millis; -1 when it does not parse."""
    return F.coalesce((c.try_cast("decimal(26,9)") * 1000).cast("bigint"), F.lit(-1).cast("bigint"))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference of two times, each cut to whole seconds."""
    second = F.date_trunc("SECOND", later), F.date_trunc("SECOND", earlier)
    return F.timestamp_diff("SECOND", second[1], second[0])


def date_hour(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH")


def minute_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def week_start_sunday(d: Column) -> Column:
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_of_year_us(d: Column) -> Column:
    """Weeks start on Sunday and week 1 holds January 1."""
    saturday = F.date_add(week_start_sunday(d), 6)
    return (F.floor((F.dayofyear(saturday) - 1) / 7) + 1).cast("int")
