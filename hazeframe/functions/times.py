"""Time parsing, truncation and window-bound expressions (session zone UTC)."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions.aqi import _col


def parse_unix(text) -> Column:
    """Epoch-seconds text -> timestamp, NULL when not an integer."""
    return F.timestamp_seconds(_col(text).try_cast("bigint"))


def parse_iso(text) -> Column:
    """ISO-8601 text (optional fraction, 'Z' or offset) -> timestamp or NULL."""
    return F.try_to_timestamp(_col(text))


def parse_date(text) -> Column:
    return _col(text).try_cast("date")


def station_time_to_utc(iso, local_text, offset, fallback=None, zone: str = fv.LOCAL_ZONE) -> Column:
    """Observation time in UTC: ISO text, else local text + offset, else local text.

    Text without an offset is read as wall-clock time of ``zone``.
    """
    def parsed(text: Column) -> Column:
        zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
        ts = F.try_to_timestamp(text)
        return F.when(zoned, ts).otherwise(F.to_utc_timestamp(ts, zone))

    iso, local_text, offset = _col(iso), _col(local_text), _col(offset)
    with_offset = F.when(F.coalesce(offset, F.lit("")) != "", parsed(F.concat(local_text, offset)))
    plain = F.when(F.coalesce(offset, F.lit("")) == "", parsed(local_text))
    return F.coalesce(parsed(iso), with_offset, plain, F.lit(None).cast("timestamp") if fallback is None else _col(fallback))


def hour_of(ts) -> Column:
    return F.date_trunc("hour", _col(ts))


def month_of(d) -> Column:
    return F.trunc(_col(d), "month")


def local_hour(ts, zone: str = fv.LOCAL_ZONE) -> Column:
    return F.hour(F.from_utc_timestamp(_col(ts), zone))


def iso_day_of_week(ts) -> Column:
    """Monday=1 .. Sunday=7."""
    return F.weekday(_col(ts)) + 1


def hours_between(earlier, later) -> Column:
    """Number of hour boundaries crossed, not elapsed hours."""
    def hour_no(c):
        return F.floor(F.unix_timestamp(_col(c)) / 3600)
    return (hour_no(later) - hour_no(earlier)).cast("bigint")


def comparison_ranges(first: date, last: date, max_days: int = 30) -> dict[str, date]:
    """Bounds of the current window (at most ``max_days``) and the adjacent earlier one."""
    days = min((last - first).days + 1, max_days)
    current_start = last - timedelta(days=days - 1)
    return {
        "current_start": current_start,
        "current_end": last,
        "previous_start": current_start - timedelta(days=days),
        "previous_end": current_start - timedelta(days=1),
    }


def in_range(column, start: date, end: date, unit: str = "day") -> Column:
    """Inclusive range; ``unit='hour'`` covers the whole last day of a timestamp column."""
    if unit == "hour":
        return _col(column).between(
            F.lit(datetime.combine(start, time.min)), F.lit(datetime.combine(end, time(23, 59, 59))))
    return _col(column).between(F.lit(start), F.lit(end))
