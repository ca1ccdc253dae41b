"""Date helpers. Everything relative takes ``as_of`` so that results can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = ("day", "week", "month", "quarter", "year", "decade")
# Day 0 of spreadsheet serial dates, and a Monday to count weeks from.
SERIAL_EPOCH = "1899-12-30"
MONDAY_EPOCH = "1970-01-05"


def as_of_date(as_of: str | dt.date | None) -> Column:
    """The reference day as a date column; the current day when none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def _unit(period: str) -> str:
    period = period.lower()
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    return period


def to_date(c: Column, fmt: str | None = None) -> Column:
    return c.try_cast("date") if fmt is None else F.try_to_date(c, fmt)


def to_datetime(c: Column, fmt: str | None = None) -> Column:
    return c.try_cast("timestamp") if fmt is None else F.try_to_timestamp(c, F.lit(fmt))


def to_text(c: Column, fmt: str | None = None) -> Column:
    """Text of a value; ``fmt`` is a date pattern."""
    return c.cast("string") if fmt is None else F.date_format(c, fmt)


def period_index(c: Column, period: str) -> Column:
    """Number of the day / week / month ... a date lies in, counted from a fixed origin."""
    period = _unit(period)
    d = c.cast("date")
    days = F.datediff(d, F.lit(MONDAY_EPOCH).cast("date"))
    if period == "day":
        return days.cast("bigint")
    if period == "week":
        return F.floor(days / 7).cast("bigint")
    year = F.year(d).cast("bigint")
    if period == "month":
        return year * 12 + F.month(d) - 1
    if period == "quarter":
        return year * 4 + F.quarter(d) - 1
    if period == "year":
        return year
    return F.floor(year / 10).cast("bigint")


def time_period_offset(c: Column, period: str, as_of=None) -> Column:
    """Periods between the current period and the one ``c`` lies in (last month = -1)."""
    return period_index(c, period) - period_index(as_of_date(as_of), period)


def time_period(c: Column, period: str) -> Column:
    """First day of the period ``c`` lies in."""
    period = _unit(period)
    d = c.cast("date")
    if period == "day":
        return d
    if period == "decade":
        return F.make_date((F.floor(F.year(d) / 10) * 10).cast("int"), F.lit(1), F.lit(1))
    return F.date_trunc(period, d).cast("date")


def period_name(start: Column, period: str) -> Column:
    """Label of a period given its first day: 2025-01-31, Jan 2025, Q1 2025, 2025, 2020s."""
    period = _unit(period)
    if period in ("day", "week"):
        return F.date_format(start, "yyyy-MM-dd")
    if period == "month":
        return F.date_format(start, "MMM yyyy")
    if period == "quarter":
        return F.concat(F.lit("Q"), F.quarter(start).cast("string"), F.lit(" "), F.year(start).cast("string"))
    if period == "year":
        return F.year(start).cast("string")
    return F.concat(F.year(start).cast("string"), F.lit("s"))


def date_add(c: Column, n: Column | int, period: str) -> Column:
    """Shift a date by whole periods; a month end clamps."""
    n = F.lit(n) if isinstance(n, int) else n
    period = _unit(period)
    d = c.cast("date")
    if period in ("day", "week"):
        return F.date_add(d, (n * (7 if period == "week" else 1)).cast("int"))
    months = {"month": 1, "quarter": 3, "year": 12, "decade": 120}[period]
    return F.add_months(d, (n * months).cast("int"))


def date_diff(end: Column, start: Column, period: str) -> Column:
    """Completed periods from ``start`` to ``end``."""
    return F.timestamp_diff(_unit(period).upper(), start.cast("timestamp"), end.cast("timestamp"))


def day_of_week(c: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(c) + 1


def days_in_month(c: Column) -> Column:
    return F.dayofmonth(F.last_day(c))


def days_in_year(c: Column) -> Column:
    return F.dayofyear(F.make_date(F.year(c), F.lit(12), F.lit(31)))


def day_name(c: Column) -> Column:
    return F.date_format(c, "EEEE")


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMMM")


def next_day(c: Column) -> Column:
    return F.date_add(c.cast("date"), 1)


def previous_day(c: Column) -> Column:
    return F.date_sub(c.cast("date"), 1)


def _utc_offset_minutes(c: Column, zone: str) -> Column:
    ts = c.cast("timestamp")
    return (F.unix_micros(F.from_utc_timestamp(ts, zone)) - F.unix_micros(ts)) / 60_000_000


def during_daylight_saving(c: Column, zone: str = "America/New_York") -> Column:
    """True when the zone's clock is ahead of its standard time at that UTC moment."""
    year = F.year(c)
    january = F.make_date(year, F.lit(1), F.lit(1))
    july = F.make_date(year, F.lit(7), F.lit(1))
    standard = F.least(_utc_offset_minutes(january, zone), _utc_offset_minutes(july, zone))
    return _utc_offset_minutes(c, zone) > standard


def during_standard(c: Column, zone: str = "America/New_York") -> Column:
    return ~during_daylight_saving(c, zone)


def excel_serial_date(c: Column) -> Column:
    """Date of a spreadsheet serial number."""
    n = c.try_cast("double")
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), F.floor(n).cast("int"))


def excel_serial_datetime(c: Column) -> Column:
    """Timestamp of a spreadsheet serial number; the fraction is the time of day."""
    n = c.try_cast("double")
    seconds = F.round((n - F.floor(n)) * 86400).cast("bigint")
    start = F.unix_seconds(excel_serial_date(c).cast("timestamp"))
    return F.timestamp_seconds(start + seconds)


def business_day_index(c: Column) -> Column:
    """Running count of weekdays; a weekend day counts as its Friday.

    The difference of two indexes is the gap in business days.
    """
    n = F.datediff(c.cast("date"), F.lit(MONDAY_EPOCH).cast("date"))
    return (F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(4))).cast("bigint")
