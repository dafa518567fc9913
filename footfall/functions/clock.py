"""Calendar and business-clock arithmetic on ``timestamp_ntz`` columns.

Everything is integer arithmetic on the seconds since a fixed origin. Naive
timestamps subtract without a time zone, so no result depends on the one of the
session (``date_trunc`` and ``date_format`` would go through it), and one
subtraction is several times cheaper than extracting hour, minute and second.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The business day runs from 06:00 to 05:59, six hours behind the calendar.
BUSINESS_OFFSET_HOURS = -6

# Before every capture, so that seconds count up from 0 and division truncates down.
_ORIGIN = "0001-01-01"


def seconds(ts: Column) -> Column:
    """Whole seconds since the origin."""
    since = ts - F.lit(_ORIGIN).cast("timestamp_ntz")
    return since.cast("interval second").cast("long")


def from_seconds(value: Column) -> Column:
    return F.lit(_ORIGIN).cast("timestamp_ntz") + F.expr("INTERVAL '1' SECOND") * value


def shift_hours(ts: Column, hours: int | Column) -> Column:
    return ts + F.expr("INTERVAL '1' HOUR") * hours


def business_time(ts: Column, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    return shift_hours(ts, offset_hours)


def business_date(ts: Column, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    day = truncating_div(seconds(ts) + 3600 * offset_hours, 86400)
    return F.date_add(F.lit(_ORIGIN).cast("date"), day.cast("int"))


def hour_floor(ts: Column, offset_hours: int = 0) -> Column:
    """Start of the hour, on the clock that is ``offset_hours`` ahead."""
    return from_seconds((hour_index(ts) + offset_hours) * 3600)


def business_hour(ts: Column, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    return hour_floor(ts, offset_hours)


def second_floor(ts: Column) -> Column:
    """Drop the fraction of a second: captures have second grain."""
    return from_seconds(seconds(ts))


def hour_index(ts: Column) -> Column:
    return truncating_div(seconds(ts), 3600)


def minute_index(ts: Column) -> Column:
    return truncating_div(seconds(ts), 60)


def minute_of_day(ts: Column) -> Column:
    return (minute_index(ts) % 1440).cast("int")


def second_of_day(ts: Column) -> Column:
    return (seconds(ts) % 86400).cast("int")


def hour_label(ts: Column) -> Column:
    """``HH:00``."""
    return F.concat(F.lpad((hour_index(ts) % 24).cast("string"), 2, "0"), F.lit(":00"))


def hour_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:00:00``."""
    return F.concat(F.to_date(ts).cast("string"), F.lit(" "), hour_label(ts), F.lit(":00"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    return (end - start).cast("interval second").cast("long")


def boundary_minutes(start: Column, end: Column) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:00 is 1."""
    return minute_index(end) - minute_index(start)


def boundary_hours(start: Column, end: Column) -> Column:
    """Hour boundaries crossed: 05:59 to 06:00 is 1."""
    return hour_index(end) - hour_index(start)


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Whole minutes, rounded towards minus infinity: -1 s is -1."""
    return flooring_div(elapsed_seconds(start, end), 60)


def fractional_minutes(start: Column, end: Column) -> Column:
    return elapsed_seconds(start, end) / F.lit(60.0)


def truncating_div(a: Column, b: int) -> Column:
    """Integer division towards zero: -7 by 5 is -1."""
    return F.call_function("div", a, F.lit(b))


def flooring_div(a: Column, b: int) -> Column:
    """Division towards minus infinity: -7 by 5 is -2. Exact below 2**50."""
    return F.floor(a / F.lit(b))


def months_before(date: Column, months: int) -> Column:
    return F.add_months(date, -months)


def days_before(date: Column, days: int) -> Column:
    return F.date_sub(date, days)
