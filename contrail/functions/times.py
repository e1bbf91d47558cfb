"""Second-grained time arithmetic on TIMESTAMP_NTZ columns.

Built on interval arithmetic instead of ``timestampdiff`` and ``date_trunc``: those convert to the
session time zone first, so a daylight-saving change would move the result.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F

PERIOD_DAYS = 10

_YEAR_ONE = "0001-01-01 00:00:00"


def clock_seconds(moment: Column) -> Column:
    """Whole seconds since year one, the fraction cut off."""
    origin = F.lit(_YEAR_ONE).cast("timestamp_ntz")
    return (moment - origin).cast("interval second").cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries crossed from ``start`` to ``end``."""
    return clock_seconds(end) - clock_seconds(start)


def plus_seconds(moment: Column, seconds: Column) -> Column:
    return moment + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def span_start(moment: Column, seconds: int) -> Column:
    """Start of the span of that many seconds, counted from year one, which the moment lies in."""
    origin = F.lit(_YEAR_ONE).cast("timestamp_ntz")
    return plus_seconds(origin, clock_seconds(moment) - F.pmod(clock_seconds(moment), F.lit(seconds)))


def share_of_seconds(total: Column, part: Column, whole: Column) -> Column:
    """``total * part / whole`` rounded half up, in integers so that no engine can differ.

    All three are non-negative integers, ``whole`` is positive.
    """
    return F.call_function("div", total * part * 2 + whole, whole * 2)


def year_start(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "year")


def period_slot(moment: Column) -> Column:
    """Position of the 10-day period within its year, 0 to 36."""
    return F.floor((F.dayofyear(moment) - 1) / PERIOD_DAYS).cast("int")


def period_of(day: date) -> tuple[int, int]:
    """Year and slot of a day, as ``period_slot`` gives it."""
    return day.year, (day.timetuple().tm_yday - 1) // PERIOD_DAYS


def period_days(year: int, slot: int) -> tuple[date, date]:
    """First and last day of a slot; the last slot of a year is shorter."""
    start = date(year, 1, 1) + timedelta(days=slot * PERIOD_DAYS)
    return start, min(start + timedelta(days=PERIOD_DAYS - 1), date(year, 12, 31))
