"""Date keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Italian public holidays on a fixed date, as month * 100 + day.
FIXED_HOLIDAYS = (101, 106, 425, 501, 602, 815, 1101, 1208, 1225, 1226)

# Fixed value.
FISCAL_YEAR_FIRST_MONTH = 7


def date_key(day: Column) -> Column:
    """YYYYMMDD as an int, by arithmetic (no text formatting per row)."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def is_fixed_holiday(day: Column) -> Column:
    return (F.month(day) * 100 + F.dayofmonth(day)).isin(*FIXED_HOLIDAYS)


def is_bridge_day(day: Column, last_day: Column) -> Column:
    """Monday after a Sunday holiday, or Friday before a Saturday holiday.

    Holidays after ``last_day`` are not known, so they make no bridge day.
    """
    before, after = F.date_sub(day, 1), F.date_add(day, 1)
    monday = (F.weekday(day) == 0) & is_fixed_holiday(before)
    friday = (F.weekday(day) == 4) & is_fixed_holiday(after) & (after <= last_day)
    return monday | friday


def fiscal_year(day: Column) -> Column:
    return (F.year(day) - F.when(F.month(day) < FISCAL_YEAR_FIRST_MONTH, 1).otherwise(0)).cast("int")


def time_slot(ts: Column, minutes: int = 10) -> Column:
    """Number of the time slot; rises with a timestamp without time zone."""
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * (1440 // minutes) + F.floor((F.hour(ts) * 60 + F.minute(ts)) / minutes)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")
