"""Date parts of ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weekday names in ISO order, 1 = Monday.
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def iso_date(stamp: Column) -> Column:
    return F.substring(stamp, 1, 10)


def iso_month(stamp: Column) -> Column:
    return F.substring(stamp, 1, 7)


def year_of(stamp: Column) -> Column:
    return F.substring(stamp, 1, 4).cast("int")


def month_of(stamp: Column) -> Column:
    return F.substring(stamp, 6, 2).cast("int")


def day_of(stamp: Column) -> Column:
    return F.substring(stamp, 9, 2).cast("int")


def hour_of(stamp: Column) -> Column:
    return F.substring(stamp, 12, 2).cast("int")


def iso_weekday(date_text: Column) -> Column:
    """1 = Monday .. 7 = Sunday; NULL for a date the calendar does not have."""
    return (F.weekday(F.try_to_date(date_text, "yyyy-MM-dd")) + F.lit(1)).cast("int")


def weekday_name(weekday: Column) -> Column:
    # Not element_at: on a literal array it takes a NULL index for the last element.
    return F.get(F.array(*[F.lit(name) for name in WEEKDAY_NAMES]), weekday - 1)


def quarter_of(month: Column) -> Column:
    return F.floor((month + F.lit(2)) / F.lit(3.0)).cast("int")
