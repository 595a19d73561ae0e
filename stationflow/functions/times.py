"""Timestamp parsing and calendar values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The two layouts trip files use for wall-clock text.
MILLISECONDS = "yyyy-MM-dd HH:mm:ss.SSS"
SECONDS = "yyyy-MM-dd HH:mm:ss"
TRIP_FORMATS = (MILLISECONDS, SECONDS)

_TRIP_SHAPE = r"\A\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{1,3})?\z"

# Index 1 is Sunday, as in Spark's dayofweek.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def parse_time(text: Column, formats: Sequence[str] = TRIP_FORMATS) -> Column:
    """Timestamp from text in the first format that fits, NULL when none does.

    The two default layouts take a faster route: one shape test and Spark's
    native cast, which reads both. Pattern formatters cost about three times
    as much per row.
    """
    if tuple(formats) == TRIP_FORMATS:
        return F.when(text.rlike(_TRIP_SHAPE), text.try_cast("timestamp"))
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(pattern)) for pattern in formats))


def trip_minutes(start: Column, end: Column) -> Column:
    """Minutes between two times, from whole seconds, at two decimals.

    Whole seconds never fall half-way between two hundredths of a minute, so the nearest hundredth is
    found in whole numbers; rounding a double would go through a decimal for each row.
    """
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.floor((seconds * 10 + 3) / F.lit(6.0)) / F.lit(100.0)


def day_name(day_of_week: Column) -> Column:
    """English day name of a day number (1 = Sunday); cheaper than formatting each row."""
    return F.try_element_at(F.array(*(F.lit(name) for name in DAY_NAMES)), day_of_week)
