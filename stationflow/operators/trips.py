"""Raw trips to clean trips: parsing, validity and calendar columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stationflow.functions import day_name, parse_time, trip_minutes
from stationflow.functions.times import TRIP_FORMATS
from stationflow.schemas import TRIP_CLEAN


def parse_trip_times(
    df: DataFrame,
    formats: Sequence[str] = TRIP_FORMATS,
    start: str = "started_at",
    end: str = "ended_at",
) -> DataFrame:
    """Add ``started_at_ts`` and ``ended_at_ts``; text that does not parse gives NULL.

    Both values are produced by a one-row ``inline`` so that later filters stay
    above it. As plain columns the optimizer would copy the parsing into every
    predicate that mentions them, four times per row for ``clean_trips``.
    """
    parsed = F.struct(
        parse_time(F.col(start), formats).alias("started_at_ts"),
        parse_time(F.col(end), formats).alias("ended_at_ts"),
    )
    return df.select("*", F.inline(F.array(parsed)))


def clean_trips(df: DataFrame, max_seconds: int = 86400) -> DataFrame:
    """Keep trips with both times and stations that end after they start, in under ``max_seconds``."""
    start, end = F.col("started_at_ts"), F.col("ended_at_ts")
    return df.filter(
        start.isNotNull()
        & end.isNotNull()
        & F.col("start_station_id").isNotNull()
        & F.col("end_station_id").isNotNull()
        & (end > start)
        & (F.unix_timestamp(end) - F.unix_timestamp(start) < max_seconds)
    )


def with_duration(df: DataFrame) -> DataFrame:
    """Add ``trip_duration_minutes``."""
    return df.withColumn(
        "trip_duration_minutes", trip_minutes(F.col("started_at_ts"), F.col("ended_at_ts"))
    )


def with_calendar(df: DataFrame, ts: str = "started_at_ts") -> DataFrame:
    """Add hour, weekday (1 = Sunday), day name, date, year and month of ``ts``."""
    when = F.col(ts)
    return df.withColumns(
        {
            "start_hour": F.hour(when),
            "start_day_of_week": F.dayofweek(when),
            "start_day_name": day_name(F.dayofweek(when)),
            "trip_date": F.to_date(when),
            "year": F.year(when),
            "month": F.month(when),
        }
    )


def select_trip_columns(df: DataFrame) -> DataFrame:
    """The 20 columns of a clean trip, in order."""
    return df.select(*TRIP_CLEAN.fieldNames())


def enrich_trips(
    raw: DataFrame, formats: Sequence[str] = TRIP_FORMATS, max_seconds: int = 86400
) -> DataFrame:
    """Raw trips to clean trips; no shuffle and one pass over the input."""
    return (
        raw.transform(parse_trip_times, formats)
        .transform(clean_trips, max_seconds)
        .transform(with_duration)
        .transform(with_calendar)
        .transform(select_trip_columns)
    )
