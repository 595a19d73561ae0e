"""Typed, filtered views over the three sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


#: The shortest and the longest usable trip.
TRIP_MINUTES = (1, 720)


def valid_trip(min_minutes: float, max_minutes: float) -> Column:
    """Whether a clean trip is staged."""
    return (
        F.col("ride_id").isNotNull()
        & F.col("start_station_id").isNotNull()
        & F.col("started_at_ts").isNotNull()
        & F.col("trip_duration_minutes").between(min_minutes, max_minutes)
    )


def valid_snapshot() -> Column:
    """Whether a reading is staged."""
    return (
        F.col("station_id").isNotNull()
        & F.col("snapshot_at").isNotNull()
        & (F.col("is_installed").cast("long") == 1)
    )


def valid_station(empty_as_null: bool = False) -> Column:
    """Whether a station is staged."""
    station_id, name = F.col("station_id"), F.col("name")
    if empty_as_null:
        station_id, name = (F.nullif(F.trim(c), F.lit("")) for c in (station_id, name))
    return station_id.isNotNull() & name.isNotNull() & (F.col("capacity") > 0)


def stage_trips(
    trips: DataFrame, min_minutes: float = TRIP_MINUTES[0], max_minutes: float = TRIP_MINUTES[1]
) -> DataFrame:
    """Usable trips, with ``started_at`` and ``ended_at`` for the parsed times.

    ``year`` and ``month`` are kept when the input has them: as partition
    columns they prune files, which values derived from the timestamp would not.
    """
    started = F.col("started_at_ts")
    kept = trips.filter(valid_trip(min_minutes, max_minutes))
    missing = {
        name: part(started)
        for name, part in (("year", F.year), ("month", F.month))
        if name not in trips.columns
    }
    return kept.withColumns(missing).withColumnsRenamed(
        {"started_at_ts": "started_at", "ended_at_ts": "ended_at"}
    )


def stage_snapshots(snapshots: DataFrame, tz: str | None = None) -> DataFrame:
    """Readings of installed stations, with typed columns, hour and date.

    ``tz`` moves the capture time from UTC to a local wall clock first, which
    is needed to compare snapshot hours with trip hours. Works on streams too.
    """
    taken: Column = F.col("snapshot_at").cast("timestamp")
    if tz:
        taken = F.from_utc_timestamp(taken, tz)
    return (
        snapshots.filter(valid_snapshot())
        .withColumn("snapshot_at", taken)
        .select(
            "snapshot_at",
            F.hour("snapshot_at").alias("snapshot_hour"),
            F.to_date("snapshot_at").alias("snapshot_date"),
            F.col("station_id").cast("string").alias("station_id"),
            *(
                F.col(name).cast("long").alias(name)
                for name in (
                    "num_bikes_available",
                    "num_ebikes_available",
                    "num_docks_available",
                    "num_bikes_disabled",
                    "is_installed",
                    "is_renting",
                    "is_returning",
                )
            ),
        )
    )


def stage_stations(stations: DataFrame, empty_as_null: bool = False) -> DataFrame:
    """Stations with an id, a name and a positive capacity.

    Missing ids and names load as empty text, which passes a not-null test;
    ``empty_as_null`` drops those too.
    """
    loaded = F.col("_ingested_at") if "_ingested_at" in stations.columns else F.lit(None)
    return stations.filter(valid_station(empty_as_null)).select(
        "station_id",
        F.col("name").alias("station_name"),
        F.col("short_name").alias("station_short_name"),
        F.col("lat").cast("double").alias("latitude"),
        F.col("lon").cast("double").alias("longitude"),
        F.col("capacity").cast("long").alias("total_capacity"),
        "region_id",
        loaded.cast("timestamp").alias("info_loaded_at"),
    )
