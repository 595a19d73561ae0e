"""The staging layer as views over the tables of the raw layer: the text form of ``operators.staging``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stationflow.operators.staging import TRIP_MINUTES
from stationflow.schemas import TRIP_CLEAN
from stationflow.sources.sinks import publish_view, qualified

_READING_COUNTS = (
    "num_bikes_available",
    "num_ebikes_available",
    "num_docks_available",
    "num_bikes_disabled",
    "is_installed",
    "is_renting",
    "is_returning",
)


def trips_view(source: str, minutes: tuple[float, float] = TRIP_MINUTES) -> str:
    """Usable trips of the clean trips in ``source``."""
    renamed = {"started_at_ts": "started_at", "ended_at_ts": "ended_at"}
    columns = ", ".join(f"{c} AS {renamed.get(c, c)}" for c in TRIP_CLEAN.fieldNames())
    low, high = minutes
    return (
        f"SELECT {columns} FROM {source} WHERE ride_id IS NOT NULL AND start_station_id IS NOT NULL "
        f"AND started_at_ts IS NOT NULL AND trip_duration_minutes BETWEEN {low} AND {high}"
    )


def snapshots_view(source: str, tz: str | None = None) -> str:
    """Readings of installed stations in ``source``, with hour and date in UTC or in ``tz``."""
    taken = "CAST(snapshot_at AS TIMESTAMP)"
    if tz:
        taken = f"from_utc_timestamp({taken}, '{tz}')"
    counts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _READING_COUNTS)
    return (
        f"SELECT {taken} AS snapshot_at, hour({taken}) AS snapshot_hour, to_date({taken}) AS snapshot_date, "
        f"CAST(station_id AS STRING) AS station_id, {counts} FROM {source} "
        "WHERE station_id IS NOT NULL AND snapshot_at IS NOT NULL AND CAST(is_installed AS BIGINT) = 1"
    )


def stations_view(source: str, loaded: str = "CAST(NULL AS TIMESTAMP)") -> str:
    """Stations of ``source`` with an id, a name and a positive capacity."""
    return (
        "SELECT station_id, name AS station_name, short_name AS station_short_name, CAST(lat AS DOUBLE) AS latitude, "
        "CAST(lon AS DOUBLE) AS longitude, CAST(capacity AS BIGINT) AS total_capacity, region_id, "
        f"{loaded} AS info_loaded_at FROM {source} WHERE station_id IS NOT NULL AND name IS NOT NULL AND capacity > 0"
    )


def publish_staging(spark: SparkSession, raw: str = "raw", staging: str = "staging") -> list[str]:
    """Views ``trips``, ``snapshots`` and ``stations`` of the staging layer over the raw layer's tables of those names."""
    texts = {"trips": trips_view, "snapshots": snapshots_view, "stations": stations_view}
    names = {table: qualified(staging, table) for table in texts}
    for table, text in texts.items():
        publish_view(spark, names[table], text(qualified(raw, table)))
    return list(names.values())
