"""Explicit schemas of every source."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def _struct(text: str) -> T.StructType:
    """A struct from ``name type`` pairs; needs no session, unlike DDL parsing."""
    pairs = (item.split() for item in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _document(station: T.StructType) -> T.StructType:
    """A feed document around an array of ``station``."""
    data = T.StructType([T.StructField("stations", T.ArrayType(station))])
    return T.StructType(
        [
            T.StructField("data", data),
            T.StructField("ttl", T.LongType()),
            T.StructField("last_updated", T.LongType()),
        ]
    )


TRIP_RAW = _struct(
    """ride_id string, rideable_type string, started_at string, ended_at string,
    start_station_name string, start_station_id string,
    end_station_name string, end_station_id string,
    start_lat double, start_lng double, end_lat double, end_lng double,
    member_casual string"""
)

TRIP_CLEAN = _struct(
    """ride_id string, rideable_type string,
    started_at_ts timestamp, ended_at_ts timestamp,
    start_station_id string, start_station_name string,
    end_station_id string, end_station_name string,
    start_lat double, start_lng double, end_lat double, end_lng double,
    member_casual string, trip_duration_minutes double,
    start_hour int, start_day_of_week int, start_day_name string,
    trip_date date, year int, month int"""
)

SNAPSHOT_STATION = _struct(
    """station_id string, num_bikes_available bigint, num_ebikes_available bigint,
    num_docks_available bigint, num_bikes_disabled bigint,
    is_installed int, is_renting int, is_returning int, last_reported bigint"""
)

SNAPSHOT = T.StructType(
    [*SNAPSHOT_STATION.fields, *_struct("snapshot_at string, snapshot_epoch bigint").fields]
)

STATION = _struct(
    """station_id string, name string, short_name string, lat double, lon double,
    capacity bigint, region_id string, _ingested_at timestamp"""
)

SNAPSHOT_DOC = _document(SNAPSHOT_STATION)

# Numbers stay text here and are cast where defaults are filled in.
STATION_DOC = _document(
    _struct(
        """station_id string, name string, short_name string, lat string, lon string,
        capacity string, region_id string"""
    )
)

SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
RIDER_KINDS = ("member", "casual")
