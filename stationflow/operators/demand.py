"""Departures, arrivals and net demand per station, hour and weekday."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.functions import demand_ratio, exact_mean
from stationflow.operators.ranking import rank_in

CELL = ("station_id", "hour_of_day", "start_day_of_week")

# Rider and bike kinds counted apart.
MEMBER, CASUAL, ELECTRIC = "member", "casual", "electric_bike"

RANK_TIES = (*CELL, "station_name")


def _departure_measures() -> dict[str, Column]:
    return {
        "total_departures": F.count(F.lit(1)),
        # Sums of millionths are exact and don't depend on the order of the rows.
        "avg_trip_duration_minutes": exact_mean(F.col("trip_duration_minutes"), 6),
        "member_departures": F.count_if(F.col("member_casual") == MEMBER),
        "casual_departures": F.count_if(F.col("member_casual") == CASUAL),
        "ebike_departures": F.count_if(F.col("rideable_type") == ELECTRIC),
    }


def _aliased(measures: dict[str, Column]) -> list[Column]:
    return [measure.alias(name) for name, measure in measures.items()]


def _arrival_cell(bucket: str) -> tuple[Column, Column]:
    """Hour and weekday an arrival counts under: those of the trip's start or of its end."""
    if bucket == "start":
        return F.col("start_hour"), F.col("start_day_of_week")
    if bucket == "end":
        return F.hour("ended_at"), F.dayofweek("ended_at")
    raise ValueError(f"bucket must be 'start' or 'end', not {bucket!r}")


def _departure_keys() -> list[Column]:
    return [
        F.col("start_station_id").alias("station_id"),
        F.col("start_station_name").alias("station_name"),
        F.col("start_hour").alias("hour_of_day"),
        F.col("start_day_of_week"),
        F.col("start_day_name"),
    ]


def departures(trips: DataFrame) -> DataFrame:
    """Departures of staged trips per station, name, hour and weekday."""
    return trips.groupBy(*_departure_keys()).agg(*_aliased(_departure_measures()))


def departure_cells(trips: DataFrame) -> DataFrame:
    """The cells that have departures, without their measures."""
    return trips.select(*_departure_keys()).distinct()


def arrivals(trips: DataFrame, bucket: str = "start") -> DataFrame:
    """Arrivals of staged trips per end station, hour and weekday."""
    hour, day = _arrival_cell(bucket)
    return trips.groupBy(
        F.col("end_station_id").alias("station_id"),
        hour.alias("hour_of_day"),
        day.alias("start_day_of_week"),
    ).agg(F.count(F.lit(1)).alias("total_arrivals"))


def with_net_demand(df: DataFrame) -> DataFrame:
    """Default missing arrivals to 0; add net demand and the departure-to-arrival ratio."""
    arrived = F.coalesce(F.col("total_arrivals"), F.lit(0).cast("long"))
    return df.withColumn("total_arrivals", arrived).withColumns(
        {
            "net_demand": F.col("total_departures") - F.col("total_arrivals"),
            "demand_to_arrival_ratio": demand_ratio(
                F.col("total_departures"), F.col("total_arrivals")
            ),
        }
    )


def select_demand_columns(df: DataFrame) -> DataFrame:
    """The columns of hourly demand, in order."""
    return df.select(
        "station_id",
        "station_name",
        "hour_of_day",
        "start_day_of_week",
        "start_day_name",
        "total_departures",
        "total_arrivals",
        "net_demand",
        "demand_to_arrival_ratio",
        "avg_trip_duration_minutes",
        "member_departures",
        "casual_departures",
        "ebike_departures",
    )


def net_demand(departed: DataFrame, arrived: DataFrame) -> DataFrame:
    """Departures with the arrivals of the same station, hour and weekday.

    Cells with arrivals only are left out.
    """
    return (
        departed.join(arrived, list(CELL), "left")
        .transform(with_net_demand)
        .transform(select_demand_columns)
    )


def hourly_demand(trips: DataFrame, bucket: str = "start") -> DataFrame:
    """Hourly net demand of staged trips.

    Two scans of a few columns each. Counting both ends of every trip in one
    scan (``hourly_demand_one_pass``) doubles the rows before the first
    aggregation, which costs more from columnar files.
    """
    return net_demand(departures(trips), arrivals(trips, bucket))


def hourly_demand_one_pass(trips: DataFrame, bucket: str = "start") -> DataFrame:
    """``hourly_demand`` from one pass, for trips that are dear to read, such as raw CSV.

    Each trip yields a departure and an arrival; both are counted by the same
    partial aggregation before anything is shuffled, so a busy station costs a
    few rows per task. The two kinds then meet within their cell. Rows come out by
    station, of which each has a few hundred, so ranks within a station need no other shuffle.
    """
    hour, day = _arrival_cell(bucket)
    departure = {
        "is_departure": F.lit(True),
        "station_id": F.col("start_station_id"),
        "hour_of_day": F.col("start_hour"),
        "start_day_of_week": F.col("start_day_of_week"),
        "station_name": F.col("start_station_name"),
        "start_day_name": F.col("start_day_name"),
        "trip_duration_minutes": F.col("trip_duration_minutes"),
        "member_casual": F.col("member_casual"),
        "rideable_type": F.col("rideable_type"),
    }
    types = {field.name: field.dataType for field in trips.select(*_aliased(departure)).schema}
    arrival = {name: F.lit(None).cast(kind) for name, kind in types.items()} | {
        "is_departure": F.lit(False),
        "station_id": F.col("end_station_id").cast(types["station_id"]),
        "hour_of_day": hour,
        "start_day_of_week": day,
    }
    ends = trips.select(
        F.inline(F.array(F.struct(*_aliased(departure)), F.struct(*_aliased(arrival))))
    )
    # An arrival without a full cell can match no departure.
    known = F.col("is_departure")
    matchable = F.lit(True)
    for name in CELL:
        matchable = matchable & F.col(name).isNotNull()
    counted = (
        ends.filter(known | matchable)
        .groupBy(*CELL, "station_name", "start_day_name", "is_departure")
        .agg(*_aliased(_departure_measures()))
        .repartition("station_id")
    )
    arrived = F.sum(F.when(~known, F.col("total_departures"))).over(Window.partitionBy(*CELL))
    return (
        counted.withColumn("total_arrivals", arrived)
        .filter(known)
        .transform(with_net_demand)
        .transform(select_demand_columns)
    )


def rank_by_departures(demand: DataFrame) -> DataFrame:
    """Add ``rank_by_departures_in_hour``, 1 for the busiest cell of the hour."""
    return rank_in(
        demand,
        "hour_of_day",
        [F.col("total_departures").desc(), *RANK_TIES],
        "rank_by_departures_in_hour",
    )
