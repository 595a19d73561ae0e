"""Bike availability per station and hour, and per station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.functions import availability_ratio, exact_mean, normalise_name, round_half_up

STATION = ("station_id", "station_name", "latitude", "longitude", "total_capacity")

# Below the first share a station counts as near empty, above the second as near full.
NEAR_EMPTY, NEAR_FULL = 0.1, 0.9


def attach_capacity(snapshots: DataFrame, stations: DataFrame) -> DataFrame:
    """Staged snapshots with their station's name, place, capacity and availability ratio.

    Snapshots of unknown stations drop out. No join hint: Spark broadcasts the
    stations while they are under its threshold, and otherwise shuffles with
    its skew handling.
    """
    known = stations.filter(F.col("total_capacity") > 0).select(*STATION)
    return snapshots.join(known, "station_id", "inner").select(
        "station_id",
        "snapshot_at",
        "snapshot_hour",
        "snapshot_date",
        "num_bikes_available",
        "num_ebikes_available",
        "num_docks_available",
        "is_renting",
        "total_capacity",
        "station_name",
        "latitude",
        "longitude",
        availability_ratio(F.col("num_bikes_available"), F.col("total_capacity")).alias(
            "availability_ratio"
        ),
    )


def _tally_columns() -> dict[str, Column]:
    """A reading as a tally of one; a tally of many has the sums of these."""
    tally = {"_readings": F.lit(1).cast("long")}
    for kind in ("ebikes", "docks"):
        value = F.col(f"num_{kind}_available")
        tally[f"_{kind}"] = value
        tally[f"_{kind}_read"] = value.isNotNull().cast("long")
    return tally


def _mean(total: Column, number: Column, digits: int) -> Column:
    return round_half_up(F.try_divide(F.sum(total), F.sum(number)), digits)


def availability_measures(low: float = NEAR_EMPTY, high: float = NEAR_FULL) -> list[Column]:
    """Hourly measures over tallies of readings that share a bike count.

    All sums are integers. The capacity is a grouping key, so the mean ratio is
    the mean number of bikes over the capacity.
    """
    bikes, capacity, readings = (
        F.col(name) for name in ("num_bikes_available", "total_capacity", "_readings")
    )
    read = F.when(bikes.isNotNull(), readings)
    ratio = availability_ratio(bikes, capacity)

    def share(condition: Column) -> Column:
        hits = F.sum(F.when(condition, readings).otherwise(0))
        return round_half_up(F.try_divide(hits, F.sum(readings)), 4)

    return [
        _mean(bikes * readings, read, 2).alias("avg_bikes_available"),
        _mean(F.col("_ebikes"), F.col("_ebikes_read"), 2).alias("avg_ebikes_available"),
        _mean(F.col("_docks"), F.col("_docks_read"), 2).alias("avg_docks_available"),
        _mean(bikes * readings, read * capacity, 4).alias("avg_availability_ratio"),
        share(ratio < low).alias("pct_time_near_empty"),
        share(ratio > high).alias("pct_time_near_full"),
        F.sum(readings).alias("snapshot_count"),
    ]


def hourly_availability(
    readings: DataFrame, low: float = NEAR_EMPTY, high: float = NEAR_FULL
) -> DataFrame:
    """Average availability per station and hour, over all days."""
    return (
        readings.withColumns(_tally_columns())
        .groupBy(*STATION, F.col("snapshot_hour").alias("hour_of_day"))
        .agg(*availability_measures(low, high))
    )


def hourly_availability_from(
    snapshots: DataFrame,
    stations: DataFrame,
    low: float = NEAR_EMPTY,
    high: float = NEAR_FULL,
) -> DataFrame:
    """``hourly_availability(attach_capacity(snapshots, stations))`` from tallies.

    Snapshots are first reduced to one tally per station, hour and bike count,
    so no raw reading is shuffled for the join, whatever its kind, and a station
    with very many readings weighs no more than another.
    """
    tallies = (
        snapshots.withColumns(_tally_columns())
        .groupBy("station_id", "snapshot_hour", "num_bikes_available")
        .agg(
            *(
                F.sum(name).alias(name)
                for name in ("_readings", "_ebikes", "_ebikes_read", "_docks", "_docks_read")
            )
        )
    )
    known = stations.filter(F.col("total_capacity") > 0).select(*STATION)
    return (
        tallies.join(known, "station_id", "inner")
        .groupBy(*STATION, F.col("snapshot_hour").alias("hour_of_day"))
        .agg(*availability_measures(low, high))
    )


def station_availability(
    hourly: DataFrame,
    weighted: bool = False,
    group_on_key: bool = False,
    by_hour: bool = False,
) -> DataFrame:
    """Hourly availability collapsed to one row per station name.

    The averages are plain means of the hourly means; ``weighted`` weighs each
    hour by its readings. ``group_on_key`` merges names that differ in case or
    surrounding white space only. ``by_hour`` keeps the hours apart.
    """

    def mean(name: str, digits: int) -> Column:
        value = F.col(name)
        if not weighted:
            return round_half_up(exact_mean(value, digits), digits).alias(name)
        scaled = F.round(value * F.lit(10**digits)).cast("long")
        weight = F.when(value.isNotNull(), F.col("snapshot_count"))
        average = F.try_divide(F.sum(scaled * weight), F.sum(weight) * F.lit(10**digits))
        return round_half_up(average, digits).alias(name)

    name_key = normalise_name(F.col("station_name")) if group_on_key else F.col("station_name")
    keys = [name_key.alias("_name"), *(["hour_of_day"] if by_hour else [])]
    return (
        hourly.groupBy(*keys)
        .agg(
            F.min("station_name").alias("station_name"),
            F.max("station_id").alias("supply_station_id"),
            F.max("latitude").alias("latitude"),
            F.max("longitude").alias("longitude"),
            F.max("total_capacity").alias("total_capacity"),
            mean("avg_bikes_available", 2),
            mean("avg_ebikes_available", 2),
            mean("avg_availability_ratio", 4),
            mean("pct_time_near_empty", 4),
            F.sum("snapshot_count").alias("snapshot_count"),
        )
        .drop("_name")
    )
