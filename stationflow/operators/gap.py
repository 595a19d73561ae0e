"""Matching demand with supply, scoring and ranking the gap."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.functions import gap_score, gap_severity, normalise_name
from stationflow.functions.labels import SEVERITY_BANDS
from stationflow.operators.ranking import (
    number_rows,
    number_rows_within,
    place_in_order,
)
from stationflow.session import materialise

MART_TIES = (
    "station_id",
    "hour_of_day",
    "start_day_of_week",
    "station_name",
    "supply_station_id",
)

NameKey = Callable[[Column], Column]


def match_by_name(
    demand: DataFrame,
    supply: DataFrame,
    key: NameKey = normalise_name,
    by_hour: bool = False,
) -> DataFrame:
    """Demand rows with the supply of the station of the same normalised name.

    Station ids of the two sources come from different id spaces. The key is
    derived once per side, so the join is a plain equality, and demand without
    supply drops out. ``by_hour`` also matches the hour. Adaptive execution
    broadcasts the supply side when it turns out small and splits hot names
    when it does not.
    """
    named_supply = supply.withColumnRenamed("station_name", "_supply_name").withColumn(
        "_name_key", key(F.col("_supply_name"))
    )
    named_demand = demand.withColumn("_name_key", key(F.col("station_name")))
    on = ["_name_key", *(["hour_of_day"] if by_hour else [])]
    return named_demand.join(named_supply, on, "inner").drop("_name_key", "_supply_name")


def with_gap_score(df: DataFrame, clamp: bool = False) -> DataFrame:
    """Add ``supply_gap_score``."""
    score = gap_score(F.col("total_departures"), F.col("avg_availability_ratio"), clamp)
    return df.withColumn("supply_gap_score", score)


def select_mart_columns(df: DataFrame) -> DataFrame:
    """The mart's columns before ranking, in order."""
    return df.select(
        "station_id",
        "station_name",
        "supply_station_id",
        "hour_of_day",
        "start_day_of_week",
        "start_day_name",
        "latitude",
        "longitude",
        "total_capacity",
        "total_departures",
        "total_arrivals",
        "net_demand",
        "demand_to_arrival_ratio",
        "avg_trip_duration_minutes",
        "member_departures",
        "casual_departures",
        "ebike_departures",
        "avg_bikes_available",
        "avg_ebikes_available",
        "avg_availability_ratio",
        "pct_time_near_empty",
        "snapshot_count",
        "supply_gap_score",
    )


def score_gaps(
    demand: DataFrame, supply: DataFrame, clamp: bool = False, by_hour: bool = False
) -> DataFrame:
    """Matched and scored mart rows, not ranked yet."""
    return (
        match_by_name(demand, supply, by_hour=by_hour)
        .transform(with_gap_score, clamp)
        .transform(select_mart_columns)
    )


def gap_order() -> list[Column | str]:
    """Worst gap first, ties by the mart's key."""
    return [F.col("supply_gap_score").desc(), *MART_TIES]


def with_peak_flag(df: DataFrame) -> DataFrame:
    """Add ``is_peak_gap_hour`` from the rank within the station."""
    return df.withColumn("is_peak_gap_hour", F.col("worst_hour_rank_for_station") == 1)


def rank_gaps(scored: DataFrame, bands: Sequence[float] = SEVERITY_BANDS) -> DataFrame:
    """Add the three ranks, the peak flag and the severity.

    A station has a few hundred rows at most (its names times the hours of a
    week), so its rank is a plain window, which needs no shuffle when the rows come by
    station. These rows are stored, as placing them reads them twice; both other ranks follow
    from the places and small tables of counts, without moving the rows again.
    """
    by_station = Window.partitionBy("station_id").orderBy(*gap_order())
    in_station = F.row_number().over(by_station).cast("long")
    ranked = scored.withColumn("worst_hour_rank_for_station", in_station)
    placed = place_in_order(materialise(ranked, "scored"), gap_order(), "hour_of_day")
    return (
        number_rows(placed, "overall_gap_rank")
        .transform(number_rows_within, placed, "hour_of_day", "gap_rank_within_hour")
        .transform(with_peak_flag)
        .withColumn("gap_severity", gap_severity(F.col("supply_gap_score"), bands))
        .select(
            *scored.columns,
            "overall_gap_rank",
            "gap_rank_within_hour",
            "worst_hour_rank_for_station",
            "is_peak_gap_hour",
            "gap_severity",
        )
    )


def worst_gaps(scored: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` worst rows: a top-k over the scored rows that ranks nothing else."""
    return scored.orderBy(*gap_order()).limit(n)


def unmatched_stations(
    demand: DataFrame, supply: DataFrame, key: NameKey = normalise_name
) -> DataFrame:
    """Stations of either side whose name has no counterpart on the other.

    Each side is reduced to one row per station and stored, as both joins read
    it and would otherwise compute the demand twice.
    """

    def stations(df: DataFrame, side: str, station_id: str) -> DataFrame:
        listed = df.select(
            F.lit(side).alias("side"),
            F.col(station_id).alias("station_id"),
            "station_name",
            key(F.col("station_name")).alias("_name_key"),
        ).distinct()
        return materialise(listed, side)

    asking = stations(demand, "demand_only", "station_id")
    giving = stations(supply, "supply_only", "supply_station_id")
    return (
        asking.join(giving.select("_name_key"), "_name_key", "left_anti")
        .unionByName(giving.join(asking.select("_name_key"), "_name_key", "left_anti"))
        .select("side", "station_id", "station_name")
    )
