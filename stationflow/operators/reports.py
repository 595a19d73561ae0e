"""Reports over the stored mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.functions import (
    exact_mean,
    exact_sum,
    pct,
    round_half_up,
    severity_level,
    share_pct,
    time_period,
)
from stationflow.operators.gap import gap_order


def trips_sample(trips: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` trips by ride id."""
    columns = (
        "ride_id",
        "started_at_ts",
        "start_station_name",
        "end_station_name",
        "member_casual",
        "trip_duration_minutes",
    )
    return trips.select(*columns).orderBy("ride_id", *columns[1:]).limit(n)


def _distinct(column: str, approx: bool) -> Column:
    return F.approx_count_distinct(column) if approx else F.count_distinct(column)


def worst_stations(mart: DataFrame, n: int = 10) -> DataFrame:
    """The stations with the highest total score.

    ``max_severity_label`` is the label that sorts last as text, so MEDIUM hides
    CRITICAL; ``worst_severity`` is the most severe one.
    """
    return (
        mart.groupBy("station_name", "station_id")
        .agg(
            round_half_up(exact_sum(F.col("supply_gap_score"), 2), 0).alias("total_gap_score"),
            F.sum("total_departures").alias("total_historical_trips"),
            round_half_up(exact_mean(F.col("avg_availability_ratio"), 4), 3).alias(
                "avg_availability_all_hours"
            ),
            round_half_up(exact_mean(F.col("pct_time_near_empty"), 4), 3).alias(
                "avg_pct_time_near_empty"
            ),
            F.max("gap_severity").alias("max_severity_label"),
            F.min_by("gap_severity", severity_level(F.col("gap_severity"))).alias(
                "worst_severity"
            ),
        )
        .orderBy(F.col("total_gap_score").desc(), "station_id", "station_name")
        .limit(n)
    )


def by_hour(mart: DataFrame, approx: bool = False) -> DataFrame:
    """When the gap peaks: averages and totals of each hour, worst first."""
    return (
        mart.groupBy("hour_of_day")
        .agg(
            round_half_up(exact_mean(F.col("supply_gap_score"), 2), 2).alias("avg_supply_gap"),
            F.sum("total_departures").alias("total_departures_system_wide"),
            round_half_up(exact_mean(F.col("avg_availability_ratio"), 4), 3).alias(
                "avg_availability"
            ),
            _distinct("station_id", approx).alias("stations_observed"),
        )
        .select(
            "hour_of_day",
            time_period(F.col("hour_of_day")).alias("time_period"),
            "avg_supply_gap",
            "total_departures_system_wide",
            "avg_availability",
            "stations_observed",
        )
        .orderBy(F.col("avg_supply_gap").desc(), "hour_of_day")
    )


def filter_severity(mart: DataFrame, labels: Sequence[str] = ("CRITICAL", "HIGH")) -> DataFrame:
    """Rows of the given severities."""
    return mart.filter(F.col("gap_severity").isin(*labels))


def crisis_moments(mart: DataFrame, n: int = 25) -> DataFrame:
    """The worst station-hours among the severe ones."""
    return (
        filter_severity(mart)
        .orderBy(*gap_order())
        .limit(n)
        .select(
            F.col("overall_gap_rank").alias("rank"),
            "station_name",
            "hour_of_day",
            F.col("start_day_name").alias("day_of_week"),
            "total_departures",
            round_half_up(F.col("avg_bikes_available"), 1).alias("avg_bikes_available"),
            "total_capacity",
            pct(F.col("avg_availability_ratio")).alias("availability_pct"),
            pct(F.col("pct_time_near_empty")).alias("pct_time_near_empty"),
            round_half_up(F.col("supply_gap_score"), 0).alias("supply_gap_score"),
            "gap_severity",
        )
    )


def top_ranked(mart: DataFrame, k: int = 20) -> DataFrame:
    """Rows up to overall rank ``k``."""
    return mart.filter(F.col("overall_gap_rank") <= k)


def rider_split(mart: DataFrame, k: int = 20) -> DataFrame:
    """Member and casual shares of the ``k`` worst rows."""
    return (
        top_ranked(mart, k)
        .orderBy(*gap_order())
        .select(
            "station_name",
            "hour_of_day",
            "total_departures",
            "member_departures",
            "casual_departures",
            share_pct(F.col("member_departures"), F.col("total_departures")).alias("member_pct"),
            share_pct(F.col("casual_departures"), F.col("total_departures")).alias("casual_pct"),
            "supply_gap_score",
        )
    )


def quality(mart: DataFrame, approx: bool = False) -> DataFrame:
    """Coverage and extremes of the mart, as one row."""
    return mart.agg(
        _distinct("station_id", approx).alias("total_stations"),
        _distinct("hour_of_day", approx).alias("hours_covered"),
        F.sum("total_departures").alias("total_trips_analyzed"),
        F.sum("snapshot_count").alias("total_availability_snapshots"),
        F.min("avg_availability_ratio").alias("min_avg_availability"),
        F.max("avg_availability_ratio").alias("max_avg_availability"),
        F.count_if(F.col("gap_severity") == "CRITICAL").alias("critical_station_hours"),
        F.count_if(F.col("gap_severity") == "HIGH").alias("high_station_hours"),
    )


def hour_coverage(mart: DataFrame) -> DataFrame:
    """Rows per hour."""
    return (
        mart.groupBy("hour_of_day").agg(F.count(F.lit(1)).alias("row_count")).orderBy("hour_of_day")
    )


def peak_rows(mart: DataFrame, n: int = 10) -> DataFrame:
    """The worst row of every station, the ``n`` worst of them."""
    return (
        mart.filter("is_peak_gap_hour")
        .orderBy(*gap_order())
        .limit(n)
        .select(
            "station_name",
            "hour_of_day",
            "total_departures",
            pct(F.col("avg_availability_ratio")).alias("pct_bikes_available"),
            "supply_gap_score",
            "gap_severity",
        )
    )


def top_rows(mart: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` worst rows."""
    return (
        mart.orderBy(*gap_order())
        .limit(n)
        .select(
            "station_name",
            "hour_of_day",
            "total_departures",
            round_half_up(F.col("avg_bikes_available"), 1).alias("avg_bikes"),
            round_half_up(F.col("avg_availability_ratio"), 3).alias("avail_ratio"),
            "supply_gap_score",
            "gap_severity",
        )
    )


def severity_counts(mart: DataFrame) -> DataFrame:
    """Rows per severity, most frequent first."""
    return (
        mart.groupBy("gap_severity")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.col("row_count").desc(), "gap_severity")
    )


def coverage(mart: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, station names, hours, and rows with a known availability, as one row.

    The last is a sum, so it is NULL rather than 0 when no row qualifies.
    """
    known = F.when(F.col("avg_bikes_available").isNotNull(), F.lit(1))
    return mart.agg(
        F.count(F.lit(1)).alias("total_rows"),
        _distinct("station_name", approx).alias("unique_stations"),
        _distinct("hour_of_day", approx).alias("hours_covered"),
        F.sum(known).alias("rows_with_availability"),
    )


def severity_pivot(mart: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, stations, hours and the rows of each severity, as one row."""
    return mart.agg(
        F.count(F.lit(1)).alias("total_rows"),
        _distinct("station_name", approx).alias("stations"),
        _distinct("hour_of_day", approx).alias("hours"),
        *(
            F.count_if(F.col("gap_severity") == label).alias(label.lower())
            for label in ("CRITICAL", "HIGH", "MEDIUM", "LOW")
        ),
    )
