"""From clean trips, snapshots and stations to the ranked supply-gap mart."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from stationflow.functions.labels import SEVERITY_BANDS
from stationflow.operators.availability import hourly_availability_from, station_availability
from stationflow.operators.demand import hourly_demand_one_pass
from stationflow.operators.gap import rank_gaps, score_gaps, worst_gaps
from stationflow.operators.staging import stage_snapshots, stage_stations, stage_trips
from stationflow.operators.trips import enrich_trips
from stationflow.session import materialise
from stationflow.sources.audit import with_row_audit
from stationflow.sources.sinks import write_trips
from stationflow.sources.trips import read_trips, read_trips_csv


@dataclass(frozen=True)
class MartOptions:
    """Choices that differ from the plain mart."""

    bands: Sequence[float] = SEVERITY_BANDS
    min_minutes: float = 1
    max_minutes: float = 720
    bucket: str = "start"
    tz: str | None = None
    empty_as_null: bool = False
    weighted: bool = False
    group_on_key: bool = False
    by_hour: bool = False
    clamp: bool = False

    def __post_init__(self) -> None:
        if self.by_hour and not self.tz:
            raise ValueError("by_hour matches trips' local hours: name the stations' time zone as tz")


def demand(trips: DataFrame, options: MartOptions = MartOptions()) -> DataFrame:
    """Hourly demand of clean trips."""
    staged = stage_trips(trips, options.min_minutes, options.max_minutes)
    return hourly_demand_one_pass(staged, options.bucket)


def supply(
    snapshots: DataFrame, stations: DataFrame, options: MartOptions = MartOptions()
) -> DataFrame:
    """Availability per station name."""
    hourly = hourly_availability_from(
        stage_snapshots(snapshots, options.tz), stage_stations(stations, options.empty_as_null)
    )
    return station_availability(
        hourly, options.weighted, options.group_on_key, options.by_hour
    )


def scored_gaps(
    trips: DataFrame,
    snapshots: DataFrame,
    stations: DataFrame,
    options: MartOptions = MartOptions(),
) -> DataFrame:
    """The mart's rows before ranking.

    The supply, a row per station name, is stored first: Spark then knows its size before the join is
    planned and does not shuffle the demand for a small one.
    """
    return score_gaps(
        demand(trips, options),
        materialise(supply(snapshots, stations, options), "supply"),
        options.clamp,
        options.by_hour,
    )


def build_mart(
    trips: DataFrame,
    snapshots: DataFrame,
    stations: DataFrame,
    options: MartOptions = MartOptions(),
) -> DataFrame:
    """The mart: scored, ranked, flagged and labelled station-hours.

    One pass over the trips and one over the snapshots. Sort on read.
    """
    return rank_gaps(scored_gaps(trips, snapshots, stations, options), options.bands)


def worst_station_hours(
    trips: DataFrame,
    snapshots: DataFrame,
    stations: DataFrame,
    n: int = 10,
    options: MartOptions = MartOptions(),
) -> DataFrame:
    """The ``n`` worst station-hours, without ranking the rest."""
    return worst_gaps(scored_gaps(trips, snapshots, stations, options), n)


def load_trips(spark: SparkSession, source: str, target: str, **csv_options) -> tuple[
    DataFrame, dict[str, Observation]
]:
    """CSV trips to partitioned Parquet in one pass, counting rows on the way."""
    raw, read = with_row_audit(read_trips_csv(spark, source, **csv_options), "raw_trips")
    clean, kept = with_row_audit(enrich_trips(raw), "clean_trips")
    write_trips(clean, target)
    return read_trips(spark, target), {"raw": read, "clean": kept}
