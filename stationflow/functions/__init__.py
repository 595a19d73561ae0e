"""Column expressions shared by the operators; all stay inside Spark's codegen."""

from stationflow.functions.labels import gap_severity, severity_level, time_period
from stationflow.functions.names import normalise_name
from stationflow.functions.numbers import (
    availability_ratio,
    demand_ratio,
    exact_mean,
    exact_parts,
    exact_sum,
    gap_score,
    mean_of_parts,
    pct,
    round_half_up,
    share_pct,
)
from stationflow.functions.times import day_name, parse_time, trip_minutes

__all__ = [
    "availability_ratio", "day_name", "demand_ratio", "exact_mean", "exact_parts", "exact_sum",
    "gap_score", "gap_severity", "mean_of_parts", "normalise_name", "parse_time", "pct",
    "round_half_up", "severity_level", "share_pct", "time_period", "trip_minutes",
]
