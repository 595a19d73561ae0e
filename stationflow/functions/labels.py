"""Bands and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from stationflow.schemas import SEVERITIES

# Lowest score of every band but the last.
SEVERITY_BANDS = (500, 200, 50)

# First hour, last hour, label; other hours are off-peak.
TIME_PERIODS = ((6, 9, "Morning Commute"), (10, 15, "Midday"), (16, 20, "Evening Commute"))
OFF_PEAK = "Off-Peak"


def gap_severity(
    score: Column,
    bands: Sequence[float] = SEVERITY_BANDS,
    labels: Sequence[str] = SEVERITIES,
) -> Column:
    """Label of the first band whose lower limit the score reaches."""
    if len(labels) != len(bands) + 1:
        raise ValueError("one label per band and one for the rest")
    label = F.lit(labels[-1])
    for limit, name in reversed(list(zip(bands, labels))):
        label = F.when(score >= limit, F.lit(name)).otherwise(label)
    return label


def severity_level(label: Column, labels: Sequence[str] = SEVERITIES) -> Column:
    """Position of a label, 1 for the worst."""
    return F.array_position(F.array(*(F.lit(name) for name in labels)), label)


def time_period(hour: Column) -> Column:
    """Part of the day an hour belongs to."""
    label = F.lit(OFF_PEAK)
    for first, last, name in reversed(TIME_PERIODS):
        label = F.when(hour.between(first, last), F.lit(name)).otherwise(label)
    return label
