"""Rounding, ratios and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, returned as a double.

    Going through a decimal first removes the binary noise that makes engines
    disagree on values such as 1.005.
    """
    return F.round(value.cast("decimal(28,8)"), digits).cast("double")


def _scaled(value: Column, digits: int) -> Column:
    return F.round(value * F.lit(10**digits)).cast("long")


def exact_sum(value: Column, digits: int) -> Column:
    """Sum of values known to carry at most ``digits`` decimals.

    Adds integers, so the result does not depend on the order in which tasks
    finish: a retried task gives the same bits.
    """
    return F.sum(_scaled(value, digits)) / F.lit(float(10**digits))


def exact_parts(value: Column, digits: int) -> tuple[Column, Column]:
    """Integer sum and count, from which ``mean_of_parts`` gives the mean; parts of groups add up."""
    return F.sum(_scaled(value, digits)), F.count(value)


def mean_of_parts(total: Column, count: Column, digits: int) -> Column:
    """The mean that ``exact_parts`` stand for; NULL without values."""
    return F.try_divide(total, count * F.lit(10**digits))


def exact_mean(value: Column, digits: int) -> Column:
    """Mean of values known to carry at most ``digits`` decimals (see ``exact_sum``)."""
    return mean_of_parts(*exact_parts(value, digits), digits)


def availability_ratio(bikes: Column, capacity: Column) -> Column:
    """Share of the docks that hold a bike; NULL for a zero or unknown capacity."""
    return F.try_divide(bikes, capacity)


def demand_ratio(departures: Column, arrivals: Column) -> Column:
    """Departures per arrival; NULL when nothing arrived."""
    return F.try_divide(departures, F.nullif(F.coalesce(arrivals, F.lit(0)), F.lit(0)))


def gap_score(departures: Column, ratio: Column, clamp: bool = False) -> Column:
    """Departures weighted by the missing share of bikes, at two decimals.

    A ratio above 1 gives a negative score unless ``clamp`` is set.
    """
    held = F.coalesce(ratio.cast("decimal(18,8)"), F.lit(0).cast("decimal(18,8)"))
    missing = F.lit(1) - held
    if clamp:
        missing = F.greatest(F.lit(0).cast("decimal(19,8)"), missing)
    return F.round(departures.cast("decimal(18,0)") * missing, 2).cast("double")


def pct(ratio: Column, digits: int = 1) -> Column:
    """A ratio as a percentage."""
    return round_half_up(ratio.cast("decimal(20,10)") * 100, digits)


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` as a percentage of ``whole``; NULL for an empty whole."""
    return pct(F.try_divide(part, F.nullif(whole, F.lit(0))), digits)
