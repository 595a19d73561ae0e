"""Distinct counts over any months from one stored sketch per month: raw trips are not read again.

Sketches are HyperLogLog ones. Their estimates have a relative standard error of about 1.04 / sqrt(2 ** lg_k),
1.6 % with the default; sketches of few values count nearly exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stationflow.operators.demand_states import MONTH, Months, of_months, replace_months

LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """The relative standard error of an estimate."""
    return 1.04 / 2 ** (lg_k / 2)


def month_sketches(
    trips: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), lg_k: int = LG_K
) -> DataFrame:
    """A sketch of each of ``columns`` per month and ``keys``, with the number of ``rows``.

    NULLs are no values. Partial sketches are merged in the shuffle, so a month or key that holds a
    third of all rows costs no more there than another.
    """
    sketches = [F.hll_sketch_agg(F.col(name).cast("string"), lg_k).alias(name) for name in columns]
    return trips.groupBy(*MONTH, *keys).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def refresh_sketches(
    trips: DataFrame,
    path: str,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    months: Months | None = None,
    lg_k: int = LG_K,
) -> None:
    """Write the sketches of ``months`` (all, if None) below ``path``, as ``refresh_states`` does with demand."""
    if months is not None and not months:
        return
    wanted = trips if months is None else of_months(trips, months)
    sketches = month_sketches(wanted, columns, keys, lg_k).hint("rebalance", *MONTH)
    replace_months(sketches, trips, path, months)


def _estimates(columns: Sequence[str]) -> list:
    return [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in columns]


def distinct_counts(sketches: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Distinct values of ``columns`` per ``keys`` over all the months that are given."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), *_estimates(columns))


def rolling_months(df: DataFrame, months: int) -> DataFrame:
    """Each row once for every run of ``months`` months that it counts in, with ``year`` and ``month`` of the run's end.

    ``_own`` tells the rows of the last month itself.
    """
    number = F.col("year") * 12 + F.col("month") - 1
    spread = df.withColumn("_later", F.explode(F.sequence(F.lit(0), F.lit(months - 1))))
    end = number + F.col("_later")
    return spread.withColumns(
        {"year": F.floor(end / 12).cast("int"), "month": (end % 12 + 1).cast("int"), "_own": F.col("_later") == 0}
    ).drop("_later")


def rolling_distinct(
    sketches: DataFrame, columns: Sequence[str], months: int = 3, keys: Sequence[str] = ()
) -> DataFrame:
    """Distinct values over each month and the ``months - 1`` before it, for every month that has a sketch."""
    return (
        rolling_months(sketches, months)
        .groupBy(*MONTH, *keys)
        .agg(F.sum("rows").alias("rows"), *_estimates(columns), F.max("_own").alias("_own"))
        .where("_own")
        .drop("_own")
    )
