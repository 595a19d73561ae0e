"""Hourly demand kept as partial states per month, so that a load recomputes only the months it touches.

A state holds what adds up: counts, and the integer sum and count of the durations. States of all months merge to
the same hourly demand as all trips give, for a cell is the sum of its months.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.functions import exact_parts, mean_of_parts
from stationflow.operators import demand

MONTH = ("year", "month")
_DIGITS = 6
_COUNTS = ("total_departures", "member_departures", "casual_departures", "ebike_departures")
_DEPARTURE_CELL = ("station_id", "station_name", "hour_of_day", "start_day_of_week", "start_day_name")

Months = Sequence[tuple[int, int]]


def touched_months(trips: DataFrame) -> list[tuple[int, int]]:
    """The months that trips of a load start in, in order; as many as the calendar has."""
    return sorted((r["year"], r["month"]) for r in trips.select(*MONTH).distinct().collect())


def of_months(df: DataFrame, months: Months) -> DataFrame:
    """Rows of the given months; over files partitioned by month, the others are not read."""
    wanted = [(F.col("year") == y) & (F.col("month") == m) for y, m in months]
    return df.where(reduce(or_, wanted, F.lit(False)))


def trip_columns(bucket: str = "start") -> list[str]:
    """The columns of staged trips that states are made from, months last."""
    return [
        "start_station_id",
        "start_station_name",
        "start_hour",
        "start_day_of_week",
        "start_day_name",
        "end_station_id",
        *(["ended_at"] if bucket == "end" else []),
        "trip_duration_minutes",
        "member_casual",
        "rideable_type",
        *MONTH,
    ]


def month_states(trips: DataFrame, bucket: str = "start") -> DataFrame:
    """States of staged trips per month: one row per departure cell, and one per arrival cell.

    A month has up to as many departure cells as trips, and files hold more trips than a task has room for cells.
    So trips are moved before they are counted, in ranges of about equal size that lie by month as the states are written.
    Arrival cells have no names and are counted first.
    """
    placed = trips.repartitionByRange(*MONTH, "start_station_id", "start_hour", "start_day_of_week")
    total, count = exact_parts(F.col("trip_duration_minutes"), _DIGITS)
    measures = demand._departure_measures()
    departed = placed.groupBy(*MONTH, *demand._departure_keys()).agg(
        *(measures[name].alias(name) for name in _COUNTS),
        total.alias("duration_sum"),
        count.alias("duration_count"),
    )
    hour, day = demand._arrival_cell(bucket)
    arrived = trips.groupBy(
        *MONTH,
        F.col("end_station_id").alias("station_id"),
        hour.alias("hour_of_day"),
        day.alias("start_day_of_week"),
    ).agg(F.count(F.lit(1)).alias("total_arrivals"))
    return departed.unionByName(arrived.hint("rebalance", *MONTH), allowMissingColumns=True)


def merge_states(states: DataFrame) -> DataFrame:
    """Hourly net demand of all the months whose states are given.

    A cell has at most one state per month and name, so they are moved before they are added up.
    """
    placed = states.repartition(*demand.CELL)
    departed = (
        placed.where("total_departures is not null")
        .groupBy(*_DEPARTURE_CELL)
        .agg(*(F.sum(name).alias(name) for name in (*_COUNTS, "duration_sum", "duration_count")))
        .withColumn("avg_trip_duration_minutes", mean_of_parts(F.col("duration_sum"), F.col("duration_count"), _DIGITS))
    )
    arrived = (
        placed.where("total_arrivals is not null")
        .groupBy(*demand.CELL)
        .agg(F.sum("total_arrivals").alias("total_arrivals"))
    )
    return demand.net_demand(departed, arrived)


def refresh_states(trips: DataFrame, path: str, months: Months | None = None, bucket: str = "start") -> None:
    """Write the states of ``months`` (all, if None) of staged ``trips`` below ``path``, replacing theirs only.

    The states of a month appear together, in place of its earlier ones; a month without trips loses its
    states. Running it again, whole or after a failure, changes nothing more.
    """
    if months is not None and not months:
        return
    replace_months(month_states(trips if months is None else of_months(trips, months), bucket), trips, path, months)


def replace_months(states: DataFrame, trips: DataFrame, path: str, months: Months | None) -> None:
    """Write ``states`` of ``months`` of ``trips`` in place of those months' earlier ones (of all, if None).

    Each task writes a file for every month it holds, so ``states`` should lie by month.
    """
    mode = "static" if months is None else "dynamic"
    writer = states.write.partitionBy(*MONTH).mode("overwrite")
    writer.option("partitionOverwriteMode", mode).parquet(path)
    spark = trips.sparkSession
    if months is not None:
        left = set(touched_months(of_months(trips, months)))
        for year, month in set(months) - left:
            _delete(spark, f"{path}/year={year}/month={month}")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """States as ``refresh_states`` writes them."""
    return spark.read.parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
