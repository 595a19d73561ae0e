import re

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stationflow.operators import availability, demand, gap, staging

TRIP = """start_station_id string, start_station_name string, end_station_id string, start_hour int,
start_day_of_week int, start_day_name string, ended_at timestamp, trip_duration_minutes double,
member_casual string, rideable_type string"""


def trips(spark, *data):
    from datetime import datetime

    end = datetime(2024, 1, 1, 9, 5)
    return spark.createDataFrame(
        [(s, n, e, h, 2, "Monday", end, 12.34, "member", "classic_bike") for s, n, e, h in data], TRIP
    )


@pytest.fixture(scope="module")
def some_trips(spark):
    return trips(
        spark,
        ("1", "A", "2", 8), ("1", "A", "2", 8), ("1", " a ", None, 8), ("2", "B", "1", 8),
        ("3", "C", "9", 8), ("2", None, "2", 9), ("4", "D", "4", None),
    )


def test_net_demand_edges(some_trips):
    found = {
        (r.station_id, r.station_name, r.hour_of_day): (
            r.total_departures, r.total_arrivals, r.net_demand, r.demand_to_arrival_ratio,
        )
        for r in demand.hourly_demand(some_trips).collect()
    }
    assert found == {
        ("1", "A", 8): (2, 1, 1, 2.0),
        ("1", " a ", 8): (1, 1, 0, 1.0),
        ("2", "B", 8): (1, 2, -1, 0.5),
        ("3", "C", 8): (1, 0, 1, None),
        ("2", None, 9): (1, 1, 0, 1.0),
        ("4", "D", None): (1, 0, 1, None),
    }


@pytest.mark.parametrize("bucket", ["start", "end"])
def test_one_pass_equals_the_join(some_trips, bucket):
    joined = demand.net_demand(demand.departures(some_trips), demand.arrivals(some_trips, bucket))
    one_pass = demand.hourly_demand_one_pass(some_trips, bucket)
    assert rows(joined) == rows(one_pass) == rows(demand.hourly_demand(some_trips, bucket))
    assert joined.schema.simpleString() == one_pass.schema.simpleString()


def test_unknown_bucket(some_trips):
    with pytest.raises(ValueError):
        demand.arrivals(some_trips, "middle")


def test_departures_add_up(spark, sf):
    from catalogue import queries as q

    staged = q.staged_trips(spark, sf)
    assert demand.hourly_demand(staged).agg(F.sum("total_departures")).first()[0] == staged.count()


def test_trips_are_scanned_once(spark, tmp_path, some_trips):
    some_trips.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    physical = plan_of(demand.hourly_demand_one_pass(stored)).split("== Physical Plan ==")[1]
    assert physical.count("FileScan parquet") == 1
    assert demand.departure_cells(some_trips).count() == demand.departures(some_trips).count()


def test_means_are_not_rounded_before(spark, some_trips):
    third = some_trips.limit(1).withColumn("trip_duration_minutes", F.lit(1.004))
    mean = demand.departures(third.unionByName(third)).first()["avg_trip_duration_minutes"]
    assert mean == pytest.approx(1.004, abs=1e-9)


SNAPSHOT = """station_id string, snapshot_at timestamp, snapshot_hour int, snapshot_date date,
num_bikes_available long, num_ebikes_available long, num_docks_available long, is_renting long"""


@pytest.fixture(scope="module")
def readings(spark):
    def reading(station, hour, bikes, ebikes=1):
        return (station, None, hour, None, bikes, ebikes, 3, 1)

    data = [
        reading("a", 8, 1), reading("a", 8, 9), reading("a", 8, 10), reading("a", 8, None),
        reading("a", 9, 0, None), reading("b", 8, 30), reading("gone", 8, 5), reading("zero", 8, 5),
    ]
    return spark.createDataFrame(data, SNAPSHOT)


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame(
        [("a", "Main St", 1.0, 2.0, 10), ("b", " MAIN st", 3.0, 4.0, 20), ("zero", "Z", 0.0, 0.0, 0),
         ("b", " MAIN st", 3.0, 4.0, 20)],
        "station_id string, station_name string, latitude double, longitude double, total_capacity long",
    )


def test_hourly_availability_edges(readings, stations):
    hourly = availability.hourly_availability(availability.attach_capacity(readings, stations))
    found = {(r.station_id, r.hour_of_day): r for r in hourly.collect()}
    assert set(found) == {("a", 8), ("a", 9), ("b", 8)}
    a8, a9, b8 = found["a", 8], found["a", 9], found["b", 8]
    assert (a8.avg_bikes_available, a8.avg_availability_ratio, a8.snapshot_count) == (6.67, 0.6667, 4)
    # Ratios of exactly 0.1 and 0.9 are neither near empty nor near full; 1.0 is near full.
    assert (a8.pct_time_near_empty, a8.pct_time_near_full) == (0.0, 0.25)
    assert (a9.avg_ebikes_available, a9.pct_time_near_empty) == (None, 1.0)
    assert (b8.avg_availability_ratio, b8.snapshot_count) == (1.5, 2)  # listed twice, counted twice


def test_both_plans_agree(spark, readings, stations):
    small = availability.hourly_availability(availability.attach_capacity(readings, stations))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = availability.hourly_availability_from(readings, stations)
        plan = plan_of(large).split("== Physical Plan ==")[1]
        assert "Broadcast" not in plan
        assert rows(large) == rows(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_both_plans_agree_on_the_test_tables(spark, sf):
    from catalogue import queries as q

    small = rows(q.hourly_supply(spark, sf))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(q.hourly_supply(spark, sf)) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def hourly(spark, *data):
    return spark.createDataFrame(
        [(i, n, 1.0, 2.0, 10, h, b, 1.0, r, 0.5, c) for i, n, h, b, r, c in data],
        """station_id string, station_name string, latitude double, longitude double,
        total_capacity long, hour_of_day int, avg_bikes_available double,
        avg_ebikes_available double, avg_availability_ratio double, pct_time_near_empty double,
        snapshot_count long""",
    )


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_availability_has_one_plan(spark, readings, stations, limit):
    """Tallies come before the join, whether Spark would broadcast the stations or not."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        made = availability.hourly_availability_from(readings, stations)
        plain = availability.hourly_availability(availability.attach_capacity(readings, stations))
        optimised = plan_of(made).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        assert re.search(r"Aggregate.*Join.*Aggregate", optimised, re.S)
        assert rows(made) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_station_availability(spark):
    df = hourly(spark, ("x1", "A", 8, 2.0, 0.2, 1), ("x2", "A", 9, 6.0, 0.6, 3), ("y", " a", 8, 1.0, 0.1, 2))
    plain = {r.station_name: r for r in availability.station_availability(df).collect()}
    assert (plain["A"].avg_availability_ratio, plain["A"].supply_station_id) == (0.4, "x2")
    assert plain["A"].snapshot_count == 4
    weighted = {r.station_name: r for r in availability.station_availability(df, weighted=True).collect()}
    assert weighted["A"].avg_availability_ratio == 0.5
    merged = availability.station_availability(df, group_on_key=True).collect()
    assert [(r.station_name, r.snapshot_count) for r in merged] == [(" a", 6)]
    by_hour = availability.station_availability(df, by_hour=True)
    assert sorted((r.station_name, r.hour_of_day) for r in by_hour.collect()) == [(" a", 8), ("A", 8), ("A", 9)]


def test_name_variants_fan_out_unless_merged(spark):
    wanted = spark.createDataFrame([("1", " A ", 8), ("2", "B", 8)], "station_id string, station_name string, hour_of_day int")
    df = hourly(spark, ("x", "A", 8, 2.0, 0.2, 1), ("y", "a", 8, 6.0, 0.6, 3))
    plain = gap.match_by_name(wanted, availability.station_availability(df))
    assert sorted(r.supply_station_id for r in plain.collect()) == ["x", "y"]
    merged = gap.match_by_name(wanted, availability.station_availability(df, group_on_key=True))
    assert [(r.station_name, r.supply_station_id) for r in merged.collect()] == [(" A ", "y")]


def test_match_by_hour(spark):
    wanted = spark.createDataFrame([("1", "A", 8), ("1", "A", 10)], "station_id string, station_name string, hour_of_day int")
    df = hourly(spark, ("x", "A", 8, 2.0, 0.2, 1), ("x", "A", 9, 6.0, 0.6, 3))
    supply = availability.station_availability(df, by_hour=True)
    matched = gap.match_by_name(wanted, supply, by_hour=True).collect()
    assert [(r.hour_of_day, r.avg_availability_ratio) for r in matched] == [(8, 0.2)]


def test_unmatched(spark):
    wanted = spark.createDataFrame([("1", "A"), ("1", "A"), ("2", "B"), ("3", None)], "station_id string, station_name string")
    supply = spark.createDataFrame([("x", " a"), ("y", "C")], "supply_station_id string, station_name string")
    assert rows(gap.unmatched_stations(wanted, supply)) == sorted(
        [("demand_only", "2", "B"), ("demand_only", "3", None), ("supply_only", "y", "C")], key=repr
    )


def test_hot_name_keeps_every_row(spark):
    """A third of the demand shares one name, the supply is too large to broadcast."""
    wanted = spark.range(9000).select(
        F.col("id").cast("string").alias("station_id"),
        F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("S"), F.col("id") % 500)).alias("station_name"),
        F.lit(8).alias("hour_of_day"),
    )
    supply = spark.range(500).select(
        F.concat(F.lit("s"), F.col("id")).alias("station_name"), F.col("id").alias("supply_station_id")
    ).unionByName(spark.createDataFrame([("hot", 500)], "station_name string, supply_station_id long"))
    names = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    )
    for name in names:
        spark.conf.set(name, "-1")
    try:
        matched = gap.match_by_name(wanted, supply)
        assert "Broadcast" not in plan_of(matched).split("== Physical Plan ==")[1]
        assert matched.count() == 9000
    finally:
        for name in names:
            spark.conf.unset(name)
