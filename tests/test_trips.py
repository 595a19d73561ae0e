from conftest import plan_of, rows
from pyspark.sql import functions as F

from stationflow.operators import staging, trips
from stationflow.schemas import TRIP_CLEAN, TRIP_RAW


def raw(spark, *changes):
    base = dict(
        ride_id="r", rideable_type="classic_bike", started_at="2024-01-01 10:00:00",
        ended_at="2024-01-01 10:10:00", start_station_name="A", start_station_id="1.01",
        end_station_name="B", end_station_id="2.01", start_lat=1.0, start_lng=2.0, end_lat=3.0,
        end_lng=4.0, member_casual="member",
    )
    data = [tuple({**base, "ride_id": f"r{i}", **c}.values()) for i, c in enumerate(changes)]
    return spark.createDataFrame(data, TRIP_RAW)


def kept(df):
    return sorted(r.ride_id for r in df.select("ride_id").collect())


def test_validity(spark):
    df = raw(
        spark,
        {},
        {"started_at": "n/a"},
        {"ended_at": None},
        {"ended_at": "2024-01-01 10:10:00.1234"},
        {"start_station_id": None},
        {"end_station_id": None},
        {"ended_at": "2024-01-01 10:00:00"},
        {"ended_at": "2024-01-01 10:00:00.001"},
        {"ended_at": "2024-01-02 10:00:00"},
        {"ended_at": "2024-01-02 09:59:59.999"},
        {"start_station_name": None},
        {"started_at": "2024-01-01 10:00:00.900", "ended_at": "2024-01-02 10:00:00"},
    )
    assert kept(trips.enrich_trips(df)) == ["r0", "r10", "r7", "r9"]


def test_calendar(spark):
    df = raw(spark, {"started_at": "2024-03-31 23:59:59.500", "ended_at": "2024-04-01 00:10:00"})
    row = trips.enrich_trips(df).first()
    assert (row.start_hour, row.start_day_of_week, row.start_day_name) == (23, 1, "Sunday")
    assert (str(row.trip_date), row.year, row.month) == ("2024-03-31", 2024, 3)
    assert row.trip_duration_minutes == 10.02
    assert trips.enrich_trips(df).columns == TRIP_CLEAN.fieldNames()


def test_times_are_parsed_once(spark):
    """Filters stay above the parsing, and nothing is shuffled or sent to Python."""
    plan = trips.enrich_trips(raw(spark, {})).explain
    text = plan_of(trips.enrich_trips(raw(spark, {}))).split("== Physical Plan ==")[1]
    assert plan and text.count("RLIKE") == 2
    assert "Exchange" not in text and "Python" not in text


def test_staging_limits(spark):
    clean = trips.enrich_trips(
        raw(
            spark,
            {"ended_at": "2024-01-01 10:00:59"},
            {"ended_at": "2024-01-01 10:01:00"},
            {"ended_at": "2024-01-01 22:00:00"},
            {"ended_at": "2024-01-01 22:00:01"},
            {"ride_id": None},
        )
    )
    assert kept(staging.stage_trips(clean)) == ["r1", "r2"]
    assert kept(staging.stage_trips(clean.filter("ride_id is not null"), 0, 1)) == ["r0", "r1"]


def test_staging_keeps_or_derives_partition_columns(spark):
    clean = trips.enrich_trips(raw(spark, {}))
    with_own = staging.stage_trips(clean.withColumn("year", F.lit(1900)))
    derived = staging.stage_trips(clean.drop("year", "month"))
    assert with_own.first().year == 1900
    assert (derived.first().year, derived.first().month) == (2024, 1)


def test_stage_snapshots(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, 1, 1, 0, 1, 1, 1, "2024-06-15T23:30:00+00:00"),
            ("b", 1, 1, 1, 0, 0, 1, 1, "2024-06-15T23:30:00+00:00"),
            (None, 1, 1, 1, 0, 1, 1, 1, "2024-06-15T23:30:00+00:00"),
            ("d", 1, 1, 1, 0, 1, 1, 1, None),
            ("e", None, 1, 1, 0, None, 1, 1, "2024-06-15T23:30:00+00:00"),
        ],
        """station_id string, num_bikes_available int, num_ebikes_available int,
        num_docks_available int, num_bikes_disabled int, is_installed int, is_renting int,
        is_returning int, snapshot_at string""",
    )
    utc = staging.stage_snapshots(df).collect()
    assert [(r.station_id, r.snapshot_hour, str(r.snapshot_date)) for r in utc] == [
        ("a", 23, "2024-06-15")
    ]
    local = staging.stage_snapshots(df, "Asia/Tokyo").first()
    assert (local.snapshot_hour, str(local.snapshot_date)) == (8, "2024-06-16")


def test_stage_stations(spark):
    df = spark.createDataFrame(
        [("1", "A", "s", 1.0, 2.0, 5, "r"), ("", "B", "s", 1.0, 2.0, 5, "r"), ("3", "", "s", 1.0, 2.0, 5, "r"),
         ("4", "D", "s", 1.0, 2.0, 0, "r"), (None, "E", "s", 1.0, 2.0, 5, "r")],
        "station_id string, name string, short_name string, lat double, lon double, capacity long, region_id string",
    )
    assert [r[0] for r in rows(staging.stage_stations(df))] == ["", "1", "3"]
    assert [r[0] for r in rows(staging.stage_stations(df, empty_as_null=True))] == ["1"]
