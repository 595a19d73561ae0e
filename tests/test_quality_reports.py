from datetime import datetime

from conftest import plan_of, rows
from pyspark.sql import functions as F

from stationflow.operators import quality, reports


def test_column_checks_share_one_pass(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("z", None)], "k string, h int")
    found = quality.column_checks(df, ["k", "h"], {"k": ["a", "b"], "h": [1, 2]})
    assert plan_of(found).split("== Physical Plan ==")[1].count("Exchange") == 1
    assert rows(found) == [
        ("accepted_values", "h", 0, True),
        ("accepted_values", "k", 1, False),
        ("not_null", "h", 1, False),
        ("not_null", "k", 1, False),
    ]


def test_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c"), (3, "d")], "x int, y string")
    assert rows(quality.unique(df, ["x", "y"])) == [("unique", "x", 1, False), ("unique", "y", 1, False)]
    assert rows(quality.unique(df.limit(0), ["x"])) == [("unique", "x", 0, True)]


def test_unique_with_a_hot_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    assert quality.unique(df, ["id"]).first().failing_rows == 1


def test_freshness_limits(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "ts timestamp")
    status = lambda as_of: quality.freshness(df, "ts", as_of).first().status
    assert status(datetime(2024, 1, 2, 1)) == "pass"  # 25 hours
    assert status(datetime(2024, 1, 2, 1, 0, 1)) == "warn"
    assert status(datetime(2024, 1, 3, 1)) == "warn"  # 49 hours
    assert status(F.lit("2024-01-03 01:00:01")) == "error"
    assert quality.freshness(df.limit(0), "ts").first().status == "error"
    assert quality.freshness(df, "ts").first().status == "error"


def small_mart(spark):
    return spark.createDataFrame(
        [("1", "A", 8, 10.0, 5, None, "MEDIUM"), ("1", "A", 9, 600.0, 7, 0.5, "CRITICAL"), ("2", "B", 8, 3.0, 2, 0.25, "LOW")],
        """station_id string, station_name string, hour_of_day int, supply_gap_score double,
        total_departures long, avg_availability_ratio double, gap_severity string""",
    ).withColumns({"pct_time_near_empty": F.lit(0.1), "avg_bikes_available": F.col("avg_availability_ratio") * 10})


def test_worst_severity_is_not_the_last_label(spark):
    first = reports.worst_stations(small_mart(spark), n=1).first()
    assert (first.station_id, first.total_gap_score) == ("1", 610.0)
    assert (first.max_severity_label, first.worst_severity) == ("MEDIUM", "CRITICAL")


def test_coverage_without_matches_is_null(spark):
    mart = small_mart(spark)
    assert reports.coverage(mart).first().rows_with_availability == 2
    assert reports.coverage(mart.limit(0)).first().rows_with_availability is None


def test_approximate_counts(spark):
    mart = small_mart(spark)
    assert "approx_count_distinct" in plan_of(reports.by_hour(mart, approx=True))
    exact, approx = (rows(reports.by_hour(mart, approx=a)) for a in (False, True))
    assert exact == approx


def test_severity_filter(spark):
    mart = small_mart(spark)
    assert [r.gap_severity for r in reports.filter_severity(mart).collect()] == ["CRITICAL"]
