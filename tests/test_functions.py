import pytest
from pyspark.sql import functions as F

from stationflow import functions as fn
from stationflow.functions.times import MILLISECONDS, SECONDS


def one(spark, expression, **values):
    row = spark.range(1).select(*(v.alias(k) for k, v in values.items()))
    return row.select(expression).first()[0]


@pytest.mark.parametrize(
    "value, digits, expected",
    [(1.005, 2, 1.01), (2.675, 2, 2.68), (-1.005, 2, -1.01), (0.5, 0, 1.0), (None, 2, None)],
)
def test_round_half_up(spark, value, digits, expected):
    assert one(spark, fn.round_half_up(F.lit(value).cast("double"), digits)) == expected


TIMES = [
    "2024-01-15 14:30:22",
    "2024-01-15 14:30:22.897",
    "2024-01-15 14:30:22.8970",
    "2024-01-15 14:30:22.89",
    "2024-01-15 14:30:22.8",
    "2024-01-15 14:30:22.",
    "2024-01-15T14:30:22",
    "2024-01-15 14:30",
    "2024-01-15",
    "2024-1-5 4:3:2",
    " 2024-01-15 14:30:22",
    "2024-01-15 14:30:22 ",
    "2024-01-15 14:30:22\n",
    "2024-01-15 14:30:22Z",
    "2024-01-15 14:30:22+01:00",
    "2024-02-30 00:00:00",
    "2023-02-29 00:00:00",
    "2024-02-29 23:59:59.999",
    "2024-01-15 24:00:00",
    "2024-01-15 14:60:00",
    "2024-01-15 14:30:60",
    "2024-13-01 00:00:00",
    "2024-00-01 00:00:00",
    "1999-12-31 23:59:59",
    "n/a",
    "",
    None,
]


def test_fast_time_parsing_equals_the_patterns(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string")
    pattern = F.coalesce(
        F.try_to_timestamp("t", F.lit(MILLISECONDS)), F.try_to_timestamp("t", F.lit(SECONDS))
    )
    differ = df.select(
        "t", fn.parse_time(F.col("t")).alias("fast"), pattern.alias("slow")
    ).filter(~F.col("fast").eqNullSafe(F.col("slow")))
    assert differ.collect() == []


def test_time_parsing_with_other_formats(spark):
    parsed = fn.parse_time(F.lit("15/01/2024 14:30"), ["dd/MM/yyyy HH:mm"])
    assert str(one(spark, parsed)) == "2024-01-15 14:30:00"


def test_day_names(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-14')) AS d")
    differ = days.filter(fn.day_name(F.dayofweek("d")) != F.date_format("d", "EEEE"))
    assert differ.count() == 0


def test_trip_minutes_match_decimal_rounding(spark):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = spark.range(0, 86400, 7).withColumn("end", F.timestamp_add("SECOND", F.col("id"), start))
    exact = fn.round_half_up(F.col("id") / 60, 2)
    assert df.filter(fn.trip_minutes(start, F.col("end")) != exact).count() == 0


def test_trip_minutes_round_in_whole_numbers(spark):
    """Every second to either side gives the rounded double, without the decimal that rounding goes through."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = spark.range(-90000, 90000).withColumn("end", F.timestamp_add("SECOND", F.col("id"), start))
    minutes = df.select("id", fn.trip_minutes(start, F.col("end")).alias("minutes"))
    assert minutes.filter(~F.col("minutes").eqNullSafe(F.round(F.col("id") / 60, 2))).count() == 0
    assert minutes.dtypes[1] == ("minutes", "double")
    assert "round(" not in minutes._jdf.queryExecution().toString()
    assert one(spark, fn.trip_minutes(start, F.lit(None).cast("timestamp"))) is None


def test_normalise_name(spark):
    name = F.lit(" \t W 21 St \n")
    assert one(spark, fn.normalise_name(name)) == "w 21 st"
    assert one(spark, fn.normalise_name(name, blanks_only=True)) == " \t w 21 st \n"


def test_ratios(spark):
    number = lambda v: F.lit(v).cast("long")
    assert one(spark, fn.demand_ratio(number(6), number(4))) == 1.5
    assert one(spark, fn.demand_ratio(number(6), number(0))) is None
    assert one(spark, fn.demand_ratio(number(6), number(None))) is None
    assert one(spark, fn.availability_ratio(number(3), number(12))) == 0.25
    assert one(spark, fn.availability_ratio(number(3), number(0))) is None
    assert one(spark, fn.share_pct(number(1), number(3))) == 33.3
    assert one(spark, fn.share_pct(number(1), number(0))) is None
    assert one(spark, fn.pct(F.lit(0.12345))) == 12.3


def test_gap_score(spark):
    score = lambda d, r, **k: one(
        spark, fn.gap_score(F.lit(d).cast("long"), F.lit(r).cast("double"), **k)
    )
    assert score(653, 0.25) == 489.75
    assert score(1, 0.335) == 0.67  # the double product is 0.66499…
    assert score(10, None) == 10.0
    assert score(10, 1.5) == -5.0
    assert score(10, 1.5, clamp=True) == 0.0


@pytest.mark.parametrize(
    "score, label",
    [(500, "CRITICAL"), (499.99, "HIGH"), (200, "HIGH"), (199.99, "MEDIUM"), (50, "MEDIUM"),
     (49.99, "LOW"), (-3, "LOW"), (None, "LOW")],
)
def test_gap_severity(spark, score, label):
    assert one(spark, fn.gap_severity(F.lit(score).cast("double"))) == label


def test_time_periods(spark):
    hours = {r.id: r.p for r in spark.range(24).select("id", fn.time_period(F.col("id")).alias("p")).collect()}
    assert [hours[h] for h in (5, 6, 9, 10, 15, 16, 20, 21)] == [
        "Off-Peak", "Morning Commute", "Morning Commute", "Midday", "Midday",
        "Evening Commute", "Evening Commute", "Off-Peak",
    ]


def test_exact_sums_do_not_depend_on_order(spark):
    df = spark.range(10000).select((F.col("id") % 97 / 100).alias("v"), "id")
    both = [
        df.repartition(n, key).agg(fn.exact_sum(F.col("v"), 2), fn.exact_mean(F.col("v"), 2)).first()
        for n, key in ((3, "id"), (8, "v"))
    ]
    assert both[0] == both[1]
    assert df.limit(0).agg(fn.exact_mean(F.col("v"), 2)).first()[0] is None
