import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stationflow.operators import distinct_states as states


def trips(spark, n=60_000):
    i = F.col("id")
    month = (i % 14).cast("int")
    return spark.range(n).select(
        (F.lit(2023) + F.floor(month / 12)).cast("int").alias("year"), (month % 12 + 1).cast("int").alias("month"),
        F.when(i % 10 > 0, F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("rider"),
        F.concat(F.lit("s"), i % 7).alias("station"), (i % 2).alias("kind"),
    )


def test_union_of_months_is_near_the_exact_count(spark, tmp_path):
    df, path = trips(spark), str(tmp_path / "s")
    states.refresh_sketches(df, path, ["rider", "station"], ["kind"])
    stored = spark.read.parquet(path)
    total = states.distinct_counts(stored, ["rider", "station"]).first()
    exact = df.agg(F.count_distinct("rider")).first()[0]
    assert total.rows == 60_000 and total.station == 7
    assert abs(total.rider - exact) <= 5 * states.relative_error() * exact
    months = {(r.year, r.month, r.kind): r for r in states.rolling_distinct(stored, ["rider"], 3, ["kind"]).collect()}
    exact = {(r.year, r.month, r.kind): r.n for r in states.rolling_months(df, 3).groupBy("year", "month", "kind")
             .agg(F.count_distinct("rider").alias("n")).collect()}
    assert (2024, 2, 1) in months and (2024, 3, 1) not in months and (2024, 3, 1) in exact
    for key, row in months.items():
        assert abs(row.rider - exact[key]) <= 5 * states.relative_error() * exact[key], key


def test_only_touched_months_are_read_and_replaced(spark, tmp_path):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "s")
    df = trips(spark, 1_400)
    df.write.partitionBy("year", "month").parquet(raw)
    states.refresh_sketches(spark.read.parquet(raw), path, ["rider"])
    before = rows(states.distinct_counts(spark.read.parquet(path), ["rider"], ["year", "month"]))
    late = df.where("year = 2024 and month = 1").withColumn("rider", F.col("rider") + 1_000_000)
    late.write.partitionBy("year", "month").mode("append").parquet(raw)
    stored = spark.read.parquet(raw)
    states.refresh_sketches(stored, path, ["rider"], months=[(2024, 1)])
    after = rows(states.distinct_counts(spark.read.parquet(path), ["rider"], ["year", "month"]))
    assert [row for row in after if row not in before] == [row for row in after if row[:2] == (2024, 1)]
    assert sum(r[2] for r in after) == sum(r[2] for r in before) + 100
    assert "raw" not in plan_of(states.rolling_distinct(spark.read.parquet(path), ["rider"]))


def test_nulls_and_empty_tables(spark):
    df = trips(spark, 28).withColumn("rider", F.lit(None).cast("string"))
    sketches = states.month_sketches(df, ["rider"])
    assert {r.rider for r in states.distinct_counts(sketches, ["rider"], ["year"]).collect()} == {0}
    assert states.rolling_distinct(sketches.limit(0), ["rider"]).count() == 0
    states.refresh_sketches(df, "/nowhere", ["rider"], months=[])
    assert states.relative_error(12) == pytest.approx(0.01625)


def test_rolling_query_stores_only_its_columns(spark, sf, monkeypatch):
    from catalogue import queries as q

    kept, store = [], q.materialise
    monkeypatch.setattr(q, "materialise", lambda df, label: kept.append(df.columns) or store(df, label))
    q.QUERIES["distinct_rolling"](spark, sf)
    assert kept == [["year", "month", "start_station_id", "ride_id"]]
