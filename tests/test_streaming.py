from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stationflow.operators import staging
from stationflow.sources import sinks
from stationflow.streaming import corrections, snapshots as streams

START = datetime(2024, 1, 1)


def polls(spark, minutes, station="a", bikes=4):
    data = [
        (station, bikes, 1, 2, 0, 1, 1, 1, (START + timedelta(minutes=m)).isoformat() + "+00:00") for m in minutes
    ]
    return spark.createDataFrame(
        data,
        """station_id string, num_bikes_available long, num_ebikes_available long,
        num_docks_available long, num_bikes_disabled long, is_installed int, is_renting int,
        is_returning int, snapshot_at string""",
    ).coalesce(1)


def stations(spark):
    return spark.createDataFrame(
        [("a", "A", 1.0, 2.0, 10)],
        "station_id string, station_name string, latitude double, longitude double, total_capacity long",
    )


def drain(stream, spark, tmp_path, name):
    (
        stream.writeStream.format("parquet")
        .option("path", str(tmp_path / name))
        .option("checkpointLocation", str(tmp_path / f"{name}-state"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_ingest_only_new_files(spark, tmp_path):
    src, dst, state = (str(tmp_path / n) for n in ("src", "dst", "state"))
    sinks.append_snapshots(polls(spark, [0, 15]), src)
    for _ in range(2):
        streams.ingest_snapshots(spark, src, dst, state).awaitTermination()
    assert spark.read.parquet(dst).count() == 2
    sinks.append_snapshots(polls(spark, [30, 60 * 24]), src)
    streams.ingest_snapshots(spark, src, dst, state, max_files=1).awaitTermination()
    assert spark.read.parquet(dst).groupBy("snapshot_date").count().count() == 2
    assert spark.read.parquet(dst).count() == 4


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    src = str(tmp_path / "src")
    for _ in range(2):
        sinks.append_snapshots(polls(spark, [0, 15]), src)
    stream = streams.dedupe_snapshots(streams.stage_stream(spark, src, max_files=1))
    found = drain(stream, spark, tmp_path, "out")
    batch = streams.dedupe_snapshots(staging.stage_snapshots(spark.read.json(src).drop("snapshot_date")))
    assert rows(found.select("station_id", "snapshot_at")) == rows(batch.select("station_id", "snapshot_at"))
    assert found.count() == 2


def test_closed_windows_equal_the_batch_result(spark, tmp_path):
    src = str(tmp_path / "src")
    sinks.append_snapshots(polls(spark, [0, 15, 30, 45, 60, 75]), src)
    staged = streams.stage_stream(spark, src, max_files=1)
    # A first run closes no window; a later reading moves the watermark past both.
    windows = streams.windowed_availability(staged, stations(spark))
    assert drain(windows, spark, tmp_path, "out").count() == 0
    sinks.append_snapshots(polls(spark, [240]), src)
    found = drain(windows, spark, tmp_path, "out")
    batch = streams.windowed_availability(
        staging.stage_snapshots(spark.read.json(src).drop("snapshot_date")), stations(spark)
    )
    closed = batch.filter(F.col("window_end") <= F.lit("2024-01-01 03:00:00").cast("timestamp"))
    assert rows(found) == rows(closed)
    assert sorted(r.snapshot_count for r in found.collect()) == [2, 4]


def test_late_readings_of_closed_windows_are_ignored(spark, tmp_path):
    src = str(tmp_path / "src")
    sinks.append_snapshots(polls(spark, [0]), src)
    windows = streams.windowed_availability(streams.stage_stream(spark, src), stations(spark))
    for minutes in ([300], [5], [600]):
        sinks.append_snapshots(polls(spark, minutes), src)
        found = drain(windows, spark, tmp_path, "out")
    first = found.filter(F.col("window_start") == F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert [r.snapshot_count for r in first.collect()] == [1]


def test_late_and_repeated_readings_correct_their_windows(spark, tmp_path, monkeypatch):
    src, store, windows, state = (str(tmp_path / n) for n in ("src", "store", "windows", "state"))
    known = [stations(spark)]

    def run():
        corrections.keep_availability(streams.stage_stream(spark, src), lambda session: known[0], store, windows, state)
        found = corrections.read_windows(spark, windows).orderBy("station_id", "window_start").collect()
        return [(r["station_id"], r["snapshot_count"], r["avg_bikes_available"]) for r in found]

    sinks.append_snapshots(polls(spark, [0, 15, 60 * 24 * 9]), src)
    assert run() == [("a", 2, 4.0), ("a", 1, 4.0)]
    # far behind any watermark: a repeat, and a late reading beside it; a station that was not known before
    sinks.append_snapshots(polls(spark, [15]).unionByName(polls(spark, [30], bikes=10)), src)
    sinks.append_snapshots(polls(spark, [5], station="b"), src)
    known[0] = known[0].unionByName(known[0].selectExpr("'b' station_id", "'B' station_name", "latitude", "longitude", "total_capacity"))
    assert run() == [("a", 3, 6.0), ("a", 1, 4.0), ("b", 1, 4.0)]
    assert run() == [("a", 3, 6.0), ("a", 1, 4.0), ("b", 1, 4.0)]
    # a load that ends between store and windows is done again, and adds nothing twice
    sinks.append_snapshots(polls(spark, [45, 45], bikes=2), src)
    real = corrections.windowed_availability

    def broken(*args):
        raise OSError("no windows today")

    monkeypatch.setattr(corrections, "windowed_availability", broken)
    with pytest.raises(Exception, match="no windows today"):
        run()
    assert spark.read.parquet(store).count() == 6
    monkeypatch.setattr(corrections, "windowed_availability", real)
    assert run() == [("a", 4, 5.0), ("a", 1, 4.0), ("b", 1, 4.0)]
    assert spark.read.parquet(store).count() == 6
