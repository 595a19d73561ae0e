"""Snapshot streams: ingest, repeated readings, rolling availability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators.availability import (
    NEAR_EMPTY,
    NEAR_FULL,
    STATION,
    attach_capacity,
    availability_measures,
    _tally_columns,
)
from stationflow.operators.staging import stage_snapshots
from stationflow.schemas import SNAPSHOT


def stream_snapshots(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SNAPSHOT,
    fmt: str = "json",
    max_files: int | None = None,
) -> DataFrame:
    """Snapshot files as a stream; each file is read once."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


def ingest_snapshots(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    schema: T.StructType = SNAPSHOT,
    max_files: int | None = None,
) -> StreamingQuery:
    """Load the files that arrived since the last run into Parquet by capture date.

    The checkpoint remembers the files, so a repeated or restarted run adds
    nothing twice. Call ``awaitTermination`` to wait for the backlog.
    """
    day = F.to_date(F.col("snapshot_at").cast("timestamp"))
    return (
        stream_snapshots(spark, src, schema, max_files=max_files)
        .withColumn("snapshot_date", day)
        .writeStream.format("parquet")
        .partitionBy("snapshot_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(dst)
    )


def dedupe_snapshots(staged: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """One reading per station and capture time.

    On a stream, repeats are recognised while they arrive within ``delay``, and
    older state is dropped.
    """
    keys = ["station_id", "snapshot_at"]
    if not staged.isStreaming:
        return staged.dropDuplicates(keys)
    return staged.withWatermark("snapshot_at", delay).dropDuplicatesWithinWatermark(keys)


def windowed_availability(
    staged: DataFrame,
    stations: DataFrame,
    width: str = "1 hour",
    delay: str = "30 minutes",
    low: float = NEAR_EMPTY,
    high: float = NEAR_FULL,
) -> DataFrame:
    """Availability per station and time window, for staged snapshots in batch or stream.

    In append mode a window is emitted once the watermark has passed its end.
    """
    timed = staged.withWatermark("snapshot_at", delay) if staged.isStreaming else staged
    return (
        attach_capacity(timed, stations)
        .withColumns(_tally_columns())
        .groupBy(F.window("snapshot_at", width).alias("_window"), *STATION)
        .agg(*availability_measures(low, high))
        .select(
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            "*",
        )
        .drop("_window")
    )


def stage_stream(
    spark: SparkSession, path: str, tz: str | None = None, **options
) -> DataFrame:
    """Staged snapshots straight from the files of a stream."""
    return stage_snapshots(stream_snapshots(spark, path, **options), tz)
