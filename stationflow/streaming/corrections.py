"""Availability windows that late and repeated readings correct, load by load.

A watermark forgets: a repeat after it is stored again, a late reading is lost. Here what was stored is the memory. Each
load adds the readings that no earlier one has, under folders of their date and load, and computes the windows of the
dates it touched anew. Both are replaced as a whole when a load is done again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.streaming.snapshots import windowed_availability

KEYS = ("station_id", "snapshot_at")
DATE, LOAD, WINDOW_DATE = "snapshot_date", "load", "window_date"


def one_per_key(staged: DataFrame) -> DataFrame:
    """One reading per station and time: of several that differ, the one that sorts first."""
    rest = [c for c in staged.columns if c not in KEYS]
    least = staged.groupBy(*KEYS).agg(F.min(F.struct(*rest)).alias("_reading"))
    return least.select(*KEYS, "_reading.*").select(*staged.columns)


def keep_availability(
    staged: DataFrame,
    stations: Callable[[SparkSession], DataFrame],
    store: str,
    windows: str,
    checkpoint: str,
    width: str = "1 hour",
) -> StreamingQuery:
    """Take in the staged readings that have arrived, correct the windows they fall into, and stop.

    ``width`` has to divide a day. ``stations`` is called for each load, so a station that was added or changed counts
    from the next load on its dates. A reading that the store has is not stored again, however old; a load that is
    repeated after a failure changes nothing more.
    """
    spark = staged.sparkSession
    for path in (store, windows):
        _make_folder(spark, path)
    schema = staged.schema.add(LOAD, "long")

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # As many as the calendar has.
        dates = [r[DATE] for r in batch.select(DATE).distinct().collect()]
        if not dates:
            return
        stored = session.read.schema(schema).parquet(store).where(F.col(DATE).isin(dates))
        earlier = stored.where(F.col(LOAD) < number).select(*KEYS)
        new = one_per_key(batch).join(earlier, list(KEYS), "left_anti")
        _replace(new.withColumn(LOAD, F.lit(number).cast("long")), store, [DATE, LOAD])
        stored = session.read.schema(schema).parquet(store).where(F.col(DATE).isin(dates))
        found = windowed_availability(stored.drop(LOAD), stations(session), width)
        _replace(found.withColumn(WINDOW_DATE, F.to_date("window_start")), windows, [WINDOW_DATE])

    started = (
        staged.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return started


def read_windows(spark: SparkSession, windows: str) -> DataFrame:
    """The windows as they stand."""
    return spark.read.parquet(windows).drop(WINDOW_DATE)


def _replace(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write ``df`` below ``path``, one file set per folder; folders that it fills lose what they held."""
    writer = df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def _make_folder(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
