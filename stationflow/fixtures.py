"""Domain tables derived from the generic test tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationflow.plans.mart import MartOptions

# Parameters that suit the small counts of the test tables.
BANDS = (5, 2, 0.5)
MARKERS = ("-trip-data", "-trip_data")
FILES_AS_OF = datetime(2001, 8, 15)
FILES_MONTHS = 12
FRESH_AS_OF = {
    "pass": datetime(2024, 1, 31, 6),
    "warn": datetime(2024, 2, 1, 6),
    "error": datetime(2024, 2, 3),
}
OPTIONS = MartOptions(bands=BANDS)

_TEXT_TIME = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _coordinate(base: float, key: Column) -> Column:
    return F.lit(base) + (key % 32) / F.lit(64.0)


def _station(key: Column) -> Column:
    return F.concat(key.cast("string"), F.lit(".01"))


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV row of a trip, from line items and suppliers."""
    order, part, supp, line = (
        F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    )
    price = F.floor("l_extendedprice")
    offset = (order * 37) % 86400
    lasts = F.when(line == 7, price - 1500).otherwise(F.floor(F.col("l_extendedprice") / 20))

    def at(seconds: Column) -> Column:
        day = F.col("l_shipdate")
        return F.date_format(F.timestamp_add("SECOND", seconds.cast("int"), day), _TEXT_TIME)

    start = at(offset)
    place = part % 100
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
        F.col("l_suppkey") == F.col("s_suppkey"),
    )
    return rows.select(
        F.concat_ws("-", order.cast("string"), line.cast("string")).alias("ride_id"),
        F.when(F.col("l_linestatus") == "O", "electric_bike")
        .otherwise("classic_bike")
        .alias("rideable_type"),
        F.when((line == 6) & (part % 50 == 0), "n/a")
        .when(order % 2 == 1, F.concat(start, F.lit(".250")))
        .otherwise(start)
        .alias("started_at"),
        at(offset + lasts).alias("ended_at"),
        F.when(supp % 3 == 0, F.concat(F.lit(" "), F.upper("s_name"), F.lit(" ")))
        .otherwise(F.col("s_name"))
        .alias("start_station_name"),
        F.when(order % 97 != 0, _station(supp)).alias("start_station_id"),
        F.concat(F.lit("Supplier#"), F.lpad(place.cast("string"), 9, "0")).alias(
            "end_station_name"
        ),
        F.when(order % 89 != 0, _station(place)).alias("end_station_id"),
        _coordinate(40.5, supp).alias("start_lat"),
        _coordinate(-74.0, supp).alias("start_lng"),
        _coordinate(40.5, part).alias("end_lat"),
        _coordinate(-74.0, part).alias("end_lng"),
        F.when(F.col("l_returnflag") == "A", "casual").otherwise("member").alias("member_casual"),
    )


def _reading_columns() -> list[Column]:
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.col("event_type")
    return [
        F.concat(F.lit("feed-"), F.col("user_id").cast("string")).alias("station_id"),
        (k % 15).alias("num_bikes_available"),
        (k % 5).alias("num_ebikes_available"),
        (15 - k % 15).alias("num_docks_available"),
        (k % 3).alias("num_bikes_disabled"),
        F.when(kind == "error", 0).otherwise(1).alias("is_installed"),
        F.lit(1).alias("is_renting"),
        F.when(kind == "view", 0).otherwise(1).alias("is_returning"),
    ]


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat snapshot row, from events."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        *_reading_columns(),
        F.concat(iso, F.lit("+00:00")).alias("snapshot_at"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("snapshot_epoch"),
    )


def snapshot_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested snapshot documents, one per event, with its capture time.

    A document lists the event's station, and a second one for clicks; error
    events give an empty document and purchases one without data.
    """
    station = F.struct(*_reading_columns())
    other = station.withField(
        "station_id", F.concat(F.lit("other-"), F.col("user_id").cast("string"))
    )
    kind = F.col("event_type")
    one = F.array(station)
    listed = (
        F.when(kind == "error", F.slice(one, 1, 0))
        .when(kind == "click", F.array(station, other))
        .otherwise(one)
    )
    return table(spark, sf_dir, "events").select(
        F.when(kind != "purchase", F.struct(listed.alias("stations"))).alias("data"),
        F.lit(5).cast("bigint").alias("ttl"),
        F.col("ts").cast("timestamp").alias("captured_at"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station reference row, from suppliers."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("feed-"), key.cast("string")).alias("station_id"),
        F.col("s_name").alias("name"),
        F.right("s_name", F.lit(4)).alias("short_name"),
        _coordinate(40.5, key).alias("lat"),
        _coordinate(-74.0, key).alias("lon"),
        F.floor(F.col("s_acctbal") / 250).alias("capacity"),
        F.col("s_nationkey").cast("string").alias("region_id"),
    )


def station_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested station documents, one per station, with fields missing here and there."""
    key = F.col("station_id")
    number = F.substring_index(key, "-", -1).cast("int")
    entry = F.struct(
        F.when(number % 11 != 0, key).alias("station_id"),
        F.when(number % 7 != 0, F.col("name")).alias("name"),
        "short_name",
        F.col("lat").cast("string").alias("lat"),
        F.when(number % 5 != 0, F.col("lon").cast("string")).alias("lon"),
        F.when(F.col("capacity") > 0, F.col("capacity").cast("string")).alias("capacity"),
        "region_id",
    )
    return stations(spark, sf_dir).select(F.struct(F.array(entry).alias("stations")).alias("data"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object listing, from orders."""
    key = F.col("o_orderkey")
    ending = F.element_at(
        F.array(*(F.lit(e) for e in (".zip", ".csv", ".csv.zip", ".html"))),
        (key % 4 + 1).cast("int"),
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(
            F.when(key % 7 == 0, "JC-").otherwise(""),
            F.date_format("o_orderdate", "yyyyMM"),
            F.when(key % 5 == 0, MARKERS[1]).otherwise(MARKERS[0]),
            ending,
        ).alias("key"),
        key.alias("size_bytes"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys already loaded: every third of the listing."""
    return files(spark, sf_dir).filter(F.col("size_bytes") % 3 == 0).select("key")
