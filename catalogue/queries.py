"""One query per operator, over the domain tables derived from the test tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalogue.landing import write_trip_archives
from stationflow import fixtures as fx
from stationflow.functions import gap_severity
from stationflow.operators import (
    availability,
    demand,
    demand_states,
    distinct_states,
    gap,
    quality,
    ranking,
    reports,
    staging,
    trips,
)
from stationflow.plans import layers, mart as plans
from stationflow.schemas import RIDER_KINDS, SEVERITIES, SNAPSHOT, TRIP_CLEAN, TRIP_RAW
from stationflow.session import CHECKPOINT_DIR, materialise, scratch_path
from stationflow.sources import (
    archives,
    audit,
    compaction,
    layouts,
    listing,
    sinks,
    snapshots as snap,
    trips as trip_sources,
)
from stationflow.streaming import archives as archive_loads, corrections, snapshots as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
_stored: dict[tuple[str, str, str], DataFrame] = {}


def query(run: Query) -> Query:
    """Register ``run`` under its own name, with naive timestamps in its result."""

    def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_scratch(spark)
        return naive_times(run(spark, sf_dir))

    QUERIES[run.__name__] = registered
    return run


def ensure_scratch(spark: SparkSession) -> None:
    """Give a local session that names no shared folder one of this machine's."""
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if not named and (context.master == "local" or context.master.startswith("local[")):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stationflow-"))


def naive_times(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in df.schema
            if isinstance(f.dataType, T.TimestampType)
        }
    )


def stored(spark: SparkSession, sf_dir: str, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` as a stored table, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _stored:
        _stored[key] = materialise(build(), label)
    return _stored[key]


# Relations -----------------------------------------------------------------


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.enrich_trips(fx.trips_raw(spark, sf_dir))


def staged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_trips(clean(spark, sf_dir))


def staged_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_snapshots(fx.snapshots(spark, sf_dir))


def staged_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_stations(fx.stations(spark, sf_dir))


def hourly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.hourly_demand(staged_trips(spark, sf_dir))


def hourly_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return availability.hourly_availability_from(
        staged_snapshots(spark, sf_dir), staged_stations(spark, sf_dir)
    )


def station_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return availability.station_availability(hourly_supply(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap.score_gaps(hourly_demand(spark, sf_dir), station_supply(spark, sf_dir))


def build_mart(spark: SparkSession, sf_dir: str, **changes) -> DataFrame:
    return plans.build_mart(
        clean(spark, sf_dir),
        fx.snapshots(spark, sf_dir),
        fx.stations(spark, sf_dir),
        replace(fx.OPTIONS, **changes),
    )


def stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as the table that reports read."""
    return stored(spark, sf_dir, "mart", lambda: build_mart(spark, sf_dir))


def mart_key(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*gap.MART_TIES, "supply_gap_score", *more)


# Sources and sinks ---------------------------------------------------------


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return path


@query
def trips_csv_scan(spark, sf_dir):
    path = _write_csv(fx.trips_raw(spark, sf_dir), scratch_path(spark, "csv"))
    return trip_sources.read_trips_csv(spark, path)


@query
def trips_csv_corrupt(spark, sf_dir):
    raw = fx.trips_raw(spark, sf_dir)
    bad = F.col("ended_at").endswith("7")
    spoilt = raw.withColumn(
        "start_lat", F.when(bad, F.lit("north")).otherwise(F.col("start_lat").cast("string"))
    )
    path = _write_csv(spoilt, scratch_path(spark, "csv"))
    read = trip_sources.read_trips_csv(spark, path, corrupt_col=trip_sources.CORRUPT)
    good, corrupt = trip_sources.split_corrupt(read)
    line = F.lit(None).cast("string").alias("line")
    return good.select(F.lit("good").alias("kind"), "ride_id", line).unionByName(
        corrupt.select(
            F.lit("corrupt").alias("kind"), "ride_id", F.col(trip_sources.CORRUPT).alias("line")
        )
    )


OLD_NAMES = {
    "Start Time": "started_at",
    "Stop Time": "ended_at",
    "Start Station ID": "start_station_id",
    "Start Station Name": "start_station_name",
    "End Station ID": "end_station_id",
    "End Station Name": "end_station_name",
    "Bike ID": "ride_id",
}


@query
def trips_csv_layouts(spark, sf_dir):
    root = scratch_path(spark, "csv")
    raw = fx.trips_raw(spark, sf_dir)
    electric = F.col("rideable_type") == "electric_bike"
    old_columns = [F.col(new).alias(old) for old, new in OLD_NAMES.items()]
    _write_csv(raw.filter(electric), f"{root}/new")
    _write_csv(raw.filter(~electric).select(*old_columns), f"{root}/old")
    old = T.StructType([T.StructField(name, T.StringType()) for name in OLD_NAMES])
    return trip_sources.read_trips_csv(
        spark,
        root,
        layouts=[
            trip_sources.TripLayout(TRIP_RAW, folder="new"),
            trip_sources.TripLayout(old, OLD_NAMES, folder="old"),
        ],
    )


@query
def trips_csv_by_header(spark, sf_dir):
    """Orders dealt to four kinds of files in one folder: new, old, reordered with one column more, and unknown."""
    root = scratch_path(spark, "csv")
    raw = fx.trips_raw(spark, sf_dir)
    fourth = F.substring_index("ride_id", "-", 1).cast("bigint") % 4
    kinds = [
        raw.columns,
        [F.col(new).alias(old) for old, new in OLD_NAMES.items()],
        ["member_casual", F.lit("none").alias("promotion"), *reversed(raw.columns[:-1])],
        [F.col(name).alias(f"{name}_x") for name in raw.columns],
    ]
    for i, columns in enumerate(kinds):
        raw.filter(fourth == i).select(*columns).write.mode("append").option("header", True).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(root)
    old = T.StructType([T.StructField(name, T.StringType()) for name in OLD_NAMES])
    known = [trip_sources.TripLayout(TRIP_RAW), trip_sources.TripLayout(old, OLD_NAMES)]
    rows, _ = layouts.read_trips_by_header(spark, root, known)
    return rows


def _archived(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Raw trips, written as zip archives and unpacked again."""
    path = scratch_path(spark, "archives")
    write_trip_archives(raw, path)
    return archives.unpack_trip_archives(spark, path)


def _thirds_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in three folders of archives by their order; the archives of every third order are damaged."""
    path = scratch_path(spark, "archives")
    for i in range(3):
        _land_third(spark, sf_dir, i, path)
    return archives.unpack_trip_archives(spark, path)


def _land_third(spark: SparkSession, sf_dir: str, i: int, path: str) -> None:
    raw = fx.trips_raw(spark, sf_dir)
    third = F.substring_index("ride_id", "-", 1).cast("bigint") % 3
    write_trip_archives(raw.filter(third == i), f"{path}/{i}", broken=i == 0, every=1)


def _good(unpacked: DataFrame) -> DataFrame:
    read = F.col(archives.ERROR).isNull() & F.col(trip_sources.CORRUPT).isNull()
    return unpacked.filter(read).select(*TRIP_RAW.fieldNames())


@query
def trips_archive_scan(spark, sf_dir):
    return _good(_archived(spark, fx.trips_raw(spark, sf_dir)))


@query
def trips_archive_multiline(spark, sf_dir):
    """Names with line breaks, quotes and commas in quoted cells."""
    name = F.concat("start_station_name", F.lit('\n"A", '), "end_station_name", F.lit("\n\nB"))
    raw = fx.trips_raw(spark, sf_dir).withColumn("start_station_name", name)
    return _good(_archived(spark, raw))


@query
def trips_archive_failed_member(spark, sf_dir):
    return _good(_thirds_archived(spark, sf_dir))


@query
def trips_archive_results(spark, sf_dir):
    results = archives.archive_results(_archived(spark, fx.trips_raw(spark, sf_dir)))
    return results.agg(
        F.sum("rows").alias("rows"),
        F.sum("corrupt_rows").alias("corrupt_rows"),
        F.count("error").alias("errors"),
    )


@query
def files_ingest_report(spark, sf_dir):
    """Folders of archives that loaded and that failed; how many archives a folder has is up to the tasks."""
    results = archives.archive_results(_thirds_archived(spark, sf_dir))
    folder = F.element_at(F.split("path", "/"), -2)
    return archives.ingest_report(results.groupBy(folder.alias("path")).agg(F.max("error").alias("error")))


@query
def trips_archives_incremental(spark, sf_dir):
    """Archives that arrive between runs: each trip with the load that brought it, none twice, none of a damaged archive."""
    path, out, ledger, state = (scratch_path(spark, name) for name in ("archives", "loaded", "ledger", "state"))
    for arrived in ((1,), (2, 0), ()):
        for i in arrived:
            _land_third(spark, sf_dir, i, path)
        archive_loads.load_new_archives(spark, path, out, ledger, state)
    loads = archive_loads.read_ledger(spark, ledger).where("error is null").select("path", "load")
    trips_loaded = archive_loads.read_loaded(spark, out, all_rows=True)
    return trips_loaded.join(loads, F.col(archives.ARCHIVE) == F.col("path")).select("ride_id", "load")


@query
def trips_parquet_scan(spark, sf_dir):
    path = scratch_path(spark, "trips")
    sinks.write_trips(clean(spark, sf_dir), path, compact=True)
    return trip_sources.read_trips(spark, path)


@query
def trips_external_table(spark, sf_dir):
    path = scratch_path(spark, "trips")
    sinks.write_trips(clean(spark, sf_dir), path, compact=True)
    name = "trips_" + path.rsplit("-", 1)[-1]
    table = sinks.register_external(
        spark, name, "parquet", path, TRIP_CLEAN, partitioned_by=["year", "month"]
    )
    return table.groupBy("year", "month").agg(F.count(F.lit(1)).alias("trips"))


@query
def snapshots_json_scan(spark, sf_dir):
    path = scratch_path(spark, "snapshots")
    sinks.append_snapshots(fx.snapshots(spark, sf_dir), path)
    return snap.read_snapshots(spark, path).drop("last_reported")


@query
def snapshots_json_day(spark, sf_dir):
    path = scratch_path(spark, "snapshots")
    sinks.append_snapshots(fx.snapshots(spark, sf_dir), path)
    return snap.read_snapshots(spark, path, day="2024-01-15").drop("last_reported")


@query
def snapshots_range(spark, sf_dir):
    """Four days, of which one has no folder, from landed files and from those a stream wrote."""
    landed, ingested = scratch_path(spark, "snapshots"), scratch_path(spark, "ingested")
    readings = fx.snapshots(spark, sf_dir).filter(~F.col("snapshot_at").startswith("2024-01-16"))
    sinks.append_snapshots(readings, landed)
    streams.ingest_snapshots(spark, landed, ingested, scratch_path(spark, "state")).awaitTermination()
    parts = [
        snap.read_snapshots(spark, path, since="2024-01-14", until="2024-01-17", fmt=fmt)
        .drop("last_reported")
        .withColumn("fmt", F.lit(fmt))
        for path, fmt in ((landed, "json"), (ingested, "parquet"))
    ]
    return parts[0].unionByName(parts[1])


@query
def snapshots_flattened(spark, sf_dir):
    return snap.flatten_snapshot(fx.snapshot_docs(spark, sf_dir), F.col("captured_at"))


def _new_field_landed(spark, sf_dir):
    """Documents with a field that no schema here names, landed as JSON."""
    path = scratch_path(spark, "documents")
    stations = F.transform(
        "data.stations", lambda s: s.withField("num_scooters", s["num_bikes_available"] + 1)
    )
    docs = fx.snapshot_docs(spark, sf_dir)
    docs = docs.withColumn("data", F.when(F.col("data").isNotNull(), F.struct(stations.alias("stations"))))
    docs.write.option("timestampFormat", snap.ISO_TIME).json(path)
    return path


@query
def snapshots_flattened_new_field(spark, sf_dir):
    """The new field survives an inferred schema."""
    read = snap.read_snapshot_documents(
        spark, _new_field_landed(spark, sf_dir), schema=None, one_per_file=False
    )
    return snap.flatten_snapshot(read, F.col("captured_at")).select(
        "station_id", "num_bikes_available", "num_scooters", "snapshot_at"
    )


def _variant_snapshots(spark, sf_dir):
    docs = snap.read_variant_documents(spark, _new_field_landed(spark, sf_dir), one_per_file=False)
    taken = F.try_variant_get(docs[snap.DOC], "$.captured_at", "timestamp")
    return snap.flatten_variant_snapshot(docs, taken)


@query
def snapshots_variant(spark, sf_dir):
    """The new field survives without a schema and without a scan to infer one."""
    return _variant_snapshots(spark, sf_dir).select(
        "station_id",
        "num_bikes_available",
        snap.variant_field("num_scooters", "bigint").alias("num_scooters"),
        "snapshot_at",
    )


@query
def snapshots_field_kinds(spark, sf_dir):
    """Fields of the feed that the snapshot schema does not name."""
    known = SNAPSHOT.fieldNames()
    return snap.field_kinds(_variant_snapshots(spark, sf_dir)).filter(~F.col("field").isin(known))


@query
def snapshots_compacted(spark, sf_dir):
    """Readings of polls in several files a date, packed: readings and files per date afterwards."""
    table = sinks.qualified(_database(spark, "raw"), "readings")
    rows = fx.snapshots(spark, sf_dir)
    dated = rows.withColumn(snap.PARTITION, F.to_date(F.col("snapshot_at").cast("timestamp")))
    sinks.publish(dated.repartition(4), table, as_="table", partition_by=[snap.PARTITION])
    compaction.compact_partitions(spark, table)
    return (
        spark.table(table)
        .groupBy(snap.PARTITION)
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.count_distinct("_metadata.file_path").alias("files"),
            F.sum("num_bikes_available").alias("bikes"),
        )
    )


@query
def snapshots_ingest_batch(spark, sf_dir):
    """Documents flattened, landed by day, read back and staged."""
    path = scratch_path(spark, "snapshots")
    docs = fx.snapshot_docs(spark, sf_dir)
    sinks.append_snapshots(snap.flatten_snapshot(docs, F.col("captured_at")), path)
    return staging.stage_snapshots(snap.read_snapshots(spark, path))


@query
def stations_flattened(spark, sf_dir):
    return snap.flatten_station_info(fx.station_docs(spark, sf_dir), "2024-02-01 00:00:00")


@query
def trips_sample(spark, sf_dir):
    return reports.trips_sample(clean(spark, sf_dir))


@query
def row_counts(spark, sf_dir):
    """Trips, snapshots and stations are each read once, for the source and its staged rows."""
    return audit.row_counts(
        {
            "trips": clean(spark, sf_dir),
            "snapshots": fx.snapshots(spark, sf_dir),
            "stations": fx.stations(spark, sf_dir),
            # One row per cell of departures: arrivals add none.
            "demand_hourly": demand.departure_cells(staged_trips(spark, sf_dir)),
            "availability_hourly": hourly_supply(spark, sf_dir),
            "mart": stored_mart(spark, sf_dir),
        },
        {
            "trips": {"stg_trips": staging.valid_trip(*staging.TRIP_MINUTES)},
            "snapshots": {"stg_snapshots": staging.valid_snapshot()},
            "stations": {"stg_stations": staging.valid_station()},
        },
    )


# Tables --------------------------------------------------------------------


def _database(spark: SparkSession, label: str) -> str:
    """A database of this run, below the scratch folder."""
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


@query
def table_stations_replaced(spark, sf_dir):
    """The second load replaces the first, whole."""
    table = sinks.qualified(_database(spark, "raw"), "station_info")
    info = fx.stations(spark, sf_dir)
    sinks.replace_station_info(info, table)
    sinks.replace_station_info(info.filter("capacity > 0"), table)
    return spark.table(table)


@query
def mart_published(spark, sf_dir):
    """The mart as a clustered table that replaces an earlier one, read back."""
    table = sinks.qualified(_database(spark, "marts"), "gap")
    built = stored_mart(spark, sf_dir)
    sinks.publish(built.limit(1), table, as_="table")
    return sinks.publish(built, table, as_="table", cluster_by=["station_id", "hour_of_day"])


@query
def mart_interleaved(spark, sf_dir):
    """The mart in Z-order, for filters on station, hour or weekday alike."""
    table = sinks.qualified(_database(spark, "marts"), "gap")
    columns = ["station_id", "hour_of_day", "start_day_of_week"]
    return sinks.publish(
        stored_mart(spark, sf_dir), table, as_="table", cluster_by=columns, interleave=True
    )


@query
def layer_tables(spark, sf_dir):
    """Tables of a layer, among them none of a write under way."""
    layer = _database(spark, "layer")
    for name, rows in (("stations", fx.stations(spark, sf_dir)), ("files", fx.files(spark, sf_dir))):
        sinks.publish(rows, sinks.qualified(layer, name), as_="table")
        sinks.publish(rows, sinks.qualified(layer, name), as_="table")
    return sinks.list_layer(spark, layer)


@query
def trips_months_replaced(spark, sf_dir):
    """A later load with one month replaces that month and leaves the others."""
    path = scratch_path(spark, "trips")
    rows = clean(spark, sf_dir)
    sinks.write_trips(rows, path, compact=True)
    later = rows.filter("year = 1995 and month = 6 and member_casual = 'member'")
    sinks.write_trips(later, path, compact=True)
    read = trip_sources.read_trips(spark, path)
    return read.groupBy("year", "month").agg(F.count(F.lit(1)).alias("trips"))


@query
def storage_inventory(spark, sf_dir):
    """Folders of the trips by month, as the inventory lists them after a write."""
    path = scratch_path(spark, "trips")
    sinks.write_trips(clean(spark, sf_dir), path, compact=True)
    found = listing.storage_inventory(spark, path, depth=2).filter(F.col("folder").startswith("year="))
    filled = (F.col("files") > 0) & (F.col("bytes") > 0)
    return found.select(F.concat("folder", F.lit("/")).alias("folder"), filled.alias("has_data"))


@query
def layer_views(spark, sf_dir):
    """Views of the staging layer over the raw layer's tables, listed and counted by another session."""
    raw, staged = _database(spark, "raw"), _database(spark, "staging")
    sinks.ensure_layers(spark, [raw, staged])
    tables = {"trips": clean, "snapshots": fx.snapshots, "stations": fx.stations}
    for name, rows in tables.items():
        sinks.publish(rows(spark, sf_dir), sinks.qualified(raw, name), as_="table")
    layers.publish_staging(spark, raw, staged)
    other = spark.newSession()
    counts = [
        other.table(sinks.qualified(staged, name)).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name in tables
    ]
    return sinks.list_layer(other, staged).join(reduce(DataFrame.unionByName, counts), "table_name")


@query
def demand_incremental(spark, sf_dir):
    """Demand from states per month, after a late load for one month of which only part had come."""
    path, states = scratch_path(spark, "trips"), scratch_path(spark, "states")
    # The raw rows are parsed once, and only what the states are made from is stored.
    rows = staged_trips(spark, sf_dir).select(*demand_states.trip_columns())
    sinks.write_trips(rows, path, compact=True)
    # The late load is one month's folder, held back: until it comes, only its members' trips stand there.
    load = materialise(demand_states.of_months(trip_sources.read_trips(spark, path, rows.schema), [(1995, 6)]), "load")
    sinks.write_trips(load.filter("member_casual = 'member'"), path, compact=True)
    demand_states.refresh_states(trip_sources.read_trips(spark, path, rows.schema), states)
    sinks.write_trips(load, path, compact=True)
    months = demand_states.touched_months(load)
    demand_states.refresh_states(trip_sources.read_trips(spark, path, rows.schema), states, months)
    return demand_states.merge_states(demand_states.read_states(spark, states))


@query
def distinct_rolling(spark, sf_dir):
    """Stations and trips of each quarter-long run of months, from stored sketches, next to the exact counts."""
    path, columns = scratch_path(spark, "sketches"), ["start_station_id", "ride_id"]
    # Read twice, for sketches and exact counts: only these columns are stored.
    rows = materialise(clean(spark, sf_dir).select("year", "month", *columns), "months")
    distinct_states.refresh_sketches(rows, path, columns)
    rolling = distinct_states.rolling_distinct(spark.read.parquet(path), columns)
    exact = (
        distinct_states.rolling_months(rows, 3)
        .groupBy("year", "month")
        .agg(*(F.count_distinct(name).alias(f"{name}_exact") for name in columns))
    )
    error = 5 * distinct_states.relative_error()

    def near(name):
        return F.abs(F.col(name) - F.col(f"{name}_exact")) <= error * F.col(f"{name}_exact")

    return rolling.join(exact, ["year", "month"]).select(
        "year",
        "month",
        "rows",
        F.col("start_station_id_exact").alias("stations"),
        F.col("ride_id_exact").alias("rides"),
        near("start_station_id").alias("stations_near"),
        near("ride_id").alias("rides_near"),
    )


# File listing --------------------------------------------------------------


@query
def files_selected(spark, sf_dir):
    return listing.select_trip_files(fx.files(spark, sf_dir), markers=fx.MARKERS)


@query
def files_selected_loose(spark, sf_dir):
    return listing.select_trip_files(fx.files(spark, sf_dir), strict=False, markers=fx.MARKERS)


@query
def files_recent(spark, sf_dir):
    return listing.filter_recent_months(
        fx.files(spark, sf_dir), fx.FILES_MONTHS, fx.FILES_AS_OF.replace(hour=9)
    )


@query
def files_recent_exclusive(spark, sf_dir):
    return listing.filter_recent_months(
        fx.files(spark, sf_dir),
        fx.FILES_MONTHS,
        fx.FILES_AS_OF.replace(hour=9),
        inclusive=False,
    )


@query
def files_pending(spark, sf_dir):
    return listing.skip_loaded(fx.files(spark, sf_dir), fx.manifest(spark, sf_dir))


@query
def files_inventory(spark, sf_dir):
    month, name = F.substring("key", 1, 6), F.col("key")
    stored_as = F.when(
        name.startswith("JC-"), F.concat_ws("/", F.lit("other"), name)
    ).otherwise(F.concat_ws("/", F.lit("raw"), month, name))
    return listing.folder_totals(fx.files(spark, sf_dir).withColumn("key", stored_as))


# Trips and staging ---------------------------------------------------------


@query
def trips_parsed(spark, sf_dir):
    return trips.parse_trip_times(fx.trips_raw(spark, sf_dir)).select(
        "ride_id", "started_at", "ended_at", "started_at_ts", "ended_at_ts"
    )


@query
def trips_clean(spark, sf_dir):
    return (
        fx.trips_raw(spark, sf_dir)
        .transform(trips.parse_trip_times)
        .transform(trips.clean_trips)
        .drop("started_at", "ended_at")
    )


@query
def trips_enriched(spark, sf_dir):
    return clean(spark, sf_dir)


@query
def stg_trips(spark, sf_dir):
    return staged_trips(spark, sf_dir)


@query
def stg_snapshots(spark, sf_dir):
    return staged_snapshots(spark, sf_dir)


@query
def stg_stations(spark, sf_dir):
    return staged_stations(spark, sf_dir).drop("info_loaded_at")


# Demand and availability ---------------------------------------------------


@query
def demand_departures(spark, sf_dir):
    return demand.departures(staged_trips(spark, sf_dir))


@query
def demand_arrivals(spark, sf_dir):
    return demand.arrivals(staged_trips(spark, sf_dir))


@query
def demand_net(spark, sf_dir):
    return hourly_demand(spark, sf_dir)


@query
def demand_net_joined(spark, sf_dir):
    staged = staged_trips(spark, sf_dir)
    return demand.net_demand(demand.departures(staged), demand.arrivals(staged))


@query
def demand_net_one_pass(spark, sf_dir):
    return demand.hourly_demand_one_pass(staged_trips(spark, sf_dir))


@query
def demand_net_by_end_one_pass(spark, sf_dir):
    return demand.hourly_demand_one_pass(staged_trips(spark, sf_dir), bucket="end")


@query
def demand_net_by_end(spark, sf_dir):
    return demand.hourly_demand(staged_trips(spark, sf_dir), bucket="end")


@query
def demand_ranked(spark, sf_dir):
    return demand.rank_by_departures(hourly_demand(spark, sf_dir))


@query
def snapshots_with_capacity(spark, sf_dir):
    return availability.attach_capacity(
        staged_snapshots(spark, sf_dir), staged_stations(spark, sf_dir)
    )


@query
def availability_hourly(spark, sf_dir):
    return hourly_supply(spark, sf_dir)


@query
def availability_station(spark, sf_dir):
    return station_supply(spark, sf_dir)


@query
def availability_station_weighted(spark, sf_dir):
    return availability.station_availability(hourly_supply(spark, sf_dir), weighted=True)


@query
def availability_station_on_key(spark, sf_dir):
    return availability.station_availability(hourly_supply(spark, sf_dir), group_on_key=True)


@query
def availability_station_by_hour(spark, sf_dir):
    local = staging.stage_snapshots(fx.snapshots(spark, sf_dir), "America/New_York")
    hourly = availability.hourly_availability_from(local, staged_stations(spark, sf_dir))
    return availability.station_availability(hourly, by_hour=True)


# Gap -----------------------------------------------------------------------


@query
def mart_joined(spark, sf_dir):
    return scored(spark, sf_dir)


@query
def stations_unmatched(spark, sf_dir):
    return gap.unmatched_stations(hourly_demand(spark, sf_dir), station_supply(spark, sf_dir))


@query
def gap_rank_overall(spark, sf_dir):
    return ranking.global_row_number(
        mart_key(scored(spark, sf_dir)), gap.gap_order(), "overall_gap_rank"
    )


@query
def gap_rank_in_hour(spark, sf_dir):
    return ranking.rank_in(
        mart_key(scored(spark, sf_dir)), "hour_of_day", gap.gap_order(), "gap_rank_within_hour"
    )


@query
def gap_rank_in_station(spark, sf_dir):
    return ranking.rank_in(
        mart_key(scored(spark, sf_dir)),
        "station_id",
        gap.gap_order(),
        "worst_hour_rank_for_station",
    )


@query
def gap_peak_flag(spark, sf_dir):
    ranked = ranking.rank_in(
        mart_key(scored(spark, sf_dir)),
        "station_id",
        gap.gap_order(),
        "worst_hour_rank_for_station",
    )
    return gap.with_peak_flag(ranked)


@query
def gap_severities(spark, sf_dir):
    severity = gap_severity(F.col("supply_gap_score"), fx.BANDS)
    return mart_key(scored(spark, sf_dir)).withColumn("gap_severity", severity)


@query
def mart(spark, sf_dir):
    return build_mart(spark, sf_dir)


@query
def mart_by_hour(spark, sf_dir):
    return build_mart(spark, sf_dir, by_hour=True, tz="America/New_York")


@query
def mart_clamped(spark, sf_dir):
    return build_mart(spark, sf_dir, clamp=True, group_on_key=True)


@query
def worst_station_hours(spark, sf_dir):
    worst = plans.worst_station_hours(
        clean(spark, sf_dir), fx.snapshots(spark, sf_dir), fx.stations(spark, sf_dir), 10, fx.OPTIONS
    )
    return mart_key(worst, "total_departures", "avg_availability_ratio")


# Reports -------------------------------------------------------------------


def report(run: Callable[[DataFrame], DataFrame], name: str) -> None:
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(stored_mart(spark, sf_dir))

    read.__name__ = f"report_{name}"
    query(read)


report(reports.worst_stations, "worst_stations")
report(reports.by_hour, "by_hour")
report(reports.quality, "quality")
report(reports.hour_coverage, "hour_coverage")
report(reports.severity_counts, "severity_counts")
report(reports.coverage, "coverage")
report(reports.severity_pivot, "severity_pivot")
report(reports.crisis_moments, "crisis_moments")
report(reports.rider_split, "rider_split")
report(reports.peak_rows, "peak_top10")
report(lambda mart: reports.peak_rows(mart, n=5), "peak_top5")
report(reports.top_rows, "top_rows")


# Quality -------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    raw = fx.trips_raw(spark, sf_dir)
    return quality.not_null(raw, ["ride_id", "start_station_id", "end_station_id", "started_at"])


@query
def dq_unique(spark, sf_dir):
    return quality.unique(clean(spark, sf_dir), ["ride_id"])


@query
def dq_accepted_values(spark, sf_dir):
    accepted = {"member_casual": RIDER_KINDS, "rideable_type": ["classic_bike"]}
    return quality.column_checks(clean(spark, sf_dir), accepted=accepted)


@query
def dq_freshness(spark, sf_dir):
    return quality.freshness(fx.snapshots(spark, sf_dir), "snapshot_at", list(fx.FRESH_AS_OF.values()))


@query
def dq_sources(spark, sf_dir):
    """The checks declared on the sources, with one scan of each."""
    parts = {
        "trips": quality.column_checks(
            clean(spark, sf_dir), ["ride_id", "started_at_ts"], {"member_casual": RIDER_KINDS}
        ),
        "snapshots": quality.column_checks(
            fx.snapshots(spark, sf_dir), ["station_id", "snapshot_at"]
        ),
        "stations": quality.column_checks(
            fx.stations(spark, sf_dir), ["station_id", "name"], unique=["station_id"]
        ),
    }
    named = [df.withColumn("source", F.lit(name)) for name, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query
def dq_mart(spark, sf_dir):
    table = stored_mart(spark, sf_dir)
    checks = quality.column_checks(
        table,
        not_null=[
            "station_id",
            "station_name",
            "hour_of_day",
            "supply_gap_score",
            "overall_gap_rank",
        ],
        accepted={"hour_of_day": range(24), "gap_severity": SEVERITIES},
    )
    return checks.unionByName(quality.unique(table, ["overall_gap_rank"]))


# Streams -------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "landed")
    sinks.append_snapshots(fx.snapshots(spark, sf_dir), path)
    return path


def _in_two_runs(
    spark: SparkSession, loads: list[DataFrame], build: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What ``build`` appends when the loads arrive one by one and the stream runs after each."""
    src, out, state = (scratch_path(spark, label) for label in ("landed", "out", "state"))
    for load in loads:
        sinks.append_snapshots(load, src)
        stream = build(streams.stage_stream(spark, src))
        schema = stream.schema
        run = stream.writeStream.format("parquet").outputMode("append").option("path", out)
        run.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(out)


@query
def stream_ingested(spark, sf_dir):
    src, dst = _landed(spark, sf_dir), scratch_path(spark, "ingested")
    state = scratch_path(spark, "state")
    for _ in range(2):  # the second run finds nothing new
        streams.ingest_snapshots(spark, src, dst, state).awaitTermination()
    return spark.read.parquet(dst).select(*SNAPSHOT.fieldNames()).drop("last_reported")


@query
def stream_deduped(spark, sf_dir):
    """Readings that arrive twice at once, and again in the next load while they are recent."""
    readings = fx.snapshots(spark, sf_dir)
    first = readings.filter("snapshot_at < '2024-01-16'")
    second = readings.filter("snapshot_at >= '2024-01-15T23'")
    return _in_two_runs(
        spark,
        [first.unionByName(first), second],
        lambda staged: streams.dedupe_snapshots(staged, "2 hours"),
    ).select("station_id", "snapshot_at")


@query
def stream_windowed_availability(spark, sf_dir):
    """The windows that closed, in append mode."""
    readings = fx.snapshots(spark, sf_dir)
    known = staged_stations(spark, sf_dir)
    return _in_two_runs(
        spark,
        [readings.filter("snapshot_at < '2024-01-16'"), readings.filter("snapshot_at >= '2024-01-16'")],
        lambda staged: streams.windowed_availability(staged, known),
    )


@query
def stream_corrected_availability(spark, sf_dir):
    """All windows, after late readings and repeats of old ones came in later loads."""
    readings = fx.snapshots(spark, sf_dir)
    old, late = F.col("snapshot_at") < "2024-01-16", F.substring("snapshot_at", 19, 1).isin("3", "7")
    first = readings.filter(old & ~late)
    loads = [first, readings.filter(~old), readings.filter(old & late).unionByName(first)]
    src, store, windows, state = (scratch_path(spark, label) for label in ("landed", "store", "windows", "state"))
    for load in loads:
        sinks.append_snapshots(load, src)
        staged = streams.stage_stream(spark, src)
        known = lambda session: staging.stage_stations(fx.stations(session, sf_dir))
        corrections.keep_availability(staged, known, store, windows, state)
    return corrections.read_windows(spark, windows)
