"""Headline timings; prints one JSON line.

Inputs are derived from the test tables and landed first, as many files, the
way a pipeline finds them; landing is not timed. Every query runs three times and
the fastest run counts, so most of the JVM's warm-up does not. BENCH_COPIES replicates the
input, each copy with stations of its own.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Window, functions as F  # noqa: E402

from stationflow import build_session, fixtures as fx  # noqa: E402
from stationflow.functions.times import TRIP_FORMATS  # noqa: E402
from stationflow.operators import demand, gap, quality, ranking, reports, staging, trips  # noqa: E402
from stationflow.operators.availability import hourly_availability_from  # noqa: E402
from stationflow.plans import mart as plans  # noqa: E402
from stationflow.schemas import RIDER_KINDS  # noqa: E402
from stationflow.session import materialise, scratch_path  # noqa: E402
from stationflow.sources import sinks, snapshots as snap, trips as trip_sources  # noqa: E402
from stationflow.streaming import snapshots as streams  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))


def copies(df, *names):
    """``df`` once per copy; the named columns differ between copies."""
    if COPIES == 1:
        return df
    every = F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("_copy")
    out = df.select("*", every)
    for name in names:
        out = out.withColumn(name, F.concat_ws("/", name, F.col("_copy").cast("string")))
    return out.drop("_copy")


def done(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=str(max(CPUS, min(200, CPUS * COPIES))),
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="stationflow-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    csv = scratch_path(spark, "csv")
    ids = ("ride_id", "start_station_id", "start_station_name", "end_station_id")
    raw = fx.trips_raw(spark, SF_DIR)
    if COPIES > 1:
        raw = copies(raw.withColumn("start_station_name", F.trim("start_station_name")), *ids)
    raw.repartition(CPUS * COPIES).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(csv)
    landed = scratch_path(spark, "snapshots")
    sinks.append_snapshots(copies(fx.snapshots(spark, SF_DIR), "station_id"), landed)
    stations = materialise(copies(fx.stations(spark, SF_DIR), "station_id", "name"), "stations")
    clean_path = scratch_path(spark, "trips")

    def clean_to(path):
        # Every test file spans 84 months, so months are gathered before writing.
        rows = trips.enrich_trips(trip_sources.read_trips_csv(spark, csv))
        sinks.write_trips(rows, path, compact=True)

    clean_to(clean_path)

    clean = trip_sources.read_trips(spark, clean_path)
    readings = materialise(snap.read_snapshots(spark, landed), "readings")
    staged = staging.stage_trips(clean)
    mart = materialise(plans.build_mart(clean, readings, stations, fx.OPTIONS), "mart")
    scored = mart.select(*gap.MART_TIES, "supply_gap_score")

    def clean_plain(path):
        """The same cleaning written plainly: patterns as columns, a count per stage."""
        rows = trip_sources.read_trips_csv(spark, csv)
        rows.count()
        for name in ("started_at", "ended_at"):
            tries = [F.try_to_timestamp(name, F.lit(f)) for f in TRIP_FORMATS]
            rows = rows.withColumn(f"{name}_ts", F.coalesce(*tries))
        kept = trips.clean_trips(rows)
        kept.count()
        full = kept.transform(trips.with_duration).transform(trips.with_calendar)
        full = full.withColumn("start_day_name", F.date_format("started_at_ts", "EEEE"))
        sinks.write_trips(full.transform(trips.select_trip_columns), path, compact=True)

    def mart_plain():
        """The same mart written plainly: two passes over trips, windows as they stand."""
        supply = plans.supply(readings, stations, fx.OPTIONS)
        wanted = demand.net_demand(demand.departures(staged), demand.arrivals(staged))
        ties = gap.gap_order()
        number = F.row_number()
        ranked = gap.score_gaps(wanted, supply).withColumns(
            {
                "overall_gap_rank": number.over(Window.orderBy(*ties)),
                "gap_rank_within_hour": number.over(
                    Window.partitionBy("hour_of_day").orderBy(*ties)
                ),
                "worst_hour_rank_for_station": number.over(
                    Window.partitionBy("station_id").orderBy(*ties)
                ),
            }
        )
        done(ranked.transform(gap.with_peak_flag).orderBy(F.col("supply_gap_score").desc()))

    def report_all():
        for report in (
            reports.worst_stations,
            reports.by_hour,
            reports.quality,
            reports.hour_coverage,
            reports.severity_counts,
            reports.coverage,
            reports.severity_pivot,
            reports.crisis_moments,
            reports.rider_split,
            reports.peak_rows,
            reports.top_rows,
        ):
            report(mart).collect()

    def dq():
        done(
            quality.column_checks(
                clean,
                ["ride_id", "start_station_id", "started_at_ts"],
                {"member_casual": RIDER_KINDS},
            )
        )
        done(quality.unique(clean, ["ride_id"]))

    def stream():
        streams.ingest_snapshots(
            spark, landed, scratch_path(spark, "ingested"), scratch_path(spark, "state")
        ).awaitTermination()

    queries = {
        "clean_csv_to_parquet": lambda: clean_to(scratch_path(spark, "trips")),
        "demand_net": lambda: done(demand.hourly_demand(staged)),
        "demand_net_one_pass": lambda: done(demand.hourly_demand_one_pass(staged)),
        "availability_hourly": lambda: done(
            hourly_availability_from(
                staging.stage_snapshots(readings), staging.stage_stations(stations)
            )
        ),
        "worst_station_hours": lambda: plans.worst_station_hours(
            clean, readings, stations, 10, fx.OPTIONS
        ).collect(),
        "mart": lambda: done(plans.build_mart(clean, readings, stations, fx.OPTIONS)),
        "gap_rank_overall": lambda: done(
            ranking.global_row_number(scored, gap.gap_order(), "overall_gap_rank")
        ),
        "gap_rank_in_hour": lambda: done(ranking.rank_in(scored, "hour_of_day", gap.gap_order())),
        "reports": report_all,
        "data_quality": dq,
        "stream_ingest": stream,
    }
    # Measured on request only: what the plain formulations cost.
    plain = {
        "plain_clean_csv_to_parquet": lambda: clean_plain(scratch_path(spark, "trips")),
        "plain_mart": mart_plain,
    }
    only = sys.argv[1:]
    seconds = {}
    for name, run in {**queries, **plain}.items():
        if name not in (only or queries):
            continue
        times = []
        for _ in range(ROUNDS):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "copies": COPIES,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
