"""Loads that go on from earlier ones: archives, monthly demand states, layered views."""

import os
import zipfile

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from catalogue import queries as q
from stationflow import fixtures as fx
from stationflow.operators import demand, demand_states as states, staging
from stationflow.plans import layers
from stationflow.schemas import TRIP_RAW
from stationflow.sources import sinks, trips as trip_sources
from stationflow.streaming import archives as loads

HEADER = ",".join(TRIP_RAW.fieldNames())


def pack(path, *rides, spoil=False, member="t.csv"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(member, HEADER + "".join(f"\n{r}" + "," * (len(TRIP_RAW) - 1) for r in rides) + "\n")
        info = archive.infolist()[0]
    if spoil:
        with open(path, "r+b") as file:
            file.seek(info.header_offset + info.compress_size // 2)
            file.write(bytes(40))


@pytest.fixture
def place(tmp_path):
    return {name: str(tmp_path / name) for name in ("in", "out", "ledger", "state")}


def load(spark, place, **options):
    return loads.load_new_archives(spark, place["in"], place["out"], place["ledger"], place["state"], **options)


def rides(spark, place):
    return sorted(r["ride_id"] for r in loads.read_loaded(spark, place["out"]).collect())


def test_second_run_reads_only_new_archives(spark, place):
    pack(f"{place['in']}/a.zip", "a1", "a2")
    load(spark, place)
    os.chmod(f"{place['in']}/a.zip", 0)  # whoever opened it again would fail, but for root
    opened = f"{place['state']}-opened"

    def watched(path):
        with open(opened, "a") as log:
            log.write(path + "\n")
        return open(path.removeprefix("file:"), "rb")

    pack(f"{place['in']}/sub/a.zip", "b1")
    load(spark, place, opener=watched)
    assert rides(spark, place) == ["a1", "a2", "b1"]
    assert {p.strip().split("/in/")[1] for p in open(opened)} == {"sub/a.zip"}
    load(spark, place)
    assert rides(spark, place) == ["a1", "a2", "b1"]
    assert [r["load"] for r in loads.read_ledger(spark, place["ledger"]).orderBy("load").collect()] == [0, 1]


def test_damaged_archives_are_tallied(spark, place):
    pack(f"{place['in']}/good.zip", "g1")
    pack(f"{place['in']}/spoilt.zip", *[f"s{i}" for i in range(500)], spoil=True)
    pack(f"{place['in']}/none.zip", member="read.me")
    os.makedirs(place["in"], exist_ok=True)
    with open(f"{place['in']}/text.zip", "w") as file:
        file.write("no archive")
    load(spark, place)
    ledger = {r["path"].rsplit("/", 1)[1]: r for r in loads.read_ledger(spark, place["ledger"]).collect()}
    assert rides(spark, place) == ["g1"]
    assert (ledger["good.zip"]["rows"], ledger["good.zip"]["error"], ledger["good.zip"]["members"]) == (1, None, 1)
    assert ledger["spoilt.zip"]["rows"] == 0 and ledger["spoilt.zip"]["failed_members"] == 1
    assert "BadZipFile" in ledger["text.zip"]["error"]
    assert (ledger["none.zip"]["rows"], ledger["none.zip"]["members"], ledger["none.zip"]["error"]) == (0, 0, None)


def test_interrupted_run_repeats_no_row(spark, place, monkeypatch):
    """The run ends between rows and ledger; the next one does that load again."""
    pack(f"{place['in']}/a.zip", "a1", "a2")
    pack(f"{place['in']}/b.zip", "b1")
    real = loads._ledger_rows

    def broken(*args):
        raise OSError("no ledger today")

    monkeypatch.setattr(loads, "_ledger_rows", broken)
    with pytest.raises(Exception, match="no ledger today"):
        load(spark, place)
    assert rides(spark, place) == ["a1", "a2", "b1"] and not os.path.exists(place["ledger"])
    monkeypatch.setattr(loads, "_ledger_rows", real)
    pack(f"{place['in']}/c.zip", "c1")
    load(spark, place, max_archives=1)
    assert rides(spark, place) == ["a1", "a2", "b1", "c1"]
    ledger = loads.read_ledger(spark, place["ledger"])
    assert sorted(r["path"][-5:] for r in ledger.collect()) == ["a.zip", "b.zip", "c.zip"]


# monthly states


@pytest.fixture(scope="module")
def clean(spark, sf):
    return q.clean(spark, sf).cache()


def test_states_merge_to_the_whole(spark, clean, tmp_path):
    staged = staging.stage_trips(clean)
    for bucket in ("start", "end"):
        path = f"{tmp_path}/{bucket}"
        states.refresh_states(staged, path, bucket=bucket)
        assert rows(states.merge_states(states.read_states(spark, path))) == rows(demand.hourly_demand(staged, bucket))


def test_only_touched_months_are_read_and_replaced(spark, clean, tmp_path):
    trips_path, path = f"{tmp_path}/trips", f"{tmp_path}/states"
    sinks.write_trips(clean, trips_path, compact=True)
    stored = staging.stage_trips(trip_sources.read_trips(spark, trips_path))
    states.refresh_states(stored, path)
    months = states.touched_months(clean)
    (year, month), gone = months[3], months[5]
    plan = plan_of(states.month_states(states.of_months(stored, [(year, month)])))
    assert "PartitionFilters" in plan and f"= {month}" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    before = {str(p): p.stat().st_mtime_ns for p in tmp_path.glob("states/year=*/month=*/*.parquet")}
    late = clean.filter((F.col("year") == year) & (F.col("month") == month) & (F.col("member_casual") == "member"))
    sinks.write_trips(late, trips_path, compact=True)
    for file in tmp_path.glob(f"trips/year={gone[0]}/month={gone[1]}/*.parquet"):
        os.remove(file)
    stored = staging.stage_trips(trip_sources.read_trips(spark, trips_path))
    states.refresh_states(stored, path, [(year, month), gone])
    states.refresh_states(stored, path, [(year, month), gone])
    after = {str(p): p.stat().st_mtime_ns for p in tmp_path.glob("states/year=*/month=*/*.parquet")}
    changed = {p.split("/states/")[1].rsplit("/", 1)[0] for p, _ in set(before.items()) ^ set(after.items())}
    assert changed == {f"year={year}/month={month}", f"year={gone[0]}/month={gone[1]}"}
    assert rows(states.merge_states(states.read_states(spark, path))) == rows(demand.hourly_demand(stored))
    states.refresh_states(stored, path, [])


def test_incremental_query_parses_once_and_stores_its_columns(spark, sf, monkeypatch):
    raw, kept = [], []

    def watched(step):
        def run(df, *args, **options):
            raw.append("l_orderkey" in plan_of(df))
            kept.append(df.columns)
            return step(df, *args, **options)

        return run

    for place, name in ((sinks, "write_trips"), (q, "materialise"), (states, "touched_months")):
        monkeypatch.setattr(place, name, watched(getattr(place, name)))
    result = q.QUERIES["demand_incremental"](spark, sf)
    assert raw[0] and not any(raw[1:])
    assert {tuple(columns) for columns in kept} == {tuple(states.trip_columns())}
    assert rows(result) == rows(q.hourly_demand(spark, sf))


def test_states_move_rows_once_and_count_after(spark, clean, tmp_path):
    """A task that counts before rows are moved holds as many cells as its files have trips."""
    trips_path, path = f"{tmp_path}/trips", f"{tmp_path}/states"
    staged = staging.stage_trips(clean).select(*states.trip_columns())
    sinks.write_trips(staged, trips_path, compact=True)
    stored = trip_sources.read_trips(spark, trips_path, staged.schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(states.month_states(stored))
        assert plan.count("Exchange rangepartitioning") == 1
        # The arrivals: counted, then laid by month.
        assert plan.count("Exchange hashpartitioning") == 2
        states.refresh_states(stored, path)
        merged = states.merge_states(states.read_states(spark, path))
        assert plan_of(merged).count("Exchange hashpartitioning") == 2
        assert rows(merged) == rows(demand.hourly_demand(stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    months = len(states.touched_months(stored))
    # Ranges lie by month: a task shares at most its first and last month with another.
    files = len(list(tmp_path.glob("states/year=*/month=*/*.parquet")))
    assert files <= 2 * months + 8
    for bucket in ("start", "end"):
        narrow = staging.stage_trips(clean).select(*states.trip_columns(bucket))
        assert rows(states.merge_states(states.month_states(narrow, bucket))) == rows(
            demand.hourly_demand(staging.stage_trips(clean), bucket)
        )


# layers


def test_staging_views_are_the_operators(spark, sf, clean, tmp_path):
    for layer in ("raw_t", "staging_t"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{tmp_path}/{layer}'")
    try:
        tables = {"trips": clean, "snapshots": fx.snapshots(spark, sf), "stations": fx.stations(spark, sf)}
        for name, df in tables.items():
            sinks.publish(df, f"raw_t.{name}", as_="table")
        names = layers.publish_staging(spark, "raw_t", "staging_t")
        layers.publish_staging(spark, "raw_t", "staging_t")
        other = spark.newSession()
        operators = (staging.stage_trips, staging.stage_snapshots, staging.stage_stations)
        for name, (table, df), stage in zip(names, tables.items(), operators):
            expected = stage(df)
            assert other.table(name).columns == expected.columns, table
            assert rows(other.table(name)) == rows(expected), table
        assert [r["table_type"] for r in sinks.list_layer(other, "staging_t").collect()] == ["VIEW"] * 3
        with pytest.raises(ValueError, match="publish_view"):
            sinks.publish(clean, "staging_t.other")
    finally:
        spark.sql("DROP DATABASE staging_t CASCADE")
        spark.sql("DROP DATABASE raw_t CASCADE")


def test_external_table_stays_until_its_successor_stands(spark, clean, tmp_path):
    sinks.write_trips(clean, f"{tmp_path}/a", compact=True)
    first = sinks.register_external(spark, "ext_swap", "parquet", f"{tmp_path}/a", clean.schema, ["year", "month"])
    n = first.count()
    with pytest.raises(Exception):
        sinks.register_external(spark, "ext_swap", "no_such_format", f"{tmp_path}/a")
    assert spark.table("ext_swap").count() == n
    sinks.write_trips(clean.filter("month = 1"), f"{tmp_path}/b", compact=True)
    assert sinks.register_external(spark, "ext_swap", "parquet", f"{tmp_path}/b", clean.schema, ["year", "month"]).count() < n
    assert not [t.name for t in spark.catalog.listTables() if "ext_swap_" in t.name]
    spark.sql("DROP TABLE ext_swap")
