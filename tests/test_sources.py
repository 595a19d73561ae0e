import gzip
import io
import random
import re
import subprocess
import sys
import zipfile
from datetime import date, datetime
from types import SimpleNamespace

import pyarrow as pa
import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F, types as T

from stationflow.operators import trips as trip_ops
from stationflow.plans import mart as plans
from stationflow.schemas import SNAPSHOT_DOC, STATION_DOC, TRIP_CLEAN, TRIP_RAW
from stationflow.sources import archives, audit, layouts, listing, sinks, snapshots as snap, trips

HEADER = ",".join(TRIP_RAW.fieldNames())
GOOD = "r1,classic_bike,2024-01-01 10:00:00,2024-01-01 10:10:00,A,1.01,B,2.01,1.5,2.5,3.5,4.5,member"
QUOTED = 'r2,electric_bike,2024-02-01 10:00:00,2024-02-01 10:10:00,"W 4 St, E",1.01,B,2.01,1,2,3,4,casual'
BAD_NUMBER = "r3,classic_bike,2024-01-01 10:00:00,2024-01-01 10:10:00,A,1.01,B,2.01,north,2.5,3.5,4.5,member"
SHORT = "r4,classic_bike,2024-01-01 10:00:00"
LONG = GOOD.replace("r1", "r5") + ",extra"


@pytest.fixture
def csv_dir(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    lines = [HEADER, GOOD, QUOTED, BAD_NUMBER, SHORT, LONG]
    (folder / "202401.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_csv_nulls_bad_values(spark, csv_dir):
    found = {r.ride_id: r for r in trips.read_trips_csv(spark, csv_dir).collect()}
    assert set(found) == {"r1", "r2", "r3", "r4", "r5"}
    assert found["r2"].start_station_name == "W 4 St, E"
    assert (found["r3"].start_lat, found["r3"].start_lng) == (None, 2.5)
    assert found["r4"].ended_at is None


def test_corrupt_rows_are_kept_apart(spark, csv_dir):
    df = trips.read_trips_csv(spark, csv_dir, corrupt_col="_corrupt_record")
    good, bad = trips.split_corrupt(df)
    # The split does not depend on the columns that are used afterwards.
    assert rows(good.select("ride_id")) == [("r1",), ("r2",)]
    assert rows(bad.select("ride_id")) == [("r3",), ("r4",), ("r5",)]
    assert good.columns == TRIP_RAW.fieldNames()
    lines = [r[0] for r in rows(bad.select("_corrupt_record"))]
    assert lines == [BAD_NUMBER, SHORT, LONG]
    assert good.schema["start_lat"].dataType == T.DoubleType()


def test_infer(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2.5\n")
    assert trips.read_trips_csv(spark, str(tmp_path), infer=True).dtypes == [("x", "int"), ("y", "double")]


OLD = T.StructType([T.StructField(n, T.StringType()) for n in ("starttime", "stoptime", "bikeid")])
OLD_NAMES = {"starttime": "started_at", "stoptime": "ended_at", "bikeid": "ride_id"}


def test_two_layouts(spark, csv_dir, tmp_path):
    (tmp_path / "csv" / "201301_old.csv").write_text(
        "starttime,stoptime,bikeid\n2013-01-01 00:00:00,2013-01-01 00:05:00,77\n"
    )
    df = trips.read_trips_csv(
        spark,
        csv_dir,
        layouts=[trips.TripLayout(TRIP_RAW, files="2024*"), trips.TripLayout(OLD, OLD_NAMES, files="2013*")],
    )
    assert df.columns == TRIP_RAW.fieldNames() and df.count() == 6
    old = df.filter("ride_id = '77'").first()
    assert (old.started_at, old.member_casual) == ("2013-01-01 00:00:00", None)


KNOWN = [trips.TripLayout(TRIP_RAW), trips.TripLayout(OLD, OLD_NAMES)]


def test_layouts_by_header(spark, tmp_path):
    """One folder, no globs: two layouts, another order, more columns, gzip, odd names, unknown and empty files."""
    old = "2013-01-01 00:00:00,2013-01-01 00:05:00"
    texts = {
        "a [1]{x}*.csv": f"{HEADER}\n{GOOD}\n{QUOTED}\n",
        "b.csv": f"\ufeffstarttime,stoptime,bikeid\n{old},77\n",
        "deep/er/c.csv": f"\n bikeid ,usertype,starttime,stoptime\n78,x,{old}\n79,y,{old}\n",
        "unknown.csv": f"start,stop,bikeid\n{old},80\n",
        "twice.csv": f"starttime,stoptime,bikeid,BIKEID\n{old},81,81\n",
        "blank.csv": f"starttime,stoptime,bikeid,\n{old},82,\n",
        "header_only.csv": "starttime,stoptime,bikeid\n",
        "empty.csv": "\n",
        "no_bytes.csv": "",
        "not_csv.txt": f"{HEADER}\n{GOOD}\n",
    }
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    with gzip.open(tmp_path / "z.csv.gz", "wt") as file:
        file.write(f"{HEADER}\n{GOOD.replace('r1', 'r9')}\n")
    df, files = layouts.read_trips_by_header(spark, str(tmp_path), KNOWN)
    assert df.columns == TRIP_RAW.fieldNames()
    assert [r.ride_id for r in df.orderBy("ride_id").collect()] == ["77", "78", "79", "r1", "r2", "r9"]
    assert rows(df.filter("ride_id = '79'").select("started_at", "ended_at", "member_casual")) == [
        ("2013-01-01 00:00:00", "2013-01-01 00:05:00", None)
    ]
    assert df.filter("ride_id = 'r1'").first().start_lat == 1.5
    found = {r.path.rsplit("/", 1)[1]: (r.layout, r.left_out) for r in files.collect()}
    assert found == {
        "a [1]{x}*.csv": (0, []), "z.csv.gz": (0, []), "b.csv": (1, []), "header_only.csv": (1, []), "c.csv": (1, ["usertype"]),
        "unknown.csv": (None, None), "twice.csv": (None, None), "blank.csv": (None, None), "empty.csv": (None, None),
    }


def test_layouts_by_header_keep_corrupt_lines(spark, csv_dir, tmp_path):
    both = layouts.read_trips_by_header(spark, csv_dir, KNOWN, corrupt_col="_corrupt_record")[0]
    plain = trips.read_trips_csv(spark, csv_dir, corrupt_col="_corrupt_record")
    assert both.columns == plain.columns and rows(both) == rows(plain)
    (tmp_path / "none").mkdir()
    empty, files = layouts.read_trips_by_header(spark, str(tmp_path / "none"), KNOWN)
    assert empty.count() == files.count() == 0 and empty.columns == TRIP_RAW.fieldNames()


def test_a_header_that_changes_fails_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("starttime,stoptime,bikeid\na,b,c\n")
    df, _ = layouts.read_trips_by_header(spark, str(tmp_path), KNOWN)
    (tmp_path / "a.csv").write_text("stoptime,starttime,bikeid\na,b,c\n")
    with pytest.raises(Exception, match="header"):
        df.collect()


def test_wrong_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("stoptime,starttime,bikeid\na,b,c\n")
    with pytest.raises(Exception, match="header"):
        trips.read_trips_csv(spark, str(tmp_path), layouts=[trips.TripLayout(OLD, OLD_NAMES)]).collect()


@pytest.fixture
def zip_dir(tmp_path):
    def archive(name, **members):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_DEFLATED) as out:
            for member, text in members.items():
                out.writestr(member.replace("__MACOSX_", "__MACOSX/").replace("_csv", ".csv"), text)

    names = TRIP_RAW.fieldNames()
    values = GOOD.replace("r1", "r6").split(",")
    backwards = ",".join(reversed(names)) + "\n" + ",".join(reversed(values)) + "\n"
    archive("202401-tripdata.csv.zip", one_csv=f"{HEADER}\n{GOOD}\n{QUOTED}\n", two_csv=backwards,
            __MACOSX_one_csv="junk", readme="not a table")
    archive("202402-tripdata.zip", three_csv=f"{HEADER}\n{BAD_NUMBER}\n{SHORT}\n{LONG}\n",
            old_csv="starttime,stoptime,bikeid\n2013-01-01 00:00:00,2013-01-01 00:05:00,77\n", empty_csv="")
    (tmp_path / "202403-tripdata.zip").write_bytes(b"not a zip file")
    return str(tmp_path)


def test_archives(spark, zip_dir):
    df = archives.unpack_trip_archives(spark, zip_dir, renames=OLD_NAMES, parallelism=4)
    good = df.filter("_corrupt_record is null and _error is null")
    found = {r.ride_id: r for r in good.collect()}
    assert set(found) == {"r1", "r2", "r6", "77"}
    assert found["r2"].start_station_name == "W 4 St, E"
    assert (found["r6"].start_lat, found["r6"].member_casual) == (1.5, "member")
    assert found["77"].ended_at == "2013-01-01 00:05:00" and found["77"].start_lat is None
    corrupt = [r[0] for r in rows(df.filter("_corrupt_record is not null").select("_corrupt_record"))]
    assert corrupt == [BAD_NUMBER, SHORT, LONG]
    failed = df.filter("_error is not null").collect()
    assert [r["_archive"].rsplit("/", 1)[1] for r in failed] == ["202403-tripdata.zip"]
    assert df.schema["end_lng"].dataType == T.DoubleType()


def test_archive_report(spark, zip_dir):
    results = archives.archive_results(archives.unpack_trip_archives(spark, zip_dir, renames=OLD_NAMES))
    counts = {r.member: (r.rows, r.corrupt_rows) for r in results.filter("error is null").collect()}
    assert counts == {"one.csv": (2, 0), "two.csv": (1, 0), "three.csv": (3, 3), "old.csv": (1, 0)}
    assert rows(archives.ingest_report(results)) == [("error", 1), ("success", 4)]


def test_large_member_is_streamed_whole(spark, tmp_path):
    """More than one block of text, every row kept."""
    text = io.StringIO()
    text.write(HEADER + "\n")
    for i in range(150_000):
        text.write(GOOD.replace("r1", f"ride-{i}") + "\n")
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("big.csv", text.getvalue())
    df = archives.unpack_trip_archives(spark, str(tmp_path))
    corrupt = F.count("_corrupt_record")
    assert df.select(F.count(F.lit(1)), F.count_distinct("ride_id"), corrupt).first() == (150_000, 150_000, 0)


def one_member(path, name, text):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr(name, text)


def test_quoted_line_breaks_anywhere(spark, tmp_path):
    """Cells with line breaks all through a member, and one longer than any buffer."""
    cell = '"W 4 St\n""E"",\r\n\nN"'
    lines = [GOOD.replace("r1", f"r-{i}").replace(",A,", f",{cell},") for i in range(60_000)]
    long_line = GOOD.replace("r1", "long").replace(",A,", ',"' + "x\n" * 5_000_000 + '",')
    one_member(tmp_path / "a.zip", "a.csv", "\n".join([HEADER, *lines[:30_000], long_line, *lines[30_000:]]))
    df = archives.unpack_trip_archives(spark, str(tmp_path))
    named = F.count_if(F.col("start_station_name") == 'W 4 St\n"E",\r\n\nN')
    longest, corrupt = F.max(F.length("start_station_name")), F.count("_corrupt_record")
    assert df.select(F.count_distinct("ride_id"), named, longest, corrupt).first() == (60_001, 60_000, 10_000_000, 0)


@pytest.mark.parametrize("damage", ["cut", "changed"])
def test_a_damaged_member_gives_no_rows(spark, tmp_path, damage):
    rng = random.Random(1)
    body = "\n".join([HEADER, *(GOOD.replace("r1", str(rng.random())) for _ in range(50_000))])
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("bad.csv", body)
        out.writestr("good.csv", f"{HEADER}\n{GOOD}\n")
        size = out.getinfo("bad.csv").compress_size
    raw = bytearray(path.read_bytes())
    raw[size // 2 : size // 2 + (1 if damage == "changed" else 2000)] = b"\xff" * (1 if damage == "changed" else 2000)
    path.write_bytes(bytes(raw))
    df = archives.unpack_trip_archives(spark, str(tmp_path))
    assert rows(df.filter("_error is null").select("_member", "ride_id")) == [("good.csv", "r1")]
    assert [r["_member"] for r in df.filter("_error is not null").collect()] == ["bad.csv"]
    results = archives.archive_results(df)
    assert rows(archives.ingest_report(results)) == [("error", 1), ("success", 1)]


def test_paths_of_archives(monkeypatch):
    asked = []

    class System:
        def open_input_file(self, name):
            return name

    def from_uri(uri):
        asked.append(uri)
        return System(), uri.split("://")[1]

    monkeypatch.setattr(archives, "fs", SimpleNamespace(FileSystem=SimpleNamespace(from_uri=from_uri)))
    assert archives.open_path("s3a://bucket/a.zip") == "bucket/a.zip" and archives.open_path("hdfs://n/b") == "n/b"
    assert asked == ["s3://bucket/a.zip", "hdfs://n/b"]
    monkeypatch.undo()
    with pytest.raises(Exception, match="nosuch"):
        archives.open_path("nosuch://x/a.zip")
    with pytest.raises(OSError):
        archives.open_path("/no/such/file.zip")


def test_failed_reads_fail_the_task(spark, zip_dir):
    """They are no damage: Spark tries the task again."""

    def opener(path):
        raise OSError("storage is away")

    with pytest.raises(Exception, match="storage is away"):
        archives.unpack_trip_archives(spark, zip_dir, opener=opener).collect()


def test_readers_travel_with_their_code():
    from pyspark import cloudpickle

    code = "import pickle,sys; f = pickle.loads(sys.stdin.buffer.read()); print(f.__name__)"
    found = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(archives.open_path), cwd="/", capture_output=True)
    assert found.stdout.decode().strip() == "open_path", found.stderr.decode()


def test_corrupt_lines_are_the_files_text(spark, csv_dir):
    df = trips.read_trips_csv(spark, csv_dir, corrupt_col="_corrupt_record")
    kept = df.filter("_corrupt_record is not null").select("_corrupt_record")
    assert sorted(r[0] for r in kept.collect()) == sorted([BAD_NUMBER, SHORT, LONG])


def test_partitioned_trips(spark, csv_dir, tmp_path):
    target = str(tmp_path / "trips")
    loaded, counts = plans.load_trips(spark, csv_dir, target)
    assert (counts["raw"].get["rows"], counts["clean"].get["rows"]) == (5, 4)
    assert loaded.schema.fieldNames() == TRIP_CLEAN.fieldNames()
    february = loaded.filter("year = 2024 and month = 2")
    assert "PartitionFilters: [isnotnull(year" in plan_of(february)
    assert [r.ride_id for r in february.collect()] == ["r2"]
    # A later run with one month replaces that month only.
    again = trip_ops.enrich_trips(trips.read_trips_csv(spark, csv_dir).filter("ride_id = 'r1'"))
    sinks.write_trips(again, target)
    assert rows(trips.read_trips(spark, target).select("ride_id")) == [("r1",), ("r2",)]
    sinks.write_trips(again, target, dynamic=False, compact=True)
    assert rows(trips.read_trips(spark, target).select("ride_id")) == [("r1",)]


def document(spark, schema, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.from_json("t", schema).alias("d")
    ).select("d.*")


def test_snapshot_documents(spark):
    docs = document(
        spark, SNAPSHOT_DOC,
        '{"data":{"stations":[{"station_id":"a","num_bikes_available":3},{"station_id":"b"}]},"ttl":5}',
        '{"ttl":5}', '{"data":{"stations":[]}}',
    )
    flat = snap.flatten_snapshot(docs, datetime(2026, 6, 15, 14, 30))
    assert [(r.station_id, r.num_bikes_available) for r in flat.orderBy("station_id").collect()] == [("a", 3), ("b", None)]
    first = flat.first()
    assert first.snapshot_at == "2026-06-15T14:30:00.000000+00:00"
    assert first.snapshot_epoch == 1781533800
    assert set(SNAPSHOT_DOC["data"].dataType["stations"].dataType.elementType.fieldNames()) < set(flat.columns)


def test_variant_documents(spark, tmp_path):
    """Every field of every document, whatever its type, in one scan without a job before it."""
    for name, text in {
        "a": '{"data":{"stations":[\n{"station_id":"a","num_bikes_available":3,"new":{"x":[1]}},{"station_id":7,"new":"s"}]}}',
        "b": '{"data":{"stations":[{"station_id":"b","num_bikes_available":"many","it\'s":1.5}, null, 5]}}',
        "c": '{"data":{"stations":null}}', "d": '{"ttl":5}', "e": '{"data":{"stations":{"station_id":"no"}}}',
        "f": '{"data":{"stations":[]}}', "g": '{"data":{"stations":[{"station_id":"cut',
    }.items():
        (tmp_path / f"{name}.json").write_text(text)
    spark.sparkContext.setJobGroup("variants", "none runs before the action")
    docs = snap.read_variant_documents(spark, str(tmp_path), corrupt_col="_bad")
    flat = snap.flatten_variant_snapshot(docs, datetime(2026, 6, 15, 14, 30))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("variants")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert flat.columns == [*snap.flatten_snapshot(document(spark, SNAPSHOT_DOC, "{}"), "2026-06-15").columns, "fields"]
    assert rows(flat.select("station_id", "num_bikes_available")) == sorted(
        [("a", 3), ("7", None), ("b", None), (None, None), (None, None)], key=repr
    )
    assert {r.snapshot_epoch for r in flat.collect()} == {1781533800}
    new = flat.select("station_id", F.to_json("fields").alias("all"), snap.variant_field("new").alias("new"))
    assert {r.station_id: r.new for r in new.filter("station_id is not null").collect()} == {"a": '{"x":[1]}', "7": "s", "b": None}
    assert new.filter("station_id = 'b'").first()["all"] == '{"it\'s":1.5,"num_bikes_available":"many","station_id":"b"}'
    kinds = {(r.field, r.kind): r.readings for r in snap.field_kinds(flat).collect()}
    assert kinds[("new", "STRING")] == 1 and kinds[("new", "OBJECT<x: ARRAY<BIGINT>>")] == 1
    assert kinds[("station_id", "STRING")] == 2 and kinds[("station_id", "BIGINT")] == 1
    assert plan_of(flat).split("== Physical Plan ==")[1].count("FileScan json") == 1
    assert [r["_bad"] for r in docs.filter("_bad is not null").collect()] == ['{"data":{"stations":[{"station_id":"cut']
    with pytest.raises(ValueError):
        snap.variant_field("it's")
    kept = str(tmp_path / "kept")
    sinks.append_snapshots(flat, kept, "parquet")
    again = spark.read.parquet(kept)
    assert rows(again.select(snap.variant_field("new"))) == rows(flat.select(snap.variant_field("new")))


def test_station_documents(spark, tmp_path):
    (tmp_path / "info.json").write_text(
        '{"data":{"stations":[\n{"station_id":"a","name":"A","lat":40.5,"lon":"-74","capacity":12},\n{"region_id":7}]}}'
    )
    docs = snap.read_station_documents(spark, str(tmp_path))
    flat = snap.flatten_station_info(docs, "2024-01-01 00:00:00").orderBy("station_id").collect()
    assert tuple(flat[0])[:7] == ("", "", "", 0.0, 0.0, 0, "7")
    assert tuple(flat[1])[:7] == ("a", "A", "", 40.5, -74.0, 12, "")
    assert docs.schema == STATION_DOC


def test_snapshot_rows_by_day(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "2024-01-01T10:00:00+00:00"), ("b", "2024-01-02T10:00:00+00:00")], "station_id string, snapshot_at string"
    )
    path = str(tmp_path / "s")
    sinks.append_snapshots(df, path)
    sinks.append_snapshots(df, path)
    assert snap.read_snapshots(spark, path).count() == 4
    assert {r.station_id for r in snap.read_snapshots(spark, path, day="2024-01-02").collect()} == {"b"}
    ranged = snap.read_snapshots(spark, path, since="2024-01-02", until=date(2024, 1, 5))
    assert [r.station_id for r in ranged.collect()] == ["b", "b"] and "snapshot_date" not in ranged.columns
    assert re.search(r"PartitionFilters: \[[^]]*snapshot_date", plan_of(ranged))
    assert snap.read_snapshots(spark, path, since="2024-02-01").count() == 0
    assert snap.read_snapshots(spark, path, until="2024-01-01").count() == 2
    (tmp_path / "feed/2024/01/03").mkdir(parents=True)
    (tmp_path / "feed/2024/01/03/x.json").write_text('{"station_id":"c"}\n')
    by_folder = snap.read_snapshots(spark, str(tmp_path / "feed"), schema=None, day="2024/01/03")
    assert by_folder.columns == ["station_id"] and by_folder.count() == 1


KEYS = [
    "202401-x-tripdata.csv.zip", "202402-x_tripdata.zip", "JC-202401-x-tripdata.csv.zip",
    "JC-202401-x_tripdata.zip", "index.html", "202403-x-tripdata.html", "2013-x-tripdata.zip", "202313-x-tripdata.zip",
]


def test_file_selection(spark):
    keys = listing.read_keys(spark, [(k, 1) for k in KEYS])
    picked = lambda df: {r.key for r in df.collect()}
    assert picked(listing.select_trip_files(keys)) == {KEYS[0], KEYS[1], KEYS[6], KEYS[7]}
    assert picked(listing.select_trip_files(keys, strict=False)) == {KEYS[i] for i in (0, 1, 2, 5, 6, 7)}
    recent = listing.filter_recent_months(keys, 1, datetime(2024, 2, 20, 12))
    assert picked(recent) == {KEYS[0], KEYS[1], KEYS[5]}
    later = listing.filter_recent_months(keys, 1, datetime(2024, 2, 20, 12), inclusive=False)
    assert picked(later) == {KEYS[1], KEYS[5]}
    midnight = listing.filter_recent_months(keys, 1, datetime(2024, 2, 20), inclusive=False)
    assert KEYS[0] in picked(midnight)
    manifest = listing.read_keys(spark, [(KEYS[0], 0)]).select("key")
    assert picked(listing.skip_loaded(keys, manifest)) == set(KEYS[1:])


def test_storage_inventory(spark, tmp_path):
    for name, size in (("raw/trips/a.zip", 3), ("raw/trips/2024/b.zip", 4), ("raw/feed/c.json", 5), ("top.txt", 6)):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    found = [tuple(r) for r in listing.storage_inventory(spark, str(tmp_path)).collect()]
    assert found == [("raw/feed", 1, 5), ("raw/trips", 2, 7), ("top.txt", 1, 6)]


def test_tables(spark, tmp_path):
    sinks.ensure_layers(spark)
    sinks.ensure_layers(spark)
    df = spark.range(100).select(F.col("id").cast("string").alias("station_id"), (F.col("id") % 24).alias("hour_of_day"))
    assert sinks.qualified(" marts ", "gap") == "marts.gap" and sinks.qualified(None, "gap") == "default.gap"
    sinks.replace_station_info(df, "raw.stations")
    sinks.replace_station_info(df.limit(7), "raw.stations")
    assert spark.table("raw.stations").count() == 7
    # The query reads the table that it replaces.
    sinks.publish(spark.table("raw.stations").limit(3), "raw.stations", "table")
    assert spark.table("raw.stations").count() == 3
    plain = sinks.publish(df, "marts.gap", "table", cluster_by=["station_id", "hour_of_day"])
    bucketed = sinks.publish(
        df, "marts.gap_bucketed", "table", partition_by=["hour_of_day"], cluster_by=["station_id"], buckets=4
    )
    assert plain.count() == bucketed.count() == 100
    bucketed = sinks.publish(
        df.limit(50), "marts.gap_bucketed", "table", partition_by=["hour_of_day"], cluster_by=["station_id"], buckets=4
    )
    assert bucketed.count() == 50
    assert len([f for f in spark.catalog.listTables("marts") if f.name.startswith("gap_bucketed")]) == 1
    grouped = plan_of(bucketed.groupBy("station_id").count()).split("== Physical Plan ==")[1]
    assert "Exchange" not in grouped
    assert [tuple(r) for r in sinks.list_layer(spark, "marts").collect()] == [("gap", "MANAGED"), ("gap_bucketed", "EXTERNAL")]
    view = sinks.publish(df.limit(3), "few")
    assert view.count() == 3
    with pytest.raises(ValueError):
        sinks.publish(df, "x", "cube")


def test_external_tables(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(5).select(F.col("id").cast("string").alias("station_id")).write.json(path)
    for _ in range(2):
        table = sinks.register_external(spark, "ext_lines", "json", path)
    assert table.count() == 5
    spark.sql("DROP TABLE ext_lines")
    assert spark.read.json(path).count() == 5  # the files outlive the table


def test_row_audit_needs_no_extra_job(spark, tmp_path):
    df, seen = audit.with_row_audit(spark.range(42), "rows")
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 42}
    counts = audit.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(counts) == [("a", 3), ("b", 0)]


ODD = 'x,y,z\na,1.5,\n"p\n\nq",2,"d""e"\n,"",""\n\nlong,row,1,2\nu,no,v\na"b,3,"c\n"\nlast,7,'


@pytest.mark.parametrize("block", [3, 16, 1 << 20])
def test_archive_blocks_hold_the_records_of_the_reader(tmp_path, monkeypatch, block):
    """Parsed at once or one by one, a member gives the same cells; text comes with what may not fit."""
    schema = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.DoubleType()), T.StructField("z", T.StringType())])
    monkeypatch.setattr(archives, "_BLOCK_CHARS", block)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as out:
        out.writestr("odd.csv", ODD)
        out.writestr("plain.csv", "x,y,z\n" + 'a,1.5,"b\nc"\n' * 50)
    found, plain = [], []
    with zipfile.ZipFile(tmp_path / "a.zip") as archive:
        for rows, member in ((found, "odd.csv"), (plain, "plain.csv")):
            for batch in archives._member_batches(archive, member, schema, {}):
                columns = [pa.array(batch[n], pa.string()).to_pylist() for n in ("x", "y", "z", "_corrupt_record", "_line")]
                rows += zip(*columns)
    assert [r[:4] for r in found] == [
        ("a", "1.5", None, None),
        ("p\n\nq", "2", 'd"e', None),
        (None, "", "", None),
        (None, None, None, "long,row,1,2"),
        ("u", "no", "v", None),
        ('a"b', "3", "c\n", None),
        ("last", "7", None, None),
    ]
    assert [r[4] for r in found if r[1] == "no"] == ["u,no,v"]
    assert [r[:4] for r in plain] == [("a", "1.5", "b\nc", None)] * 50
    assert block < 1 << 20 or {r[4] for r in plain} == {None}


def test_archives_of_one_task_are_bounded(spark, tmp_path):
    """A task's trips fill several archives, so that reading spreads over tasks."""
    from catalogue.landing import write_trip_archives

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        ids = spark.range(1000, numPartitions=1).select(F.col("id").cast("string").alias("ride_id"))
        write_trip_archives(ids, str(tmp_path / "landed"), archive_bytes=500)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    read = archives.unpack_trip_archives(spark, str(tmp_path / "landed"))
    assert len(list((tmp_path / "landed").glob("*.zip"))) > 3
    assert sorted(int(r.ride_id) for r in read.collect()) == list(range(1000))
