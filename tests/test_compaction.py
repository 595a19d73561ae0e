from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stationflow.sources import compaction, sinks


def readings(spark, n, start=0):
    odd = F.when(F.col("id") % 3 > 0, F.concat(F.lit("a b%/'+\\\\}"), F.col("id") % 3))
    return spark.range(start, start + n).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("day"), odd.alias("kind")
    )


def files_of(df):
    return df.agg(F.count_distinct("_metadata.file_path")).first()[0]


def test_small_files_are_packed_while_a_query_reads(spark):
    df = readings(spark, 600)
    sinks.publish(df.repartition(5), "poll_files", "table", partition_by=["day", "kind"])
    table = spark.table("poll_files")
    assert files_of(table) == 30
    reader = spark.table("poll_files").toLocalIterator()
    seen = [next(reader).id]
    report = compaction.compact_partitions(spark, "poll_files")
    assert [(r.files_before, r.files_after) for r in report.collect()] == [(5, 1)] * 6
    assert all(r.bytes_after < r.bytes_before for r in report.collect())
    seen += [row.id for row in reader]
    assert sorted(seen) == list(range(600))
    packed = spark.table("poll_files")
    assert files_of(packed) == 6 and rows(packed.select(df.columns)) == rows(df)
    assert rows(packed.filter("kind is null").select("id")) == rows(df.filter("kind is null").select("id"))
    assert compaction.compact_partitions(spark, "poll_files").count() == 0  # nothing is left to do
    old = [Path(r.old_location.removeprefix("file:")) for r in report.collect()]
    assert all(p.is_dir() for p in old)
    assert compaction.drop_replaced(spark, "poll_files", report) == 6 and not any(p.exists() for p in old)
    # rows that come later follow the partitions to their new place, and are packed in turn
    more = readings(spark, 60, 600)
    more.select(packed.columns).repartition(3).write.insertInto("poll_files")
    assert rows(spark.table("poll_files").select(df.columns)) == rows(df.unionAll(more))
    again = compaction.compact_partitions(spark, "poll_files")
    assert again.count() == 6 and files_of(spark.table("poll_files")) == 6
    assert rows(spark.table("poll_files").select(df.columns)) == rows(df.unionAll(more))


def test_bins_have_the_target_size(spark):
    df = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit(1).alias("day"))
    sinks.publish(df.repartition(16), "bins", "table", partition_by=["day"])
    size = sum(r.length for r in spark.read.format("binaryFile").load(_folder(spark, "bins")).select("length").collect())
    report = compaction.compact_partitions(spark, "bins", target_bytes=size // 4 + 1).first()
    assert (report.files_before, report.files_after) == (16, 4)
    lengths = [r.length for r in spark.read.format("binaryFile").load(report.new_location).select("length").collect()]
    assert max(lengths) < 1.3 * size / 4
    assert rows(spark.table("bins").select("text")) == rows(df.select("text"))


def _folder(spark, table):
    return compaction._details(spark, table, "PARTITION (day = 1)")["Location"]


def test_a_partition_that_changes_meanwhile_stays(spark, monkeypatch):
    df = readings(spark, 40).select("id", "day")
    sinks.publish(df.repartition(2), "busy", "table", partition_by=["day"])
    first, calls = compaction._totals, []

    def totals(spark_, folders):
        calls.append(1)
        if len(calls) == 2:  # between writing and swapping
            late = spark.createDataFrame([(99,)], "id bigint")
            late.write.mode("append").parquet(next(f for f in folders if "2024-01-02" in f))
        return first(spark_, folders)

    monkeypatch.setattr(compaction, "_totals", totals)
    report = compaction.compact_partitions(spark, "busy")
    assert [r.partition for r in report.collect()] == ["day=2024-01-01"]
    spark.catalog.refreshTable("busy")
    assert sorted(r.id for r in spark.table("busy").collect()) == [*range(40), 99]


def test_tables_without_partitions_or_rows(spark):
    sinks.publish(spark.range(3), "flat_files", "table")
    with pytest.raises(ValueError, match="no partitions"):
        compaction.compact_partitions(spark, "flat_files")
    sinks.publish(readings(spark, 0), "none_yet", "table", partition_by=["day"])
    assert compaction.compact_partitions(spark, "none_yet").count() == 0
