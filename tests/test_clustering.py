import math
from datetime import date
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from stationflow.sources import clustering, sinks


def groups(folder, column, value):
    """Row groups whose footer admits ``value``, and all of them."""
    admits = total = 0
    for file in folder.rglob("*.parquet"):
        footer = pq.ParquetFile(file).metadata
        at = footer.schema.names.index(column)
        for i in range(footer.num_row_groups):
            span = footer.row_group(i).column(at).statistics
            total += 1
            admits += span.min <= value <= span.max
    return admits, total


def test_each_column_skips_row_groups(spark, tmp_path):
    n = 200_000
    df = spark.range(n).select(
        F.format_string("s-%05d", F.xxhash64("id") % 500 + 500).alias("station_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(24)).cast("int").alias("hour"),
        F.col("id").alias("score"),
    )
    plain = df.repartitionByRange(8, "station_id", "hour").sortWithinPartitions("station_id", "hour")
    curve = clustering.z_ordered(df, ["station_id", "hour"])
    for name, rows_ in (("plain", plain), ("curve", curve)):
        rows_.write.option("parquet.block.size", 16_384).option("parquet.page.size", 4_096).parquet(str(tmp_path / name))
    assert spark.read.parquet(str(tmp_path / "curve")).exceptAll(df).count() == 0
    by_hour, of = groups(tmp_path / "plain", "hour", 8)
    z_hour, z_of = groups(tmp_path / "curve", "hour", 8)
    z_station, _ = groups(tmp_path / "curve", "station_id", "s-00500")
    print(f"hour: {by_hour} of {of} row groups sorted, {z_hour} of {z_of} on the curve; station: {z_station}")
    assert z_of > 40 and by_hour / of > 0.5
    assert z_hour / z_of < 0.4 and z_station / z_of < 0.4


def test_cells_follow_the_order_of_values(spark):
    for values in (
        [None, 1, 2, 2, 2, 5, 9], [None, "", "a", "ab", "z", "é"], [None, date(2024, 1, 1), date(2024, 2, 1)],
        [None, Decimal("-1.50"), Decimal("2.25")], [None, -math.inf, -0.5, 3.0, math.inf, math.nan], [None, False, True],
    ):
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], schema_of(values))
        got = [r.z for r in df.select("i", clustering.z_value(df, ["v"]).alias("z")).orderBy("i").collect()]
        assert got == sorted(got) and len(set(got[1:])) >= len({v for v in values[1:] if v == v}) - 1, values


def schema_of(values):
    kind = {int: "bigint", str: "string", date: "date", Decimal: "decimal(9,2)", float: "double", bool: "boolean"}
    return f"v {kind[type(values[1])]}, i int"


def test_bits_come_in_turn(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    z = {(r.a, r.b): r.z for r in df.select("a", "b", clustering.z_value(df, ["a", "b"], bits=2).alias("z")).collect()}
    assert all(z[a, b] == (a >> 1) * 8 + (b >> 1) * 4 + (a & 1) * 2 + (b & 1) for a in range(4) for b in range(4))
    with pytest.raises(ValueError):
        clustering.z_value(df, ["a"] * 11)


def test_hot_cells_empty_tables_and_repeats(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = spark.range(20_000).select(F.lit("s").alias("k"), F.lit(None).cast("int").alias("n"), "id")
        sizes = [r["count"] for r in clustering.z_ordered(hot, ["k", "n"]).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 8_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert clustering.z_ordered(hot.limit(0), ["k", "n"]).count() == 0
    twice = spark.createDataFrame([("a", 1, {"x": 1})] * 3 + [(None, 2, None)], "k string, n int, m map<string,int>")
    assert rows(clustering.z_ordered(twice, ["k", "n"])) == rows(twice)


def test_interleaved_tables(spark):
    df = spark.range(300).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"), (F.col("id") % 2).alias("p"))
    out = sinks.publish(df, "interleaved", "table", partition_by=["p"], cluster_by=["a", "b"], interleave=True)
    assert rows(out.select("a", "b", "p")) == rows(df)
    for wrong in ({"cluster_by": ["a"], "buckets": 2}, {}):
        with pytest.raises(ValueError, match="interleave"):
            sinks.publish(df, "interleaved", "table", interleave=True, **wrong)
