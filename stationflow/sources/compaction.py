"""Small files of a partitioned table packed into files of a target size, while others read it."""

from __future__ import annotations

import uuid
from collections.abc import Collection
from itertools import accumulate
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F

from stationflow.sources.layouts import literal_path

TARGET_BYTES = 256 << 20

# Fixed value: what a folder of NULLs is called.
_NULL = "__HIVE_DEFAULT_PARTITION__"

_REPORT = """partition string, files_before bigint, files_after bigint,
             bytes_before bigint, bytes_after bigint, old_location string, new_location string"""


def _details(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    found: dict[str, str] = {}
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect():
        found.setdefault(row["col_name"], row["data_type"])  # a partition's details come before the table's
    return found


def _spec(partition: str) -> str:
    """``day=2024-01-01/kind=a%2Fb``, as the catalogue lists partitions, in SQL."""
    parts = []
    for part in partition.split("/"):
        name, _, value = part.partition("=")
        text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"`{unquote(name)}` = " + ("null" if value == _NULL else f"'{text}'"))
    return f"PARTITION ({', '.join(parts)})"


def _files(spark: SparkSession, folders: Collection[str]) -> DataFrame:
    """``path``, ``folder``, ``length`` and ``modificationTime`` of the files right below ``folders``; Spark lists them."""
    listed = spark.read.format("binaryFile").load([literal_path(folder) for folder in folders])
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return listed.select("path", folder.alias("folder"), "length", "modificationTime")


def _totals(spark: SparkSession, folders: Collection[str]) -> dict[str, Row]:
    """Files, bytes and a mark of the files' names, sizes and times per folder."""
    mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    totals = _files(spark, folders).groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), mark.alias("mark")
    )
    return {row.folder: row for row in totals.collect()}


def compact_partitions(spark: SparkSession, table: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Pack the files of a table's partitions to about ``target_bytes``; one row per partition that was packed.

    Partitions with at least twice the files that they need are read and written once, all in one
    job: the files of a partition are dealt in name order to bins of the target size, and the rows of a
    bin are written together. New files lie beside the table's folder. Then each partition's location in
    the catalogue changes to them, which is one step: a query sees the old files or the new ones. Old files
    stay for queries that began before, until ``drop_replaced``. A partition whose files have changed while
    it was packed keeps its old files. Add rows with ``insertInto``, which follows a partition's location.
    The driver handles one row per partition.
    """
    names = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not names:
        raise ValueError(f"{table} has no partitions")
    place = _details(spark, table)
    partitions = {
        _details(spark, table, _spec(row["partition"]))["Location"]: row["partition"]
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
    }
    before = _totals(spark, partitions) if partitions else {}
    needed = {folder: -(-total.bytes // target_bytes) for folder, total in before.items()}
    chosen = [folder for folder, total in before.items() if total.files >= 2 * needed[folder]]
    if not chosen:
        return spark.createDataFrame([], _REPORT)

    # Each bin is the task of its number: a folder's bins begin where those of the folders before it end.
    first_bins = accumulate((needed[folder] for folder in chosen), initial=0)
    folders = spark.createDataFrame(list(zip(chosen, first_bins)), "folder string, first_bin bigint")
    earlier = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    own_bin = F.floor(F.coalesce(F.sum("length").over(earlier), F.lit(0)) / target_bytes)
    bins = (
        _files(spark, chosen)
        .withColumn("_own", own_bin)
        .join(folders, "folder")
        .select(F.col("path").alias("_path"), (F.col("first_bin") + F.col("_own")).cast("int").alias("_bin"))
    )
    # Spark gives a row's file as a URI and lists files as plain paths.
    uri = F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))
    found = spark.table(table).withColumn("_path", F.regexp_replace(F.url_decode(uri), "^file:/+", "file:/"))
    root = f"{place['Location'].rstrip('/')}-compacted/{uuid.uuid4().hex}"
    dealt = found.join(bins, "_path").repartitionById(sum(needed[folder] for folder in chosen), "_bin")
    dealt.drop("_path", "_bin").write.partitionBy(*names).format(place["Provider"]).save(root)

    now = _totals(spark, chosen)
    after = _totals(spark, [f"{root}/{partitions[folder]}" for folder in chosen])
    report = []
    for old in chosen:
        new = f"{root}/{partitions[old]}"
        if old in now and now[old].mark == before[old].mark:
            location = new.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} {_spec(partitions[old])} SET LOCATION '{location}'")
            old_total, new_total = before[old], after[new]
            report.append(
                (partitions[old], old_total.files, new_total.files, old_total.bytes, new_total.bytes, old, new)
            )
    spark.catalog.refreshTable(table)
    return spark.createDataFrame(report, _REPORT)


def drop_replaced(spark: SparkSession, table: str, report: DataFrame) -> int:
    """Delete the old files of a ``compact_partitions`` report, once no query reads them; the number of folders deleted.

    A folder that a partition has as its location stays.
    """
    used = {
        _details(spark, table, _spec(row["partition"]))["Location"]
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
    }
    gone = [row.old_location for row in report.collect() if row.old_location not in used]
    for location in gone:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(gone)
