"""Operators over a listing of files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

# What names of trip files contain, start with and end with.
TRIP_MARKERS = ("-tripdata", "_tripdata")
OTHER_CITY = "JC-"
INDEX_PAGE = "index.html"
TRIP_EXTENSIONS = (".zip", ".csv")


def select_trip_files(
    listing: DataFrame,
    strict: bool = True,
    key: str = "key",
    markers: tuple[str, str] = TRIP_MARKERS,
) -> DataFrame:
    """Trip files of the main city.

    ``strict=False`` applies the prefix, index and extension tests only to keys
    with the second marker.
    """
    name = F.col(key)
    first, second = (name.contains(marker) for marker in markers)
    wanted = ~name.startswith(OTHER_CITY) & (name != INDEX_PAGE)
    extension = F.lit(False)
    for ending in TRIP_EXTENSIONS:
        extension = extension | name.endswith(ending)
    wanted = wanted & extension
    return listing.filter((first | second) & wanted if strict else first | (second & wanted))


def filter_recent_months(
    listing: DataFrame,
    months: int,
    as_of: datetime | None = None,
    inclusive: bool = True,
    key: str = "key",
) -> DataFrame:
    """Files whose name starts with a month (yyyyMM) of the last ``months`` 30-day spans.

    ``inclusive=False`` keeps the time of day in the cut-off, which then falls
    after the start of its own month and drops that month.
    """
    cutoff = ((as_of or datetime.now()) - timedelta(days=30 * months)).replace(day=1)
    if inclusive:
        cutoff = cutoff.replace(hour=0, minute=0, second=0, microsecond=0)
    month = F.try_to_timestamp(F.substring(key, 1, 6), F.lit("yyyyMM"))
    return listing.filter(month >= F.lit(cutoff.isoformat(" ")).cast("timestamp"))


def skip_loaded(listing: DataFrame, manifest: DataFrame, key: str = "key") -> DataFrame:
    """Files that ``manifest`` does not list."""
    return listing.join(manifest.select(key), key, "left_anti")


def list_files(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """Key (path below ``path``) and size of every file with a name like ``files``; contents are not read."""
    root = path.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", files)
        .load(path)
        .select("path", "length")
    )
    start = F.instr("path", root) + F.lit(len(root))
    return files.select(
        F.substr("path", start).alias("key"), F.col("length").alias("size_bytes")
    )


def folder_totals(
    listing: DataFrame, depth: int = 2, key: str = "key", size: str = "size_bytes"
) -> DataFrame:
    """Files and bytes per folder of the first ``depth`` path parts, in name order."""
    folder = F.array_join(F.slice(F.split(key, "/"), 1, depth), "/")
    return (
        listing.groupBy(folder.alias("folder"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"))
        .orderBy("folder")
    )


def storage_inventory(spark: SparkSession, path: str, depth: int = 2) -> DataFrame:
    """``folder_totals`` of the files under ``path``."""
    return folder_totals(list_files(spark, path), depth)


def read_keys(spark: SparkSession, keys: Sequence[tuple[str, int]]) -> DataFrame:
    """A listing from (key, size) pairs."""
    return spark.createDataFrame(list(keys), "key string, size_bytes bigint")
