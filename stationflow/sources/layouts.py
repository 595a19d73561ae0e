"""CSV files of several layouts in one folder, told apart by their headers."""

from __future__ import annotations

import csv
import gzip
import io
import re
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stationflow.schemas import TRIP_RAW
from stationflow.session import materialise
from stationflow.sources.archives import Opener, open_path
from stationflow.sources.trips import TripLayout, _aligned, _read_csv

_HEADERS = "path string, header array<string>"


def _first_line(path: str, opener: Opener) -> list[str]:
    """Cells of the first line that is not blank; none of a file without one."""
    with opener(path) as raw:
        body = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
        for line in io.TextIOWrapper(body, encoding="utf-8-sig", errors="replace"):
            if line.strip():
                return next(csv.reader([line]))
    return []


def read_headers(
    spark: SparkSession, path: str, files: str = "*.{csv,csv.gz}", opener: Opener = open_path
) -> DataFrame:
    """``path`` and ``header`` of every CSV file under ``path``.

    Spark lists the files; a task reads the first line of each and no more. A file of blank
    lines has an empty header; Spark does not list files of no bytes. ``opener`` as in ``unpack_trip_archives``.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", files)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path")
            headers = [_first_line(name, opener) for name in paths.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [paths.cast(pa.string()), pa.array(headers, pa.list_(pa.string()))], names=["path", "header"]
            )

    return listed.mapInArrow(read, _HEADERS)


def match_layouts(headers: DataFrame, layouts: Sequence[TripLayout]) -> DataFrame:
    """``headers`` with ``layout``, the number of the layout that fits, and the columns that it leaves out.

    A layout fits a header with all its columns, in any order and with any space around
    them; of several the one with most columns, then the first. A header that no layout fits, or with a
    name that is blank or stands twice, has a NULL layout.
    """
    names = F.transform("header", lambda name: F.trim(name))
    lower = F.transform("names", lambda name: F.lower(name))
    clear = (F.size(F.array_distinct(lower)) == F.size(lower)) & ~F.array_contains("names", "")

    def wanted(layout: TripLayout) -> Column:
        return F.array(*(F.lit(name) for name in layout.schema.fieldNames()))

    by_size = sorted(range(len(layouts)), key=lambda i: -len(layouts[i].schema))
    number, left = F.lit(None).cast("int"), F.lit(None).cast("array<string>")
    for i in reversed(by_size):
        fits = clear & (F.size(F.array_except(wanted(layouts[i]), "names")) == 0)
        number = F.when(fits, F.lit(i)).otherwise(number)
        left = F.when(fits, F.array_except("names", wanted(layouts[i]))).otherwise(left)
    return (
        headers.withColumn("names", names)
        .withColumns({"layout": number, "left_out": left})
        .drop("names")
    )


def literal_path(path: str) -> str:
    """A path in which nothing is a glob."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_trips_by_header(
    spark: SparkSession,
    path: str,
    layouts: Sequence[TripLayout],
    schema: T.StructType = TRIP_RAW,
    corrupt_col: str | None = None,
    files: str = "*.{csv,csv.gz}",
    opener: Opener = open_path,
) -> tuple[DataFrame, DataFrame]:
    """Raw trips from a folder of mixed layouts, and what was found out about each of its files.

    Files are grouped by header and each group is one read, in the columns of its layout
    (``match_layouts``) and of ``schema``; globs and folders of the layouts play no part. The files are
    ``path``, ``header``, ``layout`` and ``left_out``; those with a NULL layout are not read. The first lines are
    read now, and a file whose header changes afterwards fails the read. Only the paths meet in the driver, which
    lists them for any read, and the plan grows with the number of different headers.
    """
    found = materialise(match_layouts(read_headers(spark, path, files, opener), layouts), "headers")
    groups = (
        found.filter(F.col("layout").isNotNull())
        .groupBy("layout", "header")
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .orderBy("layout", "header")
        .collect()
    )
    parts = []
    for group in groups:
        layout = layouts[group.layout]
        kinds = {f.name: f.dataType for f in layout.schema}
        as_found = T.StructType(
            [T.StructField(name, kinds.get(name.strip(" "), T.StringType())) for name in group.header]
        )
        rows = _read_csv(
            spark, [literal_path(p) for p in group.paths], as_found, corrupt_col, TripLayout(as_found)
        )
        taken = [name for name in group.header if name.strip(" ") in kinds]
        parts.append(
            rows.select(
                *(
                    F.col(f"`{name}`").alias(layout.renames.get(name.strip(" "), name.strip(" ")))
                    for name in taken
                ),
                *([corrupt_col] if corrupt_col else []),
            )
        )
    if not parts:
        extra = [T.StructField(corrupt_col, T.StringType())] if corrupt_col else []
        return spark.createDataFrame([], T.StructType([*schema.fields, *extra])), found
    return _aligned(parts, schema, corrupt_col), found


# The readers travel with their code, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
