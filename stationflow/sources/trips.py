"""Trip readers: CSV in one or several layouts, and partitioned Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stationflow.schemas import TRIP_CLEAN, TRIP_RAW

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class TripLayout:
    """One CSV layout: its columns in file order, new names for them, and its files.

    ``files`` is a file-name glob, ``folder`` a place below the path that is
    read. The reader binds columns by position, so a file whose header
    disagrees with ``schema`` fails the read.
    """

    schema: T.StructType
    renames: Mapping[str, str] = field(default_factory=dict)
    files: str | None = None
    folder: str | None = None


def fit_types(text: DataFrame, schema: T.StructType, corrupt_col: str, line_col: str) -> DataFrame:
    """Cast text columns to ``schema``; a value that does not fit marks its row with ``line_col``.

    As an expression the mark is the same whichever columns a query goes on to use.
    """
    unfit = F.lit(False)
    for f in schema:
        if not isinstance(f.dataType, T.StringType):
            unfit = unfit | (
                F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            )
    corrupt = F.coalesce(F.col(corrupt_col), F.when(unfit, F.col(line_col))).alias(corrupt_col)
    known = {*schema.fieldNames(), corrupt_col, line_col}
    return text.select(
        *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema),
        corrupt,
        *(name for name in text.columns if name not in known),
    )


def _read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None,
    corrupt_col: str | None,
    layout: TripLayout | None = None,
) -> DataFrame:
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if layout:
        reader = reader.option("enforceSchema", False)
        if layout.files:
            reader = reader.option("pathGlobFilter", layout.files)
        if layout.folder:
            path = f"{path.rstrip('/')}/{layout.folder}"
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if not corrupt_col:
        return reader.schema(schema).csv(path)
    typed = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
    rows = (
        reader.schema(typed)
        .option("columnNameOfCorruptRecord", corrupt_col)
        .option("columnPruning", False)  # so that every line's columns are counted
        .csv(path)
    )
    # The reader checks the values of the columns that are asked of it. Through
    # the one-row generator that is all of them, whatever a query goes on to use.
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def read_trips_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRIP_RAW,
    corrupt_col: str | None = None,
    layouts: Sequence[TripLayout] | None = None,
    infer: bool = False,
) -> DataFrame:
    """Raw trips from CSV with a header.

    Bad values become NULL; with ``corrupt_col`` the line of such a row is kept
    there (see ``split_corrupt``). ``layouts`` reads files of different
    layouts into the columns of ``schema``; what a layout lacks is NULL. Where
    names don't tell the layouts apart, ``layouts.read_trips_by_header`` does.
    """
    if infer:
        return _read_csv(spark, path, None, None)
    if not layouts:
        return _read_csv(spark, path, schema, corrupt_col)
    parts = [
        _read_csv(spark, path, layout.schema, corrupt_col, layout).withColumnsRenamed(
            dict(layout.renames)
        )
        for layout in layouts
    ]
    return _aligned(parts, schema, corrupt_col)


def _aligned(parts: Sequence[DataFrame], schema: T.StructType, corrupt_col: str | None) -> DataFrame:
    """All parts with the columns of ``schema``; what a part lacks is NULL."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    columns = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return rows.select(*columns, *([corrupt_col] if corrupt_col else []))


def split_corrupt(df: DataFrame, corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Good rows without the corrupt column, and bad rows with it."""
    bad = F.col(corrupt_col).isNotNull()
    return df.filter(~bad).drop(corrupt_col), df.filter(bad)


def read_trips(spark: SparkSession, path: str, schema: T.StructType = TRIP_CLEAN) -> DataFrame:
    """Clean trips, or those columns of them that were stored, from Parquet partitioned by year and month.

    Filters on ``year`` and ``month`` prune folders.
    """
    return spark.read.schema(schema).parquet(path)
