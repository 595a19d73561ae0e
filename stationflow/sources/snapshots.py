"""Station snapshots and station reference: readers and document flattening."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stationflow.schemas import SNAPSHOT, SNAPSHOT_DOC, SNAPSHOT_STATION, STATION_DOC

PARTITION = "snapshot_date"

# VARIANT columns: a whole document, and all fields of a station.
DOC, FIELDS = "doc", "fields"

ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def read_snapshots(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = SNAPSHOT,
    day: str | date | None = None,
    since: str | date | None = None,
    until: str | date | None = None,
    fmt: str = "json",
) -> DataFrame:
    """Snapshot rows from line JSON or Parquet: a whole tree, one ``day`` of it, or a range of days.

    A day given as ``2026/06/15`` is a folder below ``path``. A date or
    ``2026-06-15``, and ``since`` and ``until`` (both inclusive), select the
    ``snapshot_date`` partitions that ``append_snapshots`` and
    ``ingest_snapshots`` write; only their folders are read, and days without
    one give no rows. ``schema=None`` infers the columns.
    """
    reader = (spark.read if schema is None else spark.read.schema(schema)).format(fmt)
    if isinstance(day, str) and "/" in day:
        return reader.load(f"{path.rstrip('/')}/{day}")
    if day is not None:
        since = until = day
    if since is None and until is None:
        return reader.option("recursiveFileLookup", True).load(path)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(PARTITION, T.DateType())]))
    rows, taken = reader.load(path), F.col(PARTITION).cast("date")
    if since is not None:
        rows = rows.filter(taken >= F.lit(str(since)).cast("date"))
    if until is not None:
        rows = rows.filter(taken <= F.lit(str(until)).cast("date"))
    return rows.drop(PARTITION)


def read_snapshot_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = SNAPSHOT_DOC,
    one_per_file: bool = True,
) -> DataFrame:
    """Nested snapshot documents, one per file or one per line.

    The default keeps the fields it names. ``schema=None`` infers them from a scan
    of everything; ``read_variant_documents`` keeps them all without one.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", one_per_file).option("recursiveFileLookup", True).json(path)


def read_variant_documents(
    spark: SparkSession, path: str, one_per_file: bool = True, corrupt_col: str | None = None
) -> DataFrame:
    """Documents as they are, one per file or one per line, in the VARIANT column ``doc``.

    No schema is needed and none is inferred: every field is kept in one scan.
    The ``doc`` of malformed text is NULL; ``corrupt_col`` keeps the text.
    """
    reader = spark.read.option("singleVariantColumn", DOC).option("multiLine", one_per_file)
    reader = reader.option("recursiveFileLookup", True)
    if not corrupt_col:
        return reader.json(path)
    # Beside a variant the reader knows this column by the session's name for it only.
    text = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    docs = reader.schema(
        T.StructType([T.StructField(DOC, T.VariantType()), T.StructField(text, T.StringType())])
    ).json(path)
    # Through the one-row generator both columns are read, whatever a query goes on to use.
    return docs.select(F.inline(F.array(F.struct(DOC, F.col(text).alias(corrupt_col)))))


def read_station_documents(
    spark: SparkSession, path: str, schema: T.StructType | None = STATION_DOC
) -> DataFrame:
    """Nested station documents, one per file."""
    return read_snapshot_documents(spark, path, schema)


def _timestamp(value: datetime | str | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp")
    text = value.isoformat() if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp")


def flatten_snapshot(docs: DataFrame, captured_at: datetime | str | Column) -> DataFrame:
    """One row per station of a snapshot document, stamped with the capture time.

    Every field of the station is kept. Documents without stations give no rows.
    """
    taken = _timestamp(captured_at)
    return docs.select(
        F.explode("data.stations").alias("_station"),
        F.date_format(taken, ISO_TIME).alias("snapshot_at"),
        F.unix_timestamp(taken).alias("snapshot_epoch"),
    ).select("_station.*", "snapshot_at", "snapshot_epoch")


def flatten_variant_snapshot(
    docs: DataFrame,
    captured_at: datetime | str | Column,
    schema: T.StructType = SNAPSHOT_STATION,
) -> DataFrame:
    """``flatten_snapshot`` of the VARIANT column ``doc``: typed columns, and every field as VARIANT.

    ``schema`` names the fields that become columns; a value that does not fit its
    type is NULL there. ``fields`` holds the station as it came, so fields that a
    feed adds, or sends in another type, are read from there (``variant_field``).
    Documents without a list of stations give no rows.
    """
    taken = _timestamp(captured_at)
    rows = docs.select(
        F.explode(F.try_variant_get(F.col(DOC), "$.data.stations", "array<variant>")).alias(FIELDS),
        F.date_format(taken, ISO_TIME).alias("snapshot_at"),
        F.unix_timestamp(taken).alias("snapshot_epoch"),
    )
    typed = [variant_field(f.name, f.dataType.simpleString()).alias(f.name) for f in schema]
    return rows.select(*typed, "snapshot_at", "snapshot_epoch", FIELDS)


def variant_field(name: str, kind: str = "string", column: str = FIELDS) -> Column:
    """Field ``name`` of a VARIANT column in the given type; NULL where it is missing or does not fit."""
    if "'" in name:
        raise ValueError(f"a path can't quote the name {name!r}")
    return F.try_variant_get(F.col(column), f"$['{name}']", kind)


def field_kinds(rows: DataFrame, column: str = FIELDS) -> DataFrame:
    """Names and types of the fields that the objects of a VARIANT column hold, with the number of rows.

    One aggregation over the rows; compared with a schema it shows what a feed has added or changed.
    """
    entries = rows.select(F.col(column).alias("_object")).lateralJoin(
        rows.sparkSession.tvf.variant_explode(F.col("_object").outer())
    )
    return (
        entries.filter(F.col("key").isNotNull())
        .groupBy(F.col("key").alias("field"), F.schema_of_variant("value").alias("kind"))
        .agg(F.count(F.lit(1)).alias("readings"))
    )


def flatten_station_info(docs: DataFrame, ingested_at: datetime | str | Column) -> DataFrame:
    """Typed station rows of a station document; missing fields become "" or 0."""
    defaults = (
        ("station_id", "string", ""),
        ("name", "string", ""),
        ("short_name", "string", ""),
        ("lat", "double", 0.0),
        ("lon", "double", 0.0),
        ("capacity", "bigint", 0),
        ("region_id", "string", ""),
    )
    rows = docs.select(
        F.explode("data.stations").alias("s"), _timestamp(ingested_at).alias("_ingested_at")
    )
    known = set(rows.schema["s"].dataType.fieldNames())
    columns = []
    for name, kind, default in defaults:
        value = F.col(f"s.{name}") if name in known else F.lit(None)
        columns.append(F.coalesce(value.cast(kind), F.lit(default).cast(kind)).alias(name))
    return rows.select(*columns, "_ingested_at")
