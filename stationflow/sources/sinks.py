"""Writers and tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stationflow.sources.clustering import z_ordered

# The three layers, each a database of its own.
LAYERS = ("raw", "staging", "marts")


def write_trips(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    dynamic: bool = True,
    compact: bool = False,
) -> None:
    """Clean trips as Parquet, partitioned by year and month.

    With ``dynamic`` an overwrite replaces only the months present in ``df``.
    ``compact`` gathers each month before writing and splits large months, for
    input whose tasks each touch many months.
    """
    rows = df.hint("rebalance", "year", "month") if compact else df
    writer = rows.write.mode(mode).partitionBy("year", "month")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.parquet(path)


def append_snapshots(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Add snapshot rows under a folder per capture date."""
    day = F.to_date(F.col("snapshot_at").cast("timestamp"))
    df.withColumn("snapshot_date", day).write.partitionBy("snapshot_date").mode("append").format(
        fmt
    ).save(path)


def replace_station_info(df: DataFrame, table: str) -> None:
    """Replace the station reference table as a whole."""
    publish(df, table, as_="table")


def _quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_external(
    spark: SparkSession,
    name: str,
    fmt: str,
    path: str,
    schema: T.StructType | None = None,
    partitioned_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Create or replace a table over existing files; the files stay in place.

    An earlier table keeps its name until the new one stands beside it.
    """
    draft, former = _beside(name)
    extra = dict(options or {})
    columns = ""
    if schema is not None:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        columns = f" ({listed})"
    given = ", ".join(f"{_quoted(k)} {_quoted(v)}" for k, v in extra.items())
    layout = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(
        f"CREATE TABLE {draft}{columns} USING {fmt}"
        + (f" OPTIONS ({given})" if given else "")
        + layout
        + f" LOCATION {_quoted(path)}"
    )
    if partitioned_by:
        spark.catalog.recoverPartitions(draft)
    if _take_over(spark, draft, name, former):
        spark.sql(f"DROP TABLE {former}")
    return spark.table(name)


def _beside(name: str) -> tuple[str, str]:
    """Names for a table under way and for the one it replaces."""
    mark = uuid.uuid4().hex[:12]
    return f"{name}_draft_{mark}", f"{name}_former_{mark}"


def _take_over(spark: SparkSession, draft: str, name: str, former: str) -> bool:
    """Give ``draft`` the name; whether a table had it, which is ``former`` then."""
    replaces = spark.catalog.tableExists(name)
    if replaces:
        spark.sql(f"ALTER TABLE {name} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {draft} RENAME TO {name}")
    return replaces


def ensure_layers(spark: SparkSession, layers: Sequence[str] = LAYERS) -> None:
    """Create the layers' databases where they do not exist."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def qualified(layer: str | None, table: str, default: str = "default") -> str:
    """``layer.table``, or the default layer's table when none is named."""
    return f"{layer.strip() if layer else default}.{table}"


def publish(
    df: DataFrame,
    name: str,
    as_: str = "view",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    buckets: int | None = None,
    interleave: bool = False,
) -> DataFrame:
    """Publish ``df`` as a temporary view (recomputed on read) or a stored table.

    ``cluster_by`` sorts the files, so that row groups of a column chunk can be
    skipped; with ``buckets`` it also co-locates later joins on those columns. Sorted by
    the columns in turn, only filters on the first skip much; with ``interleave`` filters
    on each of them do (``z_ordered``).
    A table is written beside an earlier one of its name, which stays readable
    until the new one is complete and takes the name over.
    """
    spark = df.sparkSession
    if as_ == "view":
        if "." in name:
            raise ValueError(f"{name}: a view in a layer is kept as SQL text; use publish_view, or as_='table'")
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if as_ != "table":
        raise ValueError(f"as_ must be 'view' or 'table', not {as_!r}")
    rows = df
    if interleave and (buckets or not cluster_by):
        raise ValueError("interleave orders the files by cluster_by, without buckets")
    if interleave:
        rows = z_ordered(rows, cluster_by, partition_by=partition_by)
    elif cluster_by and not buckets:
        # Range-partitioned, so each file covers a narrow span of the columns.
        rows = rows.repartitionByRange(*cluster_by).sortWithinPartitions(
            *partition_by, *cluster_by
        )
    writer = rows.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *cluster_by).sortBy(*cluster_by)
    draft, former = _beside(name)
    if partition_by:
        # A renamed table keeps its partitions only where its files stay in place.
        database = name.rpartition(".")[0] or spark.catalog.currentDatabase()
        folder = spark.catalog.getDatabase(database).locationUri
        writer = writer.option("path", f"{folder}/{draft.rpartition('.')[2]}")
    writer.saveAsTable(draft)
    if _take_over(spark, draft, name, former):
        _drop_with_files(spark, former)
    return spark.table(name)


def publish_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Create or replace a view that every session reads, in its layer, from SQL text over stored tables.

    Such a view is kept as text, so a DataFrame can't become one; ``publish`` gives that a temporary view.
    """
    layer = name.rpartition(".")[0]
    if layer:
        ensure_layers(spark, [layer])
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def _drop_with_files(spark: SparkSession, name: str) -> None:
    """Drop a table that ``publish`` wrote, and its files where the catalogue doesn't."""
    details = dict(spark.sql(f"DESCRIBE TABLE EXTENDED {name}").select("col_name", "data_type").collect())
    spark.sql(f"DROP TABLE {name}")
    if details.get("Type") == "EXTERNAL" and "_draft_" in details["Location"].rsplit("/", 1)[-1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(details["Location"])
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.delete(path, True)


def list_layer(spark: SparkSession, database: str) -> DataFrame:
    """Names and types of the tables of a layer."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, table_type string").orderBy(
        "table_name"
    )
