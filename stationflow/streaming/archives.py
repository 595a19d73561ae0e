"""Trip archives loaded as they arrive: new ones only, each once, damaged ones tallied and passed over."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from stationflow.schemas import TRIP_RAW
from stationflow.sources import archives
from stationflow.sources.trips import CORRUPT

#: The folder of an archive's rows, the load that brought it, and what a ledger row says.
ARCHIVE_KEY, LOAD = "archive", "load"
LEDGER = (
    "path string, length bigint, modified timestamp, members bigint, failed_members bigint, "
    "rows bigint, corrupt_rows bigint, error string"
)
_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def archive_key(path: str | Column) -> Column:
    """A folder name of its own for each archive path."""
    column = F.col(path) if isinstance(path, str) else path
    return F.concat(F.substring_index(column, "/", -1), F.lit("-"), F.hex(F.xxhash64(column)))


def load_new_archives(
    spark: SparkSession,
    path: str,
    out: str,
    ledger: str,
    checkpoint: str,
    schema: T.StructType = TRIP_RAW,
    renames: Mapping[str, str] | None = None,
    members: str = "*.csv",
    max_archives: int | None = None,
    opener: archives.Opener = archives.open_path,
) -> StreamingQuery:
    """Load the archives below ``path`` that no earlier run with this ``checkpoint`` has loaded, and stop.

    Which archives are new is the file stream's own log, so nothing but their names is listed again. A load writes
    the rows of its archives below ``out``, a folder per archive, and then a row for each archive to ``ledger``,
    a folder per load. Both replace what an interrupted run of the same load left, so a restart repeats no row.
    A damaged member or archive gives no rows but an error in the ledger; the others go on. ``max_archives``
    bounds a load; the run then takes several.
    """

    def load(listed: DataFrame, number: int) -> None:
        session = listed.sparkSession
        files = listed.select("path", "length", F.col("modificationTime").alias("modified"))
        unpacked = archives.unpack_listed(files, schema, renames, members, opener=opener)
        keyed = unpacked.withColumn(ARCHIVE_KEY, archive_key(archives.ARCHIVE))
        _replace(keyed, out, ARCHIVE_KEY)
        written = read_loaded(session, out, schema, all_rows=True)
        own = files.select(archive_key("path").alias(ARCHIVE_KEY))
        results = archives.archive_results(written.join(own, ARCHIVE_KEY, "left_semi"))
        _replace(_ledger_rows(files, results).withColumn(LOAD, F.lit(number)), ledger, LOAD)

    stream = spark.readStream.format("binaryFile").schema(_BINARY_FILE)
    stream = stream.option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True)
    if max_archives:
        stream = stream.option("maxFilesPerTrigger", max_archives)
    started = (
        stream.load(path)
        .select("path", "modificationTime", "length")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return started


def _replace(df: DataFrame, path: str, by: str) -> None:
    """Write ``df`` below ``path``; folders that it fills lose what they held."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(by).parquet(path)


def _ledger_rows(files: DataFrame, results: DataFrame) -> DataFrame:
    """One row per archive, also for one without rows."""
    totals = results.groupBy("path").agg(
        F.count("member").alias("members"),
        F.count("error").alias("failed_members"),
        F.sum("rows").alias("rows"),
        F.sum("corrupt_rows").alias("corrupt_rows"),
        F.max("error").alias("error"),
    )
    zero = F.lit(0).cast("long")
    counts = ("members", "failed_members", "rows", "corrupt_rows")
    return files.join(totals, "path", "left").select(
        "path", "length", "modified", *(F.coalesce(c, zero).alias(c) for c in counts), "error"
    )


def read_loaded(
    spark: SparkSession, out: str, schema: T.StructType = TRIP_RAW, all_rows: bool = False
) -> DataFrame:
    """Rows of the loaded archives; with ``all_rows`` also corrupt ones, errors and where each comes from."""
    extra = [CORRUPT, archives.ARCHIVE, archives.MEMBER, archives.ERROR, ARCHIVE_KEY]
    fields = [*schema.fields, *(T.StructField(name, T.StringType()) for name in extra)]
    rows = spark.read.schema(T.StructType(fields)).parquet(out)
    if all_rows:
        return rows
    good = F.col(archives.ERROR).isNull() & F.col(CORRUPT).isNull()
    return rows.filter(good).select(*schema.fieldNames())


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """What was loaded: a row per archive with its load, rows and error."""
    return spark.read.schema(f"{LEDGER}, {LOAD} bigint").parquet(ledger)
