"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a session with a `local` master, whose tasks share the driver's disk,
    may leave the setting out; it then gets a temporary folder.
    """
    context = spark.sparkContext
    named = context.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if named:
        return named
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="corpus-")
    return _local[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{scratch_dir(spark)}/corpus/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write `df` once and read it back: the rows stay the same whoever reads them, and survive lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, from_files: bool = False) -> DataFrame:
    """Columns `row` (the input row as a struct, whatever its column names) and `row_id`, unique per row.

    For `df` read straight from Parquet files (`from_files`), a row is known by its
    place in them: a hash of the file's path and the row's number in it, the same in each read. Any other
    table is written once with numbers.
    """
    row = F.struct("*").alias("row")
    if from_files:
        file, at = F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")
        return df.select(row, F.struct(file.alias("file"), at.alias("at")).alias("row_id"))
    return stored(df.select(row, F.monotonically_increasing_id().alias("row_id")), name)


def clear(spark: SparkSession) -> bool:
    """Delete every intermediate table below the shared folder, once no result that reads them is needed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/corpus")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
