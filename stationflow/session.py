"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "stationflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes.

    Partition counts are left to the cluster's own configuration: adaptive
    execution coalesces small shuffles, so only the upper bound matters.
    Keyword names use ``__`` where the Spark setting has a dot.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Without the setting, the folder given to ``setCheckpointDir``; there is no other.
    """
    configured = (
        spark.conf.get(CHECKPOINT_DIR, None)
        or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
        or spark.sparkContext.getCheckpointDir()
    )
    if not configured:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return configured.rstrip("/")


def _scratch_of(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/stationflow-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under this application's part of the shared folder."""
    return f"{_scratch_of(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete all that this application stored; results that still read it can't be used any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_of(spark))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, and unlike a
    row-based checkpoint later reads prune columns and know the table's size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

