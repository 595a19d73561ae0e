"""Input files for the queries: trips as zip archives."""

from __future__ import annotations

import os
import sys
import zipfile
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F


#: Fixed value: an archive is closed once its text is this long.
ARCHIVE_BYTES = 64 << 20


def write_trip_archives(
    df: DataFrame, path: str, broken: bool = False, every: int = 2, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Trips as zip archives below a local ``path``, one CSV member each and at least one archive per task.

    A task goes on in another archive after ``archive_bytes`` of text, so that reading them spreads over
    as many tasks as the text fills. It writes under a name of its own attempt and renames an archive when
    that is complete. ``broken`` spoils bytes amid the data of the members of one task in ``every``.
    """
    header = ",".join(df.columns)
    options = {
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "escape": '"',
    }
    lines = df.select(
        F.concat(F.to_csv(F.struct(*df.columns), options), F.lit("\n")).alias("line"),
        F.spark_partition_id().alias("part"),
    )
    folder = path.removeprefix("file:")

    def write_one(name: str, spoilt: bool, batches: Iterator[pa.RecordBatch]) -> None:
        draft = f"{folder}/.{name}-{TaskContext.get().taskAttemptId()}"
        # The lightest compression: it takes a third of the default's time.
        with zipfile.ZipFile(draft, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
            with archive.open(f"{name}.csv", "w", force_zip64=True) as member:
                size = member.write(f"{header}\n".encode())
                for batch in batches:
                    size += member.write("".join(batch.column("line").to_pylist()).encode())
                    if size >= archive_bytes:
                        break
            info = archive.infolist()[0]
        if spoilt:
            with open(draft, "r+b") as file:
                file.seek(info.header_offset + info.compress_size // 2)
                file.write(bytes(64))
        os.replace(draft, f"{folder}/{name}.zip")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (b for b in batches if b.num_rows)
        os.makedirs(folder, exist_ok=True)
        for i, first in enumerate(filled):
            part = first.column("part")[0].as_py()
            name = f"trips-{part:05d}-{i:05d}"
            write_one(name, broken and part % every == 0, chain([first], filled))
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    lines.mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
