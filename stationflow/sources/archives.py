"""Zipped trip files.

Spark has no zip reader. Archives are listed by Spark, their members become
rows, and every member is decompressed and parsed by one task, block by
block, so memory does not grow with the member. A deflated member cannot be
split; parallelism comes from the number of members.
"""

from __future__ import annotations

import csv
import io
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from fnmatch import fnmatch
from itertools import chain, islice, tee
from typing import BinaryIO

import pyarrow as pa
from pyarrow import compute as pc, csv as arrow_csv, fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stationflow.schemas import TRIP_RAW
from stationflow.sources.trips import CORRUPT, fit_types

ARCHIVE, MEMBER, ERROR = "_archive", "_member", "_error"
_LINE = "_line"

_BATCH_ROWS = 10_000
_BLOCK_CHARS = 1 << 20
_COPY_BYTES = 1 << 20

# What a damaged archive or member raises. Anything else, such as a failed
# read, ends the task, which Spark then tries again.
DAMAGED = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError)

# Hadoop's names for a file system that Arrow knows by another.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}

Opener = Callable[[str], BinaryIO]


def open_path(path: str) -> BinaryIO:
    """A seekable file, local or on a file system Arrow knows; another scheme raises."""
    scheme, mark, rest = path.partition("://")
    if path.startswith("file:") or not mark:
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    system, name = fs.FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}://{rest}")
    return system.open_input_file(name)


def _wanted(info: zipfile.ZipInfo, pattern: str) -> bool:
    hidden = info.filename.startswith("__MACOSX/")
    return not info.is_dir() and not hidden and fnmatch(info.filename.lower(), pattern)


def _read_through(archive: zipfile.ZipFile, member: str) -> None:
    """Read a member to its end, where its checksum is compared."""
    with archive.open(member) as body:
        while body.read(_COPY_BYTES):
            pass


def _records(text: Iterable[str]) -> Iterator[tuple[list[str | None], str]]:
    """Cells and text of each CSV record; a quoted cell may hold line breaks and be of any length."""
    csv.field_size_limit(sys.maxsize)
    # The second copy lags by the lines of one record.
    parsed, lines = tee(text)
    records = csv.reader(parsed, quoting=csv.QUOTE_NOTNULL)
    before = 0
    for cells in records:
        after = records.line_num
        held = next(lines) if after - before == 1 else "".join(islice(lines, after - before))
        before = after
        if cells:
            yield cells, held.rstrip("\r\n")


def _record_end(text: str) -> int | None:
    """Where the last whole record in ``text`` ends, if it has one and no quote but round a cell or doubled in it."""
    if "\r" in text:
        return None
    parts = text.split('"')
    *closed, last = parts[::2] if len(parts) % 2 else [*parts[::2], ""]
    edges = ",\n"
    starts = [p for p in (*closed[1:], last if closed else "") if p]
    if any(p[0] not in edges for p in starts) or any(p[-1] not in edges for p in closed if p):
        return None
    end = len(text)
    for i in range(len(parts) - 1, -1, -1):
        start = end - len(parts[i])
        at = text.rfind("\n", start, end) if i % 2 == 0 else -1
        if at >= 0:
            return at + 1
        end = start - 1
    return None


def _number_patterns(schema: T.StructType) -> dict[str, str | None]:
    """Text that surely fits, per column that is not text; None where that takes a cast to tell."""
    patterns = {T.DoubleType(): r"^-?\d+(\.\d+)?$", T.FloatType(): r"^-?\d+(\.\d+)?$"}
    patterns |= {T.LongType(): r"^-?\d{1,9}$", T.IntegerType(): r"^-?\d{1,9}$"}
    return {f.name: patterns.get(f.dataType) for f in schema if not isinstance(f.dataType, T.StringType)}


def _parsed(block: str, width: int, place: Mapping[str, int], numbers: Mapping[str, str | None]) -> dict | None:
    """Columns of whole records, or None where some record's text may be asked for."""
    if any(pattern is None for name, pattern in numbers.items() if name in place):
        return None
    names = [str(i) for i in range(width)]
    try:
        table = arrow_csv.read_csv(
            pa.BufferReader(block.encode()),
            arrow_csv.ReadOptions(use_threads=False, block_size=4 * len(block) + 1, column_names=names),
            arrow_csv.ParseOptions(newlines_in_values=True),
            arrow_csv.ConvertOptions(
                column_types=dict.fromkeys(names, pa.string()),
                null_values=[""],
                strings_can_be_null=True,
                quoted_strings_can_be_null=False,
            ),
        )
    except pa.ArrowInvalid:  # a record of other cells than the header's
        return None
    values = {name: pa.concat_arrays(table.column(i).chunks or [pa.array([], pa.string())]) for name, i in place.items()}
    for name, pattern in numbers.items():
        if name in place and pc.all(pc.match_substring_regex(values[name], pattern)).as_py() is False:
            return None
    rows = table.num_rows
    return values | {name: pa.nulls(rows, pa.string()) for name in (_LINE, CORRUPT)}


def _member_batches(
    archive: zipfile.ZipFile, member: str, schema: T.StructType, renames: Mapping[str, str]
) -> Iterator[dict[str, Sequence[str | None]]]:
    """Text columns of one CSV member, with the text of malformed records and of those that may not fit ``schema``.

    Blocks of whole records are parsed at once; a block with anything odd, and the rest
    of a member whose quotes are odd, goes record by record.
    """
    numbers = _number_patterns(schema)
    with archive.open(member) as body:
        buffered = io.BufferedReader(body, _COPY_BYTES)
        text = io.TextIOWrapper(buffered, encoding="utf-8-sig", errors="replace", newline="")
        header = [renames.get(name.strip(), name.strip()) for name in next(_records(text), ([], ""))[0] if name]
        place = {name: header.index(name) for name in schema.fieldNames() if name in header}
        rest = ""
        while header and (chunk := text.read(_BLOCK_CHARS)):
            block = rest + chunk
            end = _record_end(block)
            if end is None:
                rest = block
                break
            block, rest = block[:end], block[end:]
            values = _parsed(block, len(header), place, numbers)
            if values is None:
                yield from _batches(_records(io.StringIO(block, newline="")), header, place)
            elif len(values[_LINE]):
                yield values
        # What was read ahead may end amid a line.
        ahead = io.StringIO(rest + text.readline(), newline="")
        yield from _batches(_records(chain(ahead, text)), header, place)


def _batches(
    records: Iterator[tuple[list[str | None], str]], header: Sequence[str], place: Mapping[str, int]
) -> Iterator[dict[str, Sequence[str | None]]]:
    """Text columns of records, with each record's text and that of malformed ones."""
    nothing = [None] * len(header)
    while found := list(islice(records, _BATCH_ROWS)):
        cells, texts = zip(*found)
        fit = [len(c) == len(header) for c in cells]
        by_column = list(zip(*(c if ok else nothing for c, ok in zip(cells, fit))))
        values = {name: by_column[i] for name, i in place.items()}
        yield values | {_LINE: texts, CORRUPT: [None if ok else text for text, ok in zip(texts, fit)]}


def unpack_trip_archives(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRIP_RAW,
    renames: Mapping[str, str] | None = None,
    members: str = "*.csv",
    parallelism: int | None = None,
    opener: Opener = open_path,
) -> DataFrame:
    """Rows of all CSV members of all zip archives under ``path``.

    Columns bind by header name after ``renames``, so members may order them
    differently and older layouts may lack some. Adds ``_corrupt_record`` with
    the text of a malformed record, the archive and member, and ``_error`` on a
    row of its own for a damaged archive or member. A member is read to its
    end once before its rows are, so a damaged one gives that row only. A read
    that fails for another reason fails the task. ``opener`` opens a path of a
    file system that Arrow does not know.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )
    return unpack_listed(listed, schema, renames, members, parallelism, opener)


def unpack_listed(
    listed: DataFrame,
    schema: T.StructType = TRIP_RAW,
    renames: Mapping[str, str] | None = None,
    members: str = "*.csv",
    parallelism: int | None = None,
    opener: Opener = open_path,
) -> DataFrame:
    """``unpack_trip_archives`` for the archives whose ``path`` is listed."""
    spark = listed.sparkSession
    columns = schema.fieldNames()
    renames = dict(renames or {})
    out = [*columns, CORRUPT, _LINE, ARCHIVE, MEMBER, ERROR]
    arrow_out = pa.schema([(name, pa.string()) for name in out])

    def list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, str | None, str | None]] = []
            for name in batch.column("path").to_pylist():
                with opener(name) as raw:
                    try:
                        with zipfile.ZipFile(raw) as archive:
                            infos = [i for i in archive.infolist() if _wanted(i, members)]
                        rows += [(name, i.filename, None) for i in infos]
                    except DAMAGED as error:
                        rows.append((name, None, f"{type(error).__name__}: {error}"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.string()) for i in range(3)],
                names=[ARCHIVE, MEMBER, ERROR],
            )

    def read_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(values: Mapping[str, Sequence], rows: int, **fixed: str | None) -> pa.RecordBatch:
            cells = [values.get(name, [fixed.get(name)] * rows) for name in out]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, pa.string()) for c in cells]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow_out)

        for batch in batches:
            for row in batch.to_pylist():
                if row[ERROR] is not None:
                    yield emit({}, 1, **row)
                    continue
                with opener(row[ARCHIVE]) as raw, zipfile.ZipFile(raw) as archive:
                    try:
                        _read_through(archive, row[MEMBER])
                    except DAMAGED as error:
                        yield emit({}, 1, **{**row, ERROR: f"{type(error).__name__}: {error}"})
                        continue
                    for values in _member_batches(archive, row[MEMBER], schema, renames):
                        yield emit(values, len(values[_LINE]), **row)

    # A count of paths says nothing about the work behind them, so the number
    # of tasks is set here; adaptive execution would merge these tiny rows.
    tasks = parallelism or max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    text = (
        listed.select("path").mapInArrow(list_members, f"{ARCHIVE} string, {MEMBER} string, {ERROR} string")
        .repartition(tasks, ARCHIVE, MEMBER)
        .mapInArrow(read_members, ", ".join(f"{name} string" for name in out))
    )
    return fit_types(text, schema, CORRUPT, _LINE)


def archive_results(unpacked: DataFrame) -> DataFrame:
    """Rows, corrupt rows and error of every archive member."""
    return unpacked.groupBy(
        F.col(ARCHIVE).alias("path"), F.col(MEMBER).alias("member")
    ).agg(
        F.count_if(F.col(ERROR).isNull()).alias("rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_rows"),
        F.max(ERROR).alias("error"),
    )


def ingest_report(results: DataFrame) -> DataFrame:
    """Files that loaded and files that failed."""
    status = F.when(F.col("error").isNull(), F.lit("success")).otherwise(F.lit("error"))
    return results.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("files"))


# The readers travel with their code, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
