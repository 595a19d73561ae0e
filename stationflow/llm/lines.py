"""Substring dedup by hashing lines, paragraphs or passages: runs of clauses, wherever lines break."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.scratch import numbered, stored
from stationflow.llm.workers import tidy

#: What stands between two units. A paragraph ends at a line without words, a clause at a mark that white space follows.
SEPARATORS = {"line": r"\n", "paragraph": r"\n[ \t\r\x0b\x0c]*\n\s*", "passage": r"(?<=[.!?,;])[ \t-\r]+"}
#: The least number of words of a unit.
MIN_WORDS = {"line": 5, "paragraph": 5, "passage": 30}
_SLICE = 256


def units(text: str, separator: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and text of each unit, in code points of the whole text."""
    start = 0
    for cut in re.finditer(separator, text):
        yield start, cut.start(), text[start : cut.start()]
        start = cut.end()
    yield start, len(text), text[start:]


def normalised(unit: str) -> bytes:
    """A-Z in lower case, runs of ASCII white space as one space, trimmed."""
    return b" ".join(unit.encode("utf-8", "surrogatepass").lower().split())


def digest_of(norm: bytes) -> bytes:
    return hashlib.blake2b(norm, digest_size=16).digest()


def units_of(text: str, unit: str, min_words: int) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and digest of each unit of `min_words` words or more.

    A passage begins at each clause and takes as many whole clauses as it needs to have its words, so passages overlap; equal words
    in equal clauses give equal passages in whatever text they stand.
    """
    if unit != "passage":
        for start, end, own in units(text, SEPARATORS[unit]):
            norm = normalised(own)
            if norm.count(b" ") + bool(norm) >= min_words:
                yield start, end, digest_of(norm)
        return
    clauses = [(s, e, n, n.count(b" ") + 1) for s, e, c in units(text, SEPARATORS[unit]) if (n := normalised(c))]
    last, words = 0, 0
    for i, (start, _, _, own) in enumerate(clauses):
        while last < len(clauses) and words < min_words:
            words += clauses[last][3]
            last += 1
        if words < min_words:
            return
        yield start, clauses[last - 1][1], digest_of(b" ".join([c[2] for c in clauses[i:last]]))
        words -= own


def _splitter(unit: str, min_words: int):
    @tidy
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                some = batch.slice(at, _SLICE)
                picked, starts, digests = [], [], []
                for i, text in enumerate(some["text"].to_pylist()):
                    for start, _, digest in units_of(text or "", unit, min_words):
                        picked.append(i)
                        starts.append(start)
                        digests.append(digest)
                rows = pa.array(picked, pa.int32())
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.record_batch(
                    [some["row_id"].take(rows), some["doc_id"].take(rows), pa.array(starts, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                    ["row_id", "doc_id", "start", "digest", "digest2"],
                )

    return split


def repeated_units(docs: DataFrame, unit: str = "passage", min_words: int | None = None) -> DataFrame:
    """`row_id`, `start`, `kept_doc_id`, `kept_start` of each unit that an earlier one equals.

    From `row_id`, `doc_id`, `text`. The earliest is the one with the least
    `doc_id` (nulls last), then of the least row, then the first in its text. Units of fewer than `min_words`
    words (`MIN_WORDS`) are left alone. Digests have 128 bits. Only repeated digests are looked up again; a unit that stands
    in a third of all documents is one row on one side of the join, whose other side the skew join splits.
    """
    kinds = dict(docs.dtypes)
    found = stored(
        docs.select("row_id", "doc_id", "text").mapInArrow(
            _splitter(unit, MIN_WORDS[unit] if min_words is None else min_words),
            f"row_id {kinds['row_id']}, doc_id {kinds['doc_id']}, start long, digest long, digest2 long",
        ),
        "units",
    )
    # most units stand once: half a digest says so, and only the others are looked at with all they carry
    twice = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    found = stored(found.join(stored(twice, "repeated-digests"), "digest", "left_semi"), "repeated-units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id", "start")
    repeated = (
        found.groupBy("digest", "digest2").agg(F.min(rank).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    # stored, so that both sides of the join come from a shuffle of their own, which the skew join needs
    repeated = stored(repeated, "earliest-units")
    later = (F.col("row_id") != F.col("kept.row_id")) | (F.col("start") != F.col("kept.start"))
    return (
        found.join(repeated, ["digest", "digest2"])
        .where(later)
        .select("row_id", "start", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.start").alias("kept_start"))
    )


def cut(text: str, starts: set[int], unit: str, min_words: int) -> tuple[str, list[int], list[int], list[int], list[int]]:
    """`text` without the units that begin at `starts`; where what is kept begins and ends, and where what goes does.

    A line or paragraph that stays takes the separator before it along, unless it comes first. Of passages, the clauses of
    those that overlap go together, each with the white space behind it; a clause goes only if it stands in an earlier
    place that keeps it.
    """
    if unit != "passage":
        return _cut_units(text, starts, SEPARATORS[unit])
    gone: list[list[int]] = []
    begins = [s for s, _, _ in units(text, SEPARATORS[unit])] + [len(text)]
    following = {e: n for (_, e, _), n in zip(units(text, SEPARATORS[unit]), begins[1:])}
    for start, end, _ in units_of(text, unit, min_words):
        if start not in starts:
            continue
        if gone and start <= gone[-1][1]:
            gone[-1][1] = max(gone[-1][1], following[end])
        else:
            gone.append([start, following[end]])
    bounds = [0, *(x for span in gone for x in span), len(text)]
    kept = [(a, b) for a, b in zip(bounds[::2], bounds[1::2]) if a < b]
    return "".join(text[a:b] for a, b in kept), [a for a, _ in kept], [b for _, b in kept], [a for a, _ in gone], [b for _, b in gone]


def _cut_units(text: str, starts: set[int], separator: str) -> tuple[str, list[int], list[int], list[int], list[int]]:
    out, kept_starts, kept_ends, gone, last = [], [], [], [], 0
    for start, end, unit in units(text, separator):
        if start not in starts:
            if kept_starts:
                out.append(text[last:start])
            out.append(unit)
            kept_starts.append(start)
            kept_ends.append(end)
        else:
            gone.append((start, end))
        last = end
    return "".join(out), kept_starts, kept_ends, [a for a, _ in gone], [b for _, b in gone]


def _cutter(unit: str, min_words: int):
    fields = ["text", "starts", "ends", "gone_starts", "gone_ends"]

    @F.pandas_udf("text string, starts array<bigint>, ends array<bigint>, gone_starts array<bigint>, gone_ends array<bigint>")
    def run(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        made = [(None,) * 5 if s is None else cut(t, set(s), unit, min_words) for t, s in zip(texts, starts)]
        return pd.DataFrame(made, columns=fields)

    return run


def without_repeats(docs: DataFrame, unit: str = "passage", min_words: int | None = None) -> DataFrame:
    """From `row_id` and `row` (with `doc_id` and `text`): both, and `clean`, `kept` and `removed`.

    `clean` is the text after removal of `repeated_units`, `kept` and `removed` are spans
    (`start`, `end` in code points) of the given text. Null texts stay null, texts without a repeated
    unit stay as they are, a text of nothing but repeated units becomes empty. Of repeated rows the first keeps
    its units. An empty table gives no rows.
    """
    min_words = MIN_WORDS[unit] if min_words is None else min_words
    flat = docs.select("row_id", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    spans = repeated_units(flat, unit, min_words).groupBy("row_id").agg(
        F.sort_array(F.collect_list("start")).alias("gone")
    )
    # The units grow with the documents: the same plan at every size, not a broadcast while they are few.
    joined = docs.join(stored(spans, "removed-units").hint("merge"), "row_id", "left")
    text, gone = F.col("row.text"), F.col("gone")
    done = joined.withColumn(
        "done", _cutter(unit, min_words)(F.when(gone.isNotNull(), text), gone)
    )
    span = "array<struct<start:bigint,end:bigint>>"
    whole = F.when(text.isNull(), F.array().cast(span)).otherwise(
        F.array(F.struct(F.lit(0).cast("long").alias("start"), F.length(text).cast("long").alias("end")))
    )
    spans_of = lambda s, e: F.zip_with(s, e, lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    kept, removed = spans_of("done.starts", "done.ends"), spans_of("done.gone_starts", "done.gone_ends")
    return done.select(
        "row_id", "row", F.coalesce("done.text", text).alias("clean"),
        F.coalesce(kept, whole).alias("kept"), F.coalesce(removed, F.array().cast(span)).alias("removed"),
    )


def remove_repeats(df: DataFrame, unit: str = "passage", min_words: int | None = None, from_files: bool = False) -> DataFrame:
    """The rows of `df` with `text` after removal of repeated units, and `n_chars`, if there, to match; other columns stay.

    `from_files` as in `numbered`.
    """
    done = without_repeats(numbered(df, "documents", from_files), unit, min_words)
    new = {"text": F.col("clean")}
    if "n_chars" in df.columns:
        new["n_chars"] = F.length("clean").cast(df.schema["n_chars"].dataType)
    return done.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in df.columns])


def line_report(df: DataFrame, from_files: bool = False, unit: str = "passage") -> DataFrame:
    """`doc_id`, the cleaned `text`, `n_removed` spans and their places `removed` ("start:end,...") per row of `df`."""
    docs = numbered(df.select("doc_id", "text"), "documents", from_files)
    place = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return without_repeats(docs, unit).select(
        F.col("row.doc_id").alias("doc_id"), F.col("clean").alias("text"),
        F.size("removed").cast("long").alias("n_removed"), place.alias("removed"),
    )
