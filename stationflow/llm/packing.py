"""Packing token ids into sequences online, with a fixed number of open windows per partition."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.scratch import stored
from stationflow.llm.tokens import WordTokenizer, slices
from stationflow.llm.workers import tidy

_PIECE = "level int, part long, seq long, closed boolean, at long, doc_id long, start long, length long, doc_tokens long, ids binary"
_NAMES = [f.split()[0] for f in _PIECE.split(", ")]
_FIELDS = pa.schema([
    ("level", pa.int32()), ("part", pa.int64()), ("seq", pa.int64()), ("closed", pa.bool_()), ("at", pa.int64()), ("doc_id", pa.int64()),
    ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()),
])


class Packer:
    """Best fit into at most `windows` open windows of `capacity` ids.

    An item that fits nowhere while all windows are open fills the fullest one
    with its head, which is emitted full; the rest of the item goes on.
    """

    def __init__(self, level: int, part: int, capacity: int, windows: int):
        self.level, self.part, self.capacity, self.windows = level, part, capacity, windows
        self.open: dict[int, list[tuple]] = {}
        self.gaps: list[tuple[int, int]] = []
        self.next, self.done = 0, []

    def _piece(self, seq: int, at: int, item: tuple, n: int) -> tuple:
        """The first `n` ids of `item` at `at` in sequence `seq`; the row carries the item's own place."""
        doc_id, start, length, total, ids = item
        return self.level, self.part, seq, at, doc_id, start, n, total, bytes(ids[: 4 * n])

    @staticmethod
    def _rest(item: tuple, n: int) -> tuple:
        """What follows the first `n` ids; ids are a view, so nothing is copied, however often a long document is cut."""
        doc_id, start, length, total, ids = item
        return doc_id, start + n, length - n, total, ids[4 * n :]

    def _start(self) -> int:
        self.next += 1
        return self.next - 1

    def _put(self, gap: int, seq: int, item: tuple, n: int) -> None:
        self.open[seq].append(self._piece(seq, self.capacity - gap, item, n))
        if gap == n:
            self.done += self.open.pop(seq)
        else:
            insort(self.gaps, (gap - n, seq))

    def add(self, item: tuple) -> None:
        """Place `(doc_id, start, length, doc_tokens, ids)`."""
        item = (*item[:4], memoryview(item[4]))
        while item[2]:
            length = item[2]
            if length >= self.capacity:
                self.done.append(self._piece(self._start(), 0, item, self.capacity))
                item = self._rest(item, self.capacity)
                continue
            i = bisect_left(self.gaps, (length, -1))
            if i < len(self.gaps):
                gap, seq = self.gaps.pop(i)
                return self._put(gap, seq, item, length)
            if len(self.gaps) < self.windows:
                seq = self._start()
                self.open[seq] = []
                return self._put(self.capacity, seq, item, length)
            gap, seq = self.gaps.pop(0)
            self._put(gap, seq, item, gap)
            item = self._rest(item, gap)
        return None

    def closed(self) -> list[tuple]:
        """Pieces of the sequences emitted since the last call."""
        out, self.done = self.done, []
        return out

    def finish(self) -> None:
        """Merge what the windows hold: full sequences, then one of each power of two that the rest is made of."""
        items = [(*p[4:8], memoryview(p[8])) for seq in sorted(self.open) for p in self.open[seq]]
        self.open, self.gaps = {}, []
        left = sum(i[2] for i in items)
        seq, at, size = None, 0, 0
        for item in items:
            while item[2]:
                if at == size:
                    size = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                    seq, at = self._start(), 0
                n = min(item[2], size - at)
                self.done.append(self._piece(seq, at, item, n))
                item, at, left = self._rest(item, n), at + n, left - n


def _rows(pieces: list[tuple], closed: bool) -> list[tuple]:
    return [(*p[:3], closed, *p[3:]) for p in pieces]


def _packer(path: str, end_id: int, capacity: int, windows: int):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows), _FIELDS)], schema=_FIELDS)

    @tidy
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.load(path)
        packer = Packer(0, TaskContext.get().partitionId(), capacity, windows)
        for batch in batches:
            for some in slices(batch, "text"):
                raw, lengths = words.encode_documents(some["text"], end_id)
                at = 0
                for doc_id, n in zip(some["doc_id"].to_pylist(), lengths.tolist()):
                    packer.add((doc_id, 0, n, n, raw[4 * at : 4 * (at + n)]))
                    at += n
                if rows := _rows(packer.closed(), True):
                    yield batch_of(rows)
        if rows := [r for pieces in packer.open.values() for r in _rows(pieces, False)]:
            yield batch_of(rows)

    return pack


def _merger(level: int, capacity: int, windows: int, last: bool):
    def merge(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
        packer = Packer(level, int(key[0]), capacity, windows)
        left = left.sort_values(["length", "part", "seq", "at"], ascending=[False, True, True, True])
        ids = left["doc_id"].astype(object).where(left["doc_id"].notna(), None)
        for doc_id, start, n, total, raw in zip(ids, left["start"], left["length"], left["doc_tokens"], left["ids"]):
            packer.add((doc_id if doc_id is None else int(doc_id), int(start), int(n), int(total), bytes(raw)))
        if last:
            packer.finish()
        rows = _rows(packer.closed(), True) + [r for pieces in packer.open.values() for r in _rows(pieces, False)]
        out = pd.DataFrame(rows, columns=_NAMES)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return merge


def pack(
    df: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 4096, windows: int = 64, fan: int = 16
) -> DataFrame:
    """One row per piece: `sequence_id`, `at` (its offset there), `doc_id`, `start`, `length`, `doc_tokens`, `ids`.

    Each document of `df` (`doc_id`, `text`) is its ids and `end_id`; null and
    empty texts are the end id alone, repeated rows are packed each, a null
    `doc_id` stays null. Partitions pack on their own, without a shuffle. What their windows
    hold at the end is merged by `fan` partitions at a time until one group is
    left, so a task gets at most `fan * windows * capacity` ids. Sequences hold
    `capacity` ids, but for at most one of each smaller power of two.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = stored(docs.mapInArrow(_packer(tokenizer_path, end_id, capacity, windows), _PIECE), "pieces-0")
    levels, groups, level = [], 1, 0
    last_part = pieces.agg(F.max("part")).first()[0]
    groups = (last_part or 0) + 1
    while True:
        levels.append(pieces.where("closed"))
        level += 1
        groups = -(-groups // fan)
        last = groups == 1
        group = F.floor(F.col("part") / fan).cast("long").alias("group")
        merged = pieces.where("not closed").groupBy(group).applyInPandas(
            _merger(level, capacity, windows, last), _PIECE
        )
        pieces = stored(merged, f"pieces-{level}")
        if last:
            levels.append(pieces)
            break
    number = F.shiftleft(F.col("level").cast("long"), 58) + F.shiftleft("part", 27) + F.col("seq")
    out = reduce(DataFrame.unionByName, levels)
    return out.select(number.alias("sequence_id"), "at", "doc_id", "start", "length", "doc_tokens", "ids")


def packed_pieces(df: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """The pieces of `pack` with a checksum in place of their ids."""
    return pack(df, tokenizer_path, end_id).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        F.col("at").alias("offset"),
    )
