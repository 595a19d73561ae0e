"""Token ids on disk: canonical, length-limited Huffman codes in independent blocks.

A folder holds three Parquet tables: `code` (id, bits), `parts` (part, start) and
`blocks` (part, block, payload). A payload is

    magic b"HUF1", number of documents, number of ids, ids per checkpoint, bytes of bits (u32 each)
    null flag of each doc_id (u8), doc_id (i64), number of ids (u32), start within the part (i64)
    bit offset of each checkpoint (u64)
    the bits, most significant first

A checkpoint stands before every `stride`-th id, so decoding can begin at any of
them, and a block needs nothing but the code.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.scratch import new_path, stored
from stationflow.llm.tokens import WordTokenizer, id_column, ids_in, slices
from stationflow.llm.workers import tidy

MAGIC = b"HUF1"
_HEAD = struct.Struct("<4s4I")
_PACKED = 1 << 15


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Bits of each symbol in an optimal prefix code of at most `max_bits` (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    bits = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols do not fit into {max_bits} bits")
    if len(used) < 2:
        bits[used] = 1
        return bits
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate([leaves, packages])
        place = np.argsort(merged, kind="stable")
        levels.append(place < len(leaves))
        merged = merged[place]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    taken, lengths = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:taken].sum())
        lengths[:n] += 1
        taken = 2 * (taken - n)
    bits[order] = lengths
    return bits


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """The code of each symbol: numbered upwards by length, then symbol."""
    codes = np.zeros(len(bits), np.uint32)
    code = 0
    for length in range(1, int(bits.max(initial=0)) + 1):
        code <<= 1
        own = np.flatnonzero(bits == length)
        codes[own] = np.arange(code, code + len(own), dtype=np.uint32)
        code += len(own)
    return codes


class Coder:
    """Packs and unpacks ids with one canonical code."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.codes = bits, canonical_codes(bits).astype(np.uint64)
        self.most = max(1, int(bits.max(initial=0)))
        self._table: tuple[np.ndarray, np.ndarray] | None = None

    def pack(self, ids: np.ndarray, stride: int) -> tuple[bytes, np.ndarray]:
        """The bits of `ids` and the bit offset of every `stride`-th of them."""
        lengths = self.bits[ids]
        total = int(lengths.sum(dtype=np.int64))
        words = np.zeros(total // 32 + 2, np.uint32)
        offsets = np.empty(-(-len(ids) // stride), "<u8")
        done = 0
        for start in range(0, len(ids), step := _PACKED // stride * stride or stride):  # within the processor's cache
            n = lengths[start : start + step].astype(np.int64)
            ends = done + np.cumsum(n)
            at = ends - n
            done = int(ends[-1])
            offsets[start // stride : start // stride + -(-len(n) // stride)] = at[::stride]
            both = self.codes[ids[start : start + step]] << (64 - (at & 31) - n).view(np.uint64)
            word = at >> 5
            first = np.flatnonzero(np.diff(word, prepend=-1))
            both = np.bitwise_or.reduceat(both, first)
            word = word[first]
            words[word] |= (both >> np.uint64(32)).astype(np.uint32)
            words[word + 1] |= both.astype(np.uint32)
        return words.astype(">u4").tobytes()[: (total + 7) // 8], offsets

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """For every window of `most` bits: the symbol it starts with, and that symbol's length."""
        if self._table is None:
            symbols, lengths = np.zeros(1 << self.most, np.uint32), np.ones(1 << self.most, np.uint8)
            order = np.lexsort((np.arange(len(self.bits)), self.bits))
            order = order[self.bits[order] > 0]
            widths = 1 << (self.most - self.bits[order].astype(np.int64))
            filled = int(widths.sum())
            symbols[:filled] = np.repeat(order, widths)
            lengths[:filled] = np.repeat(self.bits[order], widths)
            self._table = symbols, lengths
        return self._table

    def unpack(self, raw: bytes, n: int, offsets: np.ndarray, stride: int) -> np.ndarray:
        """`n` ids, decoded from all checkpoints side by side."""
        if not n:
            return np.empty(0, np.uint32)
        symbols, lengths = self.table()
        raw += bytes(12 + -len(raw) % 4)
        words = np.frombuffer(raw, ">u4").astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        at, last = offsets.astype(np.int64), 32 * (len(pairs) - 1)
        out = np.empty((stride, len(at)), np.uint32)
        down = np.uint64(64 - self.most)
        for step in range(stride):
            window = ((pairs[at >> 5] << (at & 31).astype(np.uint64)) >> down).astype(np.int64)
            out[step] = symbols[window]
            at = np.minimum(at + lengths[window], last)
        return out.T.reshape(-1)[:n]


def _tokenizer(path: str, end_id: int):
    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, start = WordTokenizer.load(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in slices(batch, "text"):
                raw, n = words.encode_documents(some["text"], end_id)
                starts = start + np.cumsum(n) - n
                yield pa.record_batch(
                    [pa.array(np.full(len(n), part, np.int32)), some["doc_id"], pa.array(starts), pa.array(n), id_column(raw, n)],
                    ["part", "doc_id", "part_start", "n_tokens", "ids"],
                )
                start += int(n.sum())

    return encode


def tokenize(df: DataFrame, path: str, end_id: int) -> DataFrame:
    """Ids of every document in ascending order of `doc_id` (nulls last, then by text): one table of ordered parts."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("at"))
    order = [F.asc_nulls_last("doc_id"), F.asc("h"), F.asc("at")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    kind = "part int, doc_id long, part_start long, n_tokens long, ids binary"
    return stored(ordered.mapInArrow(_tokenizer(path, end_id), kind), "token-ids")


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        own = np.bincount(ids_in(batch["ids"]), minlength=len(counts))
        own[: len(counts)] += counts
        counts = own
    used = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(used), pa.array(counts[used])], ["id", "n"])


def id_counts(tokens: DataFrame) -> DataFrame:
    """How often each id occurs in all documents."""
    counts = tokens.select("ids").mapInArrow(_tally, "id long, n long")
    return counts.groupBy("id").agg(F.sum("n").alias("n"))


def _block(coder: Coder, rows: pa.RecordBatch, stride: int) -> bytes:
    raw, offsets = coder.pack(ids_in(rows["ids"]), stride)
    doc_ids = rows["doc_id"]
    lengths = rows["n_tokens"].to_numpy()
    return b"".join((
        _HEAD.pack(MAGIC, rows.num_rows, int(lengths.sum()), stride, len(raw)),
        doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
        doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
        lengths.astype("<u4").tobytes(),
        rows["part_start"].to_numpy().astype("<i8").tobytes(),
        offsets.tobytes(),
        raw,
    ))


def _encoder(bits: np.ndarray, block_ids: int, stride: int):
    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(bits)
        for batch in batches:
            block = (np.cumsum(batch["n_tokens"].to_numpy()) - 1) // block_ids
            new = (np.diff(block) != 0) | (np.diff(batch["part"].to_numpy()) != 0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if end > start:
                    rows = batch.slice(start, end - start)
                    yield pa.record_batch(
                        [rows["part"].slice(0, 1), rows["part_start"].slice(0, 1), pa.array([_block(coder, rows, stride)], pa.binary())],
                        ["part", "part_start", "payload"],
                    )

    return encode


def write_ids(
    df: DataFrame, folder: str, tokenizer_path: str, end_id: int,
    max_bits: int = 20, block_ids: int = 1 << 20, stride: int = 256,
) -> None:
    """Write the ids of every whole text of `df` (`doc_id`, `text`), `end_id` after each, in ascending `doc_id` order.

    Null and empty texts are the end id alone; repeated rows are written each;
    null ids come last. An empty table gives a folder without blocks. A block has
    whole documents, about `block_ids` ids of them or one longer one. The code
    comes from the counts of all ids, a table no longer than the vocabulary.
    """
    spark = df.sparkSession
    tokens = tokenize(df, tokenizer_path, end_id)
    counted = id_counts(tokens).toPandas()
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 0, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    bits = code_lengths(counts, max_bits)
    used = np.flatnonzero(bits)
    code = pa.table({"id": pa.array(used, pa.int64()), "bits": pa.array(bits[used].astype(np.int32))})
    spark.createDataFrame(code).coalesce(1).write.parquet(f"{folder}/code")

    sizes = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").toPandas()
    starts = sizes["n"].cumsum() - sizes["n"]
    parts = pa.table({"part": pa.array(sizes["part"], pa.int32()), "start": pa.array(starts, pa.int64())})
    spark.createDataFrame(parts).coalesce(1).write.parquet(f"{folder}/parts")

    blocks = tokens.mapInArrow(_encoder(bits, block_ids, stride), "part int, part_start long, payload binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read_block(payload: bytes, coder: Coder) -> tuple[list[int | None], np.ndarray, np.ndarray, np.ndarray]:
    """`doc_id`s, starts within the part, numbers of ids, and all ids of one block."""
    magic, n_docs, n_ids, stride, n_raw = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a block of ids")
    at = _HEAD.size
    fields = []
    for kind, n in (("u1", n_docs), ("<i8", n_docs), ("<u4", n_docs), ("<i8", n_docs), ("<u8", -(-n_ids // stride))):
        fields.append(np.frombuffer(payload, kind, n, at))
        at += fields[-1].nbytes
    none, doc_ids, lengths, starts, offsets = fields
    ids = coder.unpack(payload[at : at + n_raw], n_ids, offsets, stride)
    return [None if x else int(d) for x, d in zip(none, doc_ids)], starts, lengths.astype(np.int64), ids


def _decoder(bits: np.ndarray):
    @tidy
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(bits)
        for batch in batches:
            for part, payload in zip(batch["part"].to_pylist(), batch["payload"]):
                doc_ids, starts, lengths, ids = read_block(payload.as_py(), coder)
                raw = ids.astype("<u4").tobytes()
                yield pa.record_batch(
                    [pa.array(np.full(len(starts), part, np.int32)), pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(lengths), id_column(raw, lengths)],
                    ["part", "doc_id", "part_start", "n_tokens", "ids"],
                )

    return decode


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id`, `start` (ids of all documents before it), `n_tokens` and `ids` (u32, little-endian) of every document."""
    code = spark.read.parquet(f"{folder}/code").toPandas()
    bits = np.zeros(int(code["id"].max()) + 1 if len(code) else 0, np.uint8)
    bits[code["id"].to_numpy(np.int64)] = code["bits"].to_numpy(np.uint8)
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = "part int, doc_id long, part_start long, n_tokens long, ids binary"
    docs = blocks.select("part", "payload").mapInArrow(_decoder(bits), kind)
    start = (F.col("start") + F.col("part_start")).alias("start")
    return docs.join(spark.read.parquet(f"{folder}/parts"), "part").select("doc_id", start, "n_tokens", "ids")


def token_digests(df: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the ids of `df`, read them back, and give `doc_id`, `start`, `n_tokens` and the checksum of each document."""
    folder = new_path(df.sparkSession, "token-files")
    write_ids(df, folder, tokenizer_path, end_id)
    read = read_ids(df.sparkSession, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
