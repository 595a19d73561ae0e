"""SimHash near-duplicates: fingerprints, links by multi-index hashing, and components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.components import connected
from stationflow.llm.scratch import numbered, stored
from stationflow.llm.workers import tidy

BITS = 64
SEGMENTS = 2
_WIDTH = BITS // SEGMENTS
_SEED = 42
_SLICE = 256


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """64-bit hashes of the word shingles of a text, in order; see `fingerprint` for what words are."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, "<u8")
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.fromiter((xxhash.xxh64_intdigest(g, _SEED) for g in grams), "<u8")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over word shingles; 0 for a text without words.

    Words are what lies between ASCII white space, with A-Z in lower case. A text
    of fewer words than a shingle counts as one shingle.
    """
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


@tidy
def _add_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            part = batch.slice(at, _SLICE)
            prints = np.array([fingerprint(t) for t in part["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.record_batch([part["row_id"], part["doc_id"], pa.array(prints)], ["row_id", "doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """From `row_id`, `doc_id` and `text`: `row_id`, `doc_id` and the fingerprint `fp`, a signed long."""
    kinds = dict(docs.dtypes)
    return docs.select("row_id", "doc_id", "text").mapInArrow(
        _add_fingerprints, f"row_id {kinds['row_id']}, doc_id {kinds['doc_id']}, fp long"
    )


def _probes(prints: DataFrame) -> DataFrame:
    """Rows `key`, `probe`, `fp`: each fingerprint under its own segments, and as a probe under their Hamming balls.

    With two segments, fingerprints at distance 3 or less differ by at most one
    bit in one of them. Of two segments that differ in one bit, one has a zero
    there, so probing from zeros to ones finds every pair.
    """
    flips = F.explode(F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(_WIDTH)]))
    ends = prints.select(
        "fp",
        F.explode(
            F.array(
                F.shiftrightunsigned("fp", _WIDTH),
                F.col("fp").bitwiseAND(F.lit((1 << _WIDTH) - 1)) + F.lit(1 << _WIDTH),
            )
        ).alias("own"),
    )
    return (
        ends.select("fp", "own", flips.alias("flip"))
        .where(F.col("own").bitwiseAND(F.col("flip")) == 0)
        .select(
            F.col("own").bitwiseOR(F.col("flip")).alias("key"),
            (F.col("flip") != 0).cast("int").alias("probe"),
            "fp",
        )
    )


class _Group:
    """The rows of one key so far: its indexed fingerprints and how they hang together."""

    def __init__(self, radius: int):
        self.radius, self.prints, self.roots = radius, np.empty(0, np.uint64), np.empty(0, np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, prints: np.ndarray, probes: np.ndarray) -> None:
        own = prints[~probes]
        if len(own):
            first = len(self.prints)
            self.prints = np.concatenate([self.prints, own])
            self.roots = np.concatenate([self.roots, np.arange(first, first + len(own))])
        if len(self.prints):
            step = max(1, (1 << 21) // len(self.prints))
            for at in range(0, len(prints), step):
                self._link(prints[at : at + step])

    def _link(self, prints: np.ndarray) -> None:
        near = np.bitwise_count(prints[:, None] ^ self.prints[None, :]) <= self.radius
        hit = near.any(axis=1)
        if not hit.any():
            return
        near, prints = near[hit], prints[hit]
        self.edges.append((prints, self.prints[near.argmax(axis=1)]))
        many = near.sum(axis=1) > 1
        for row in near[many]:
            roots = np.unique(self.roots[row])
            if len(roots) > 1:
                self.roots[np.isin(self.roots, roots)] = roots[0]

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        joined = np.flatnonzero(self.roots != np.arange(len(self.roots)))
        edges = [*self.edges, (self.prints[joined], self.prints[self.roots[joined]])]
        a, b = (np.concatenate(x) for x in zip(*edges))
        return a[a != b].view(np.int64), b[a != b].view(np.int64)


def _linker(radius: int):
    """Links within each key of sorted batches; holds the indexed fingerprints of one key and block at a time."""

    @tidy
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, None

        def closed() -> Iterator[pa.RecordBatch]:
            if group is not None:
                a, b = group.found()
                if len(a):
                    yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            keys = batch["key"].to_numpy()
            blocks = batch["block"].to_numpy()
            probes = batch["probe"].to_numpy().astype(bool)
            prints = batch["fp"].to_numpy().view(np.uint64)
            if not len(keys):
                continue
            new = np.flatnonzero((np.diff(keys) != 0) | (np.diff(blocks) != 0)) + 1
            starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(keys)]])
            alone = ends - starts == 1
            alone[[0, -1]] = False
            for s, e in zip(starts[~alone], ends[~alone]):
                if key != (this := (keys[s], blocks[s])):
                    yield from closed()
                    key, group = this, _Group(radius)
                group.add(prints[s:e], probes[s:e])
        yield from closed()

    return link


def links(prints: DataFrame, radius: int = 3, block: int = 4096) -> DataFrame:
    """Edges `a`, `b` that connect what is connected by distinct fingerprints `fp` at a distance of `radius` or less.

    Not every such pair is a row: within a key, a spanning forest stands for
    them, so a group of any size gives a row per probe. A
    key with more than `block` fingerprints is split into blocks; each block is
    compared with all rows of its key in a task of its own.
    """
    if not 0 <= radius < 2 * SEGMENTS:
        raise ValueError(f"radius must be below {2 * SEGMENTS}")
    probes = _probes(prints)
    large = stored(
        probes.where("probe = 0").groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        .where("blocks > 1"),
        "large-keys",
    )
    if large.isEmpty():
        placed = probes.withColumn("block", F.lit(0))
    else:
        sized = probes.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        asked = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        placed = sized.where("probe = 0").select("key", "probe", "fp", mine.alias("block")).unionByName(
            sized.select("key", F.lit(1).alias("probe"), "fp", asked.alias("block"))
        )
    return (
        placed.select("key", "block", "probe", "fp")
        .repartition("key", "block")
        .sortWithinPartitions("key", "block", "probe", "fp")
        .mapInArrow(_linker(radius), "a long, b long")
    )


def near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """`row_id`, `doc_id`, `fp`, `component` and `component_id` of every row of `row_id`, `doc_id`, `text`.

    `component_id` is the least `doc_id` among the documents reachable over
    fingerprints that differ in `radius` bits or less. Equal fingerprints are one
    node, so copies cost one row each. Null and empty texts have fingerprint 0 and
    are linked like any other; a null `doc_id` keeps its row, and a component of
    nulls only has a null id. `component` is a fingerprint that stands for it.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    member = connected(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    placed = nodes.join(member, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = stored(placed.join(ids, "component").select("fp", "component", "component_id"), "components")
    return rows.join(of_print, "fp").select("row_id", "doc_id", "fp", "component", "component_id")


def simhash_components(df: DataFrame) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id` per row of `df`; other columns are not read."""
    docs = df.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, from_files: bool = False) -> DataFrame:
    """Of each component, the row with the least `doc_id` (nulls last), and of equal ones the first; all columns stay.

    `from_files` as in `numbered`.
    """
    docs = numbered(df, "documents", from_files)
    seen = near_duplicates(docs.select("row_id", F.col("row.doc_id"), F.col("row.text")))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")
    first = seen.groupBy("component").agg(F.min(rank).alias("first")).select(F.col("first.row_id").alias("row_id"))
    return docs.join(first, "row_id", "left_semi").select("row.*")
