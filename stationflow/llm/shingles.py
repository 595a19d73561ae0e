"""Near-duplicates by the similarity of their word shingles: min-hash bands find candidates, the sets of shingles decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.components import connected
from stationflow.llm.scratch import numbered, stored
from stationflow.llm.simhash import shingle_hashes
from stationflow.llm.workers import tidy

#: Sets that share 0.8 of their shingles agree in all rows of a band with chance 0.8^5, and in no band with chance 5e-5.
BANDS, ROWS = 25, 5
#: Shingles of a block, and what a document counts beside its own.
_BLOCK, _EACH = 1 << 22, 256
_SLICE = 256
_FACTORS = np.array([xxhash.xxh64_intdigest(b"factor %d" % i) | 1 for i in range(BANDS * ROWS)], np.uint64)
_MIX = np.array([xxhash.xxh64_intdigest(b"mix %d" % i) | 1 for i in range(BANDS * ROWS)], np.uint64)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct 64-bit hashes of the word shingles of a text, ascending."""
    return np.unique(shingle_hashes(text, shingle))


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets share `similarity` of their union or more."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-6:
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / max(1, len(a) + len(b) - shared) >= similarity


def bands_of(sets: list[np.ndarray]) -> np.ndarray:
    """A row of `BANDS` keys for each of the sets, none of which is empty."""
    if not sets:
        return np.empty((0, BANDS), np.int64)
    hashes, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for i in range(BANDS * ROWS):
        keys[:, i // ROWS] += np.minimum.reduceat(hashes * _FACTORS[i], starts) * _MIX[i]
    return (keys ^ (keys >> np.uint64(32))).view(np.int64)


def _sketcher(shingle: int):
    @tidy
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                sets = [shingle_set(t, shingle) for t in part["text"].to_pylist()]
                sizes = np.array([len(s) for s in sets], np.int64)
                prints = np.array([xxhash.xxh64_intdigest(s.tobytes()) if len(s) else 0 for s in sets], np.uint64)
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands_of([s for s in sets if len(s)]).ravel()))
                yield pa.record_batch(
                    [part["row_id"], part["doc_id"], pa.array(prints.view(np.int64)), pa.array(sizes), bands],
                    ["row_id", "doc_id", "fp", "n", "bands"],
                )

    return sketch


class _Block:
    """The texts of a block so far: their sets, and by band which of them hang together."""

    def __init__(self, similarity: float):
        self.similarity, self.prints, self.sets, self.roots = similarity, [], [], []
        self.bands: dict[int, dict[int, list[int]]] = {}

    def root(self, i: int) -> int:
        while self.roots[i] != i:
            self.roots[i] = i = self.roots[self.roots[i]]
        return i

    def _members(self, band: int) -> dict[int, list[int]]:
        """Those with a band, by the root of what they hang together with."""
        found = self.bands.get(band, {})
        for old in [r for r in found if self.roots[r] != r]:
            found.setdefault(self.root(old), []).extend(found.pop(old))
        return found

    def links(self, shingles: np.ndarray, bands: list[int]) -> list[int]:
        """One of each group that the set is alike to any of."""
        hit: dict[int, int] = {}
        seen: set[int] = set()
        for band in bands:
            for root, members in self._members(band).items():
                for i in members if root not in hit else ():
                    if i not in seen:
                        seen.add(i)
                        if alike(shingles, self.sets[i], self.similarity):
                            hit[root] = i
                            break
        return list(hit.values())

    def add(self, fp: int, shingles: np.ndarray, bands: list[int], linked: list[int]) -> None:
        me = len(self.roots)
        self.prints.append(fp)
        self.sets.append(shingles)
        self.roots.append(me)
        for i in linked:
            self.roots[self.root(i)] = me
        for band in bands:
            self.bands.setdefault(band, {}).setdefault(me, []).append(me)


def _verifier(shingle: int, similarity: float):
    """Links within each block of sorted batches, its own texts first."""

    @tidy
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, None
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            for at in range(0, batch.num_rows, _SLICE):
                for row in batch.slice(at, _SLICE).to_pylist():
                    if key != (row["component"], row["block"]):
                        key, group = (row["component"], row["block"]), _Block(similarity)
                    shingles = shingle_set(row["text"], shingle)
                    linked = group.links(shingles, row["bands"])
                    a += [row["fp"]] * len(linked)
                    b += [group.prints[i] for i in linked]
                    if not row["probe"]:
                        group.add(row["fp"], shingles, row["bands"], linked)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return verify


def _candidates(nodes: DataFrame) -> DataFrame:
    """`node` and `component`: what hangs together by equal band keys."""
    keys = nodes.select("fp", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return connected(keys.join(shared, "key").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")))


def similar_links(nodes: DataFrame, texts: DataFrame, shingle: int, similarity: float, block: int = _BLOCK) -> DataFrame:
    """Edges `a`, `b` that connect what is connected by texts that share a band and `similarity` of their shingles.

    `nodes` has `fp`, `row_id`, `n` and `bands` of each distinct set, `texts` has `row_id` and `text`. What hangs
    together by bands is one group; a group of more than `block` shingles is split, and each block is
    compared with itself and the later ones in a task of its own. A text is not compared with those that hang
    together with one that it is alike to, so a large group of near copies costs a comparison or so each.
    """
    member = stored(_candidates(nodes), "candidates")
    grouped = nodes.join(member, F.col("fp") == F.col("node")).select("component", "fp", "row_id", "n", "bands")
    large = grouped.groupBy("component").agg(F.ceil(F.sum(F.col("n") + _EACH) / block).cast("int").alias("blocks")).where("blocks > 1")
    sized = grouped.join(stored(large, "large-groups"), "component", "left")
    mine = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    asked = sized.withColumn("mine", mine).join(texts, "row_id")
    placed = asked.withColumn("block", F.explode(F.sequence(F.lit(0), "mine"))).select(
        "component", "block", (F.col("block") < F.col("mine")).alias("probe"), "fp", "bands", "text"
    )
    return (
        placed.repartition("component", "block")
        .sortWithinPartitions("component", "block", "probe", "fp")
        .mapInArrow(_verifier(shingle, similarity), "a long, b long")
    )


def one_of_each(df: DataFrame, shingle: int = 5, similarity: float = 0.8, from_files: bool = False) -> DataFrame:
    """Of each group of near-duplicates, the row with the least `doc_id` (nulls last), and of equal ones the first.

    Texts whose sets of word shingles share `similarity` of their union or more are near-duplicates, and
    so is what they reach; words are those of `simhash.fingerprint`. All columns stay. Texts with equal sets are
    copies and cost one row each, so are null texts and those without words. Candidates share a band of min-hashes, which a
    pair at 0.8 misses with chance 5e-5; each link is verified on the whole sets. `from_files` as in `numbered`.
    """
    docs = numbered(df, "documents", from_files)
    texts = docs.select("row_id", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    kinds = dict(texts.dtypes)
    sketches = texts.mapInArrow(
        _sketcher(shingle), f"row_id {kinds['row_id']}, doc_id {kinds['doc_id']}, fp long, n long, bands array<bigint>"
    )
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id", "n", "bands")
    nodes = stored(
        stored(sketches, "sketches").groupBy("fp").agg(F.min(rank).alias("first")).select("fp", "first.*"), "distinct-sets"
    )
    found = similar_links(nodes.select("fp", "row_id", "n", "bands"), texts.select("row_id", "text"), shingle, similarity)
    member = connected(found).withColumnRenamed("node", "fp")
    placed = nodes.join(member, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    first = placed.groupBy("component").agg(F.min(F.struct("none", "doc_id", "row_id")).alias("first"))
    return docs.join(first.select(F.col("first.row_id").alias("row_id")), "row_id", "left_semi").select("row.*")
