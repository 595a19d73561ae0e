"""Ranked lexical search by a dual tree: hierarchies over items and documents bound the scores of whole batches.

Documents become sparse vectors over the items' terms. A tree over items and one over the documents
of a chunk hold the greatest value of each term below their nodes; the product of two nodes' maxima bounds all scores between them. A pair
goes when its bound is below the weakest k-th score of its items, so what is left out can't be among the best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.scratch import stored
from stationflow.llm.workers import tidy

#: ASCII letters and digits and all that isn't ASCII belong to terms; A-Z count as a-z.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_SLICE = 256
#: Documents of a leaf, children of a node, items of a leaf's parent.
LEAF, FAN = 32, 8
_CHUNK_CELLS = 1 << 24


def terms(data: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, repeats included."""
    return data.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """What a term of weight 1 adds to the score, from its occurrences `tf` in a document of `n` terms."""
    m = 100 - 90 + (90 * n * n_docs) // max(1, length)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Tree:
    """Levels of nodes, leaves first, each with the greatest value per term of what lies below it."""

    def __init__(self, leaves: np.ndarray):
        self.levels = [leaves]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            starts = np.arange(0, len(below), FAN)
            self.levels.append(np.maximum.reduceat(below, starts, axis=0))


@dataclass
class Items:
    """A block of items: sparse rows over their own terms, in an order that brings similar ones together."""

    rows: list[int]
    terms: list[np.ndarray]
    weights: np.ndarray

    def __post_init__(self) -> None:
        heaviest = [int(t[np.argmax(self.weights[t])]) if len(t) else -1 for t in self.terms]
        order = sorted(range(len(self.rows)), key=lambda i: (heaviest[i], self.rows[i]))
        self.rows, self.terms = [self.rows[i] for i in order], [self.terms[i] for i in order]
        # a node's greatest values are the weights of all terms that stand below it
        self.levels = [self.terms]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([np.unique(np.concatenate(below[i : i + FAN])) for i in range(0, len(below), FAN)])

    def weakest(self, kth: np.ndarray) -> list[np.ndarray]:
        """The least k-th score below each node, level by level."""
        out = [kth]
        while len(out[-1]) > 1:
            out.append(np.minimum.reduceat(out[-1], np.arange(0, len(out[-1]), FAN)))
        return out


@dataclass
class Chunk:
    """Documents as sparse vectors, in leaves of neighbours that share a rare term, under a tree of maxima."""

    ids: list
    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, ids: list, lengths: np.ndarray, columns: np.ndarray, values: np.ndarray, weights: np.ndarray) -> Chunk:
        ends = np.cumsum(lengths)
        starts = ends - lengths
        rarest = np.full(len(ids), -1)
        found = np.flatnonzero(lengths)
        if len(found):
            gain = weights[columns] * values
            best = np.maximum.reduceat(gain, starts[found])
            top = gain == np.repeat(best, lengths[found])
            row = np.repeat(found, lengths[found])
            rarest[row[top][::-1]] = columns[top][::-1]
        order = np.lexsort((lengths, rarest))
        at = np.concatenate([np.arange(starts[i], ends[i]) for i in order]) if len(columns) else np.empty(0, int)
        begin = np.concatenate([[0], np.cumsum(lengths[order])])
        return cls([ids[i] for i in order], begin, columns[at], values[at])

    def leaf(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        first, last = i * LEAF, min((i + 1) * LEAF, len(self.ids))
        a, b = self.starts[first], self.starts[last]
        rows = np.repeat(np.arange(last - first), np.diff(self.starts[first : last + 1]))
        return rows, self.columns[a:b], self.values[a:b], last - first

    def tree(self, n_terms: int) -> Tree:
        n = -(-len(self.ids) // LEAF)
        maxima = np.zeros((n, n_terms), np.int64)
        for i in range(n):
            _, columns, values, _ = self.leaf(i)
            np.maximum.at(maxima[i], columns, values)
        return Tree(maxima)


class Search:
    """The best documents of one chunk for each item of a block, beginning from k-th scores known already."""

    def __init__(self, items: Items, chunk: Chunk, k: int, kth: np.ndarray):
        self.items, self.chunk, self.k, self.given = items, chunk, k, kth
        self.tree = chunk.tree(len(items.weights))
        self.kth = kth.copy()
        self.best: list[list[tuple[int, int]]] = [[] for _ in items.rows]
        self.visited = self.scored = 0

    def bounds(self, level: int, node: int, doc_level: int, docs: np.ndarray) -> np.ndarray:
        found = self.items.levels[level][node]
        self.visited += len(docs)
        return self.tree.levels[doc_level][np.ix_(docs, found)] @ self.items.weights[found]

    def leaf_pairs(self) -> dict[int, list[tuple[int, int]]]:
        """Leaves of documents with the items that may find better ones there, and the bound of each pair."""
        weakest = self.items.weakest(self.kth)
        top, doc_top = len(self.items.levels) - 1, len(self.tree.levels) - 1
        frontier = [(top, 0, doc_top, np.zeros(1, int))]
        pairs: dict[int, list[tuple[int, int]]] = {}
        while frontier:
            level, node, doc_level, docs = frontier.pop()
            bound = self.bounds(level, node, doc_level, docs)
            alive = bound >= max(1, weakest[level][node])
            docs, bound = docs[alive], bound[alive]
            if not len(docs):
                continue
            if level == 0 and doc_level == 0:
                for doc, b in zip(docs.tolist(), bound.tolist()):
                    pairs.setdefault(doc, []).append((node, b))
                continue
            if doc_level > 0:
                below = (docs[:, None] * FAN + np.arange(FAN)).ravel()
                docs = below[below < len(self.tree.levels[doc_level - 1])]
            nodes = [node] if level == 0 else range(node * FAN, min((node + 1) * FAN, len(self.items.levels[level - 1])))
            frontier += [(max(0, level - 1), n, max(0, doc_level - 1), docs) for n in nodes]
        return pairs

    def score_leaf(self, leaf: int, wanted: list[tuple[int, int]]) -> None:
        wanted = [(i, b) for i, b in wanted if b >= max(1, self.kth[i])]
        if not wanted:
            return
        rows, columns, values, n = self.chunk.leaf(leaf)
        union = np.unique(np.concatenate([self.items.terms[i] for i, _ in wanted]))
        place = np.searchsorted(union, columns)
        place[place == len(union)] = 0
        here = union[place] == columns
        dense = np.zeros((n, len(union)), np.int64)
        dense[rows[here], place[here]] = values[here]
        for i, _ in wanted:
            own = self.items.terms[i]
            scores = dense[:, np.searchsorted(union, own)] @ self.items.weights[own]
            self.scored += n
            good = np.flatnonzero(scores >= max(1, self.kth[i]))
            if len(good):
                self.best[i] = self.top(self.best[i] + [(int(scores[j]), leaf * LEAF + int(j)) for j in good])
                if len(self.best[i]) == self.k:
                    self.kth[i] = max(self.kth[i], self.best[i][-1][0])

    def top(self, found: list[tuple[int, int]]) -> list[tuple[int, int]]:
        return sorted(found, key=lambda x: (-x[0], self.chunk.ids[x[1]] is None, self.chunk.ids[x[1]] or 0))[: self.k]

    def seeds(self) -> list[list[tuple[int, int]]]:
        """For each item the best of the leaf that its bound favours: k-th scores that the whole search may begin with."""
        leaves = np.arange(len(self.tree.levels[0]))
        wanted: dict[int, list[tuple[int, int]]] = {}
        for i in range(len(self.items.rows)):
            bound = self.bounds(0, i, 0, leaves)
            if len(bound) and bound.max() > 0:
                wanted.setdefault(int(bound.argmax()), []).append((i, int(bound.max())))
        for leaf, pairs in wanted.items():
            self.score_leaf(leaf, pairs)
        return self.best

    def run(self) -> list[list[tuple[int, int]]]:
        pairs = self.leaf_pairs()
        for leaf in sorted(pairs, key=lambda d: -max(b for _, b in pairs[d])):
            self.score_leaf(leaf, pairs[leaf])
        return self.best


def _vectoriser(vocabulary: dict[bytes, int], id_kind: pa.DataType):
    """Documents as sparse vectors over the vocabulary; at a task's end, a row of how many documents have each term."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary), np.int64)
        names = ["doc_id", "n", "terms", "tfs", "stats"]
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                some = batch.slice(at, _SLICE)
                lengths, columns, tfs = [], [], []
                for data in some["text"].cast(pa.binary()).to_pylist():
                    words = terms(data or b"")
                    found = Counter(map(vocabulary.get, words))
                    found.pop(None, None)
                    own = np.fromiter(found.keys(), np.int32, len(found))
                    df[own] += 1
                    lengths.append(len(words))
                    columns.append(own.tobytes())
                    tfs.append(np.fromiter(found.values(), np.int64, len(found)).tobytes())
                yield pa.record_batch(
                    [some["doc_id"], pa.array(lengths, pa.int64()), pa.array(columns, pa.binary()), pa.array(tfs, pa.binary()),
                     pa.array([False] * some.num_rows)], names,
                )
        own = np.flatnonzero(df).astype(np.int32)
        yield pa.record_batch(
            [pa.nulls(1, id_kind), pa.array([0], pa.int64()), pa.array([own.tobytes()], pa.binary()),
             pa.array([df[own].tobytes()], pa.binary()), pa.array([True])], names,
        )

    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for own, counts in zip(batch["terms"].to_pylist(), batch["tfs"].to_pylist()):
            yield pa.record_batch([pa.array(np.frombuffer(own, np.int32)), pa.array(np.frombuffer(counts, np.int64))], ["term", "df"])


def _searcher(items: Items, kth: np.ndarray, k: int, n_docs: int, length: int, id_kind: pa.DataType, seeds: bool, chunk_docs: int):
    """Candidates of each chunk of a partition: item row, document and score."""
    size = min(chunk_docs, max(LEAF, _CHUNK_CELLS // max(1, len(items.weights)) * LEAF))

    def searched(batch: pa.Table) -> pa.RecordBatch:
        columns = np.concatenate([np.frombuffer(x, np.int32) for x in batch["terms"].to_pylist()]).astype(np.int64)
        per = [np.frombuffer(x, np.int64) for x in batch["tfs"].to_pylist()]
        lengths = np.array([len(x) for x in per])
        values = impacts(np.concatenate(per), np.repeat(batch["n"].to_numpy(), lengths), n_docs, length)
        chunk = Chunk.of(batch["doc_id"].to_pylist(), lengths, columns, values, items.weights)
        search = Search(items, chunk, k, kth)
        best = search.seeds() if seeds else search.run()
        rows = [(items.rows[i], chunk.ids[j], s) for i, found in enumerate(best) for s, j in found]
        at, ids, scores = zip(*rows) if rows else ((), (), ())
        return pa.record_batch(
            [pa.array(at, pa.int64()), pa.array(ids, id_kind), pa.array(scores, pa.int64())], ["item_row", "doc_id", "score"]
        )

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                held.append(batch.slice(at, size))
                if sum(b.num_rows for b in held) >= size:
                    yield searched(pa.Table.from_batches(held))
                    held = []
        if held:
            yield searched(pa.Table.from_batches(held))

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms(data or b""))) for data in batch["text"].cast(pa.binary()).to_pylist()]
        yield pa.record_batch(
            [batch["item_row"], batch["item_id"], pa.array(found, pa.list_(pa.binary())), pa.array([len(f) for f in found], pa.int64())],
            ["item_row", "item_id", "terms", "size"],
        )


def _in_blocks(items: DataFrame, block_terms: int) -> DataFrame:
    """Items with a `block` each, so that a block has at most `block_terms` terms and those of one item more."""
    kind = dict(items.dtypes)["item_id"]
    numbered = stored(items.select(F.monotonically_increasing_id().alias("item_row"), "item_id", "text"), "items")
    own = stored(numbered.mapInArrow(_item_terms, f"item_row long, item_id {kind}, terms array<binary>, size long"), "item-terms")
    part = F.shiftright("item_row", 33)
    within = F.sum("size").over(Window.partitionBy("part").orderBy("item_row"))
    placed = own.withColumn("part", part).withColumn("within", within)
    # one row per partition of the items
    sums = placed.groupBy("part").agg(F.sum("size").alias("all"))
    before = F.sum("all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    block = F.expr(f"(before + within - size) div {block_terms}")
    return stored(placed.join(starts, "part").select("item_row", "item_id", "terms", "size", block.alias("block")), "item-blocks")


def _block_search(docs: DataFrame, items: list, k: int, chunk_docs: int) -> DataFrame | None:
    """Candidates of one block of items among all documents; None if the documents have no terms."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in items for t in r["terms"]}))}
    kind = dict(docs.dtypes)["doc_id"]
    id_kind = docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    vectors = stored(
        docs.mapInArrow(_vectoriser(vocabulary, id_kind), f"doc_id {kind}, n long, terms binary, tfs binary, stats boolean"), "vectors"
    )
    n_docs, length = vectors.where("not stats and n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    counted = vectors.where("stats").select("terms", "tfs").mapInArrow(_spread, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(vocabulary), np.int64)
    for r in counted.toLocalIterator():
        df[r["term"]] = r["df"]
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    made = Items([r["item_row"] for r in items], [np.array(sorted(vocabulary[bytes(t)] for t in r["terms"]), int) for r in items], weights)
    filled = vectors.where("not stats and octet_length(terms) > 0").select("doc_id", "n", "terms", "tfs")

    def candidates(kth: np.ndarray, seeds: bool) -> DataFrame:
        run = _searcher(made, kth, k, n_docs, length, id_kind, seeds, chunk_docs)
        return filled.mapInArrow(run, f"item_row long, doc_id {kind}, score long")

    best = Window.partitionBy("item_row").orderBy(F.desc("score"))
    seeds = candidates(np.zeros(len(items), np.int64), True).select("item_row", "score")
    floor = seeds.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).where(F.col("rank") == k)
    known = {r["item_row"]: r["score"] for r in floor.select("item_row", "score").collect()}
    return stored(candidates(np.array([known.get(r, 0) for r in made.rows], np.int64), False), "found")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = 1 << 14, chunk_docs: int = 8192) -> DataFrame:
    """The `k` best documents for each item: `item_id`, `rank`, `doc_id`, `score`.

    `docs` has `doc_id` and `text`, `items` has `item_id` and `text`; other columns are not read. Only scores above 0 count; equal
    ones go by ascending `doc_id`, nulls last. Null texts have no terms; repeated rows are documents or items of their own; empty tables
    give no rows.

    Items are taken in blocks of at most `block_terms` terms and those of one item more, whatever their number; each block meets
    all documents. Two passes over the documents' vectors: the first scores one leaf per item and chunk, and the k-th best of those scores over all
    chunks, which no better result can fall below, prunes the second.
    """
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    blocks = _in_blocks(items, block_terms)
    every = None
    for number in [r["block"] for r in blocks.where("size > 0").select("block").distinct().orderBy("block").toLocalIterator()]:
        block = blocks.where(F.col("block") == number).where("size > 0").orderBy("item_row").collect()
        found = _block_search(docs, block, k, chunk_docs)
        if found is not None:
            every = found if every is None else every.unionByName(found)
    if every is None:
        kinds = {**dict(docs.dtypes), **dict(items.dtypes)}
        return docs.sparkSession.createDataFrame([], f"item_id {kinds['item_id']}, rank int, doc_id {kinds['doc_id']}, score long")
    best = Window.partitionBy("item_row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(blocks.select("item_row", "item_id"), "item_row").select("item_id", "rank", "doc_id", "score")
