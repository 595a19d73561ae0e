"""Embedding near-duplicates by Euclidean p-stable hashing and exact cosine checks."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.components import connected
from stationflow.llm.scratch import stored

_SLICE = 2048


def collision(distance: float, width: float) -> float:
    """Chance that one quantised projection is equal for two vectors at `distance`."""
    x = width / distance
    return 1 - math.erfc(x / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


@dataclass(frozen=True)
class Tables:
    """Hash tables for vectors of length 1: `tables` of `projections` each, cells of `width`."""

    dim: int
    tables: int
    projections: int
    width: float
    seed: int

    @classmethod
    def plan(cls, n: int, dim: int, threshold: float, recall: float, crowd: float = 0.2, width: float = 1.5, seed: int = 7) -> Tables:
        """So many projections that a vector meets `crowd` unrelated ones in a table (at right angles to it), and so many
        tables that a pair at the threshold meets with chance `recall` or more."""
        near = collision(math.sqrt(2 - 2 * threshold), width)
        far = collision(math.sqrt(2), width)
        projections = max(1, math.ceil(math.log(max(n, 2) / crowd) / -math.log(far)))
        tables = math.ceil(math.log(1 - recall) / math.log(1 - near**projections))
        return cls(dim, max(1, tables), projections, width, seed)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """The cell of each row in each table, as 32-bit hashes; cells that share a hash only cost an extra check."""
        rng = np.random.default_rng([self.seed, self.dim])
        axes = rng.standard_normal((self.dim, self.tables * self.projections))
        shifts = rng.uniform(0, self.width, self.tables * self.projections)
        odd = rng.integers(0, 1 << 63, self.projections, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        cells = np.floor((unit @ axes + shifts) / self.width).astype(np.int64).view(np.uint64)
        mixed = (cells.reshape(len(unit), self.tables, self.projections) + np.uint64(1 << 20)) * odd
        mixed ^= mixed >> np.uint64(29)
        total = mixed.sum(axis=2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (total >> np.uint64(32)).astype(np.uint32)


def unit_rows(raw: list[bytes]) -> np.ndarray:
    """Vectors of length 1 from stored doubles; scaled first, so that neither large nor small ones overflow."""
    rows = np.stack([np.frombuffer(x, "<f8") for x in raw])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims, vectors = [], []
        for v in batch["embedding"].to_pylist():
            fine = v is not None and len(v) > 0 and all(x is not None for x in v)
            x = np.array(v, np.float64) if fine else None
            fine = fine and bool(np.isfinite(x).all()) and bool(x.any())
            dims.append(len(v) if fine else None)
            vectors.append((x + 0.0).astype("<f8").tobytes() if fine else None)
        yield pa.record_batch(
            [batch["row_id"], batch["vec_id"], pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())],
            ["row_id", "vec_id", "dim", "vector"],
        )


def _hasher(plans: dict[int, Tables]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                some = batch.slice(at, _SLICE)
                dims = some["dim"].to_numpy()
                for dim in np.unique(dims).tolist():
                    own = some.take(pa.array(np.flatnonzero(dims == dim)))
                    keys = plans[dim].keys(unit_rows(own["vector"].to_pylist()))
                    yield pa.record_batch(
                        [own["node"], own["dim"], own["weight"], own["vector"], pa.array([k.tobytes() for k in keys.astype("<u4")], pa.binary())],
                        ["node", "dim", "weight", "vector", "keys"],
                    )

    return run


def _table_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, dim, raw in zip(batch["node"].to_pylist(), batch["dim"].to_pylist(), batch["keys"].to_pylist()):
            keys = np.frombuffer(raw, "<u4").astype(np.int64)
            n = len(keys)
            yield pa.record_batch(
                [pa.array(np.full(n, dim, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(keys), pa.array(np.full(n, node, np.int64))],
                ["dim", "table", "cell", "node"],
            )


class _Cell:
    """Rows of one cell (or of one pair of its blocks): links counted per row, and the least edges that connect them."""

    def __init__(self, table: int, left: int, right: int, threshold: float):
        self.table, self.pair, self.threshold, self.rows = table, (left, right), threshold, []

    def add(self, rows: list[tuple]) -> None:
        self.rows += rows

    def found(self) -> tuple[list[int], np.ndarray, list[tuple[int, int]]]:
        nodes = [r[0] for r in self.rows]
        weights = np.array([r[1] for r in self.rows], np.int64)
        units = unit_rows([r[2] for r in self.rows])
        keys = np.stack([np.frombuffer(r[3], "<u4") for r in self.rows])[:, : self.table]
        blocks = np.array([r[4] for r in self.rows])
        counts, roots = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        step = max(1, (1 << 21) // len(nodes))
        for at in range(0, len(nodes), step):
            part = slice(at, at + step)
            near = units[part] @ units.T >= self.threshold
            near &= np.arange(len(nodes))[None, :] != np.arange(len(nodes))[part, None]
            if self.pair[0] != self.pair[1]:  # pairs within a block have a task of their own
                near &= blocks[part, None] != blocks[None, :]
            one, two = np.nonzero(near)
            roots_of = set(zip(roots[one + at].tolist(), roots[two].tolist()))
            for a, b in roots_of:
                a, b = _root(roots, a), _root(roots, b)
                roots[max(a, b)] = min(a, b)
            roots[:] = [_root(roots, i) for i in range(len(roots))]
            for s in range(0, len(one), 1 << 16):  # a pair counts in the first table in which it meets
                a, b = one[s : s + (1 << 16)] + at, two[s : s + (1 << 16)]
                new = ~(keys[a] == keys[b]).any(axis=1)
                np.add.at(counts, a[new], weights[b[new]])
        edges = [(nodes[i], nodes[r]) for i, r in enumerate(roots.tolist()) if i != r]
        return nodes, counts, edges


def _root(roots: np.ndarray, i: int) -> int:
    while roots[i] != i:
        i = int(roots[i])
    return i


def _linker(threshold: float):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell = None, None

        def closed() -> Iterator[pa.RecordBatch]:
            if cell is not None and len(cell.rows) > 1:
                nodes, counts, edges = cell.found()
                some = [(n, c) for n, c in zip(nodes, counts.tolist()) if c]
                a = [n for n, _ in some] + [e[0] for e in edges]
                b = [None] * len(some) + [e[1] for e in edges]
                n = [c for _, c in some] + [None] * len(edges)
                if a:
                    yield pa.record_batch([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"])

        columns = ("dim", "table", "cell", "left", "right", "node", "weight", "vector", "keys", "block")
        for batch in batches:
            rows: list[tuple] = []
            for dim, table, key, left, right, *row in zip(*(batch[c].to_pylist() for c in columns)):
                this = (dim, table, key, left, right)
                if this != now:
                    if rows:
                        cell.add(rows)
                    yield from closed()
                    now, cell, rows = this, _Cell(table, left, right, threshold), []
                rows.append(tuple(row))
            if rows:
                cell.add(rows)
        yield from closed()

    return link


def near_duplicates(df: DataFrame, threshold: float = 0.95, recall: float = 0.99, block: int = 2048) -> DataFrame:
    """`vec_id`, `n_links`, `component_id` and `kept` per row of `df` (`vec_id`, `embedding`); other columns are not read.

    Two rows are linked when the cosine of their vectors, in doubles, is `threshold` or more; `n_links` counts the
    other rows linked to a row directly, `component_id` is the least `vec_id` that links reach, and a row is `kept` when that is its
    own. Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do vectors of different lengths. Rows with a null `vec_id` count as links and stay; a component of them
    only has a null id and keeps none. Rows of one `vec_id` are rows of their own. An empty table gives no rows.

    Equal vectors are one node with a weight. A pair at the threshold meets in some table with chance `recall`, closer
    ones more likely; every pair that meets is checked exactly, and none below the threshold is linked. Only
    cells that hold two nodes or more fetch vectors. Cells of more than `block` nodes are split, and each pair of blocks
    is a task's group. No pairs leave a task: only counts, and the edges of a spanning forest.
    """
    kind = dict(df.dtypes)["vec_id"]
    rows = stored(
        df.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", "embedding")
        .mapInArrow(_usable, f"row_id long, vec_id {kind}, dim int, vector binary"),
        "vectors",
    )
    distinct = stored(
        rows.where("vector is not null").groupBy("dim", "vector").agg(
            F.min("row_id").alias("node"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least")
        ),
        "distinct-vectors",
    )
    sizes = distinct.groupBy("dim").count().collect()  # one row per vector length
    plans = {r["dim"]: Tables.plan(r["count"], r["dim"], threshold, recall) for r in sizes}
    hashed = stored(
        distinct.select("node", "dim", "weight", "vector").mapInArrow(
            _hasher(plans), "node long, dim int, weight long, vector binary, keys binary"
        ),
        "hashed-vectors",
    )
    cells = stored(
        hashed.select("node", "dim", "keys").mapInArrow(_table_rows, "dim int, table int, cell long, node long"), "cells"
    )
    cell = ["dim", "table", "cell"]
    shared = cells.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = cells.join(shared.select(*cell, blocks.alias("blocks")), cell).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    other = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = other.select(*cell, "node", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    key = [*cell, "left", "right"]
    found = stored(
        pairs.join(hashed.select("node", "weight", "vector", "keys"), "node")
        .repartition(*key).sortWithinPartitions(*key)
        .select(*key, "node", "weight", "vector", "keys", "block")
        .mapInArrow(_linker(threshold), "a long, b long, n long"),
        "links",
    )
    counts = found.where("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    members = connected(found.where("b is not null"))
    nodes = distinct.join(members, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    known = (
        nodes.join(ids, "component").join(counts, "node", "left")
        .select("dim", "vector", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    )
    linked = rows.join(stored(known, "components"), ["dim", "vector"], "left")
    component = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return linked.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
