"""Merkle manifest of a table: trees of eight, and a path-copying version of them for every changed row.

A tree is kept in aligned blocks of three levels. A version of a changed leaf shares all nodes but its
ancestors: those in its block are copied there, and the levels above go on from the block's root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stationflow.llm.scratch import stored
from stationflow.llm.workers import tidy

FANOUT, LEVELS = 8, 3
BLOCK = FANOUT**LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = "top"


def digest(parts: Sequence[bytes]) -> bytes:
    """Hex sha256 of the concatenated parts."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def leaf_of(columns: Sequence[Column]) -> Column:
    """Hex sha256 of a row: each value as UTF-8 byte count, `:` and text, null as `-`."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


@dataclass
class Block:
    """The nodes of one block, level by level from its leaves; `total` leaves stand at its lowest level in the whole tree."""

    leaves: list[bytes]
    total: int
    levels: list[list[bytes]] = field(init=False)

    def __post_init__(self) -> None:
        self.levels, left = [self.leaves], self.total
        while left > 1 and len(self.levels) <= LEVELS:
            last = self.levels[-1]
            self.levels.append([digest(last[i : i + FANOUT]) for i in range(0, len(last), FANOUT)])
            left = -(-left // FANOUT)

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, index: int) -> list[tuple[bytes, bytes]]:
        """Digests left and right of the path of a leaf, from its level to the one below the block's root."""
        out = []
        for nodes in self.levels[:-1]:
            first = index - index % FANOUT
            out.append((b"".join(nodes[first:index]), b"".join(nodes[index + 1 : first + FANOUT])))
            index //= FANOUT
        return out


def copied_path(leaf: bytes, path: Sequence[tuple[bytes, bytes]]) -> list[bytes]:
    """The nodes that a version with another leaf does not share: the leaf and its ancestors up to the root."""
    copies = [leaf]
    for left, right in path:
        copies.append(digest((left, copies[-1], right)))
    return copies


def _hex(value: bytes | None) -> bytes | None:
    return None if value is None else value.hex().encode()


def _raw(text: bytes) -> bytes:
    return bytes.fromhex(text.decode())


def _placed(nodes: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """`nodes` with their place `pos` within `tree`, in `order`, and the `total` of their tree.

    Rows are dealt by range over `tree` and `order`, so a tree of any size spreads; a place is that in the
    range plus the tree's rows in ranges before.
    """
    keys = ["tree", *order]
    at = F.monotonically_increasing_id()
    dealt = stored(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", at), name)
    part = F.shiftright("at", 33).alias("part")
    sizes = dealt.groupBy("tree", part).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(
        "tree", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(tree).alias("total")
    )
    joined = dealt.withColumn("part", F.shiftright("at", 33)).join(starts, ["tree", "part"])
    return joined.withColumn("pos", F.col("before") + F.col("at") - F.col("first")).drop("at", "part", "first", "before")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            some = batch.slice(at, 16)
            roots = [
                _raw(Block([_hex(n["digest"]) for n in nodes], total).root)
                for nodes, total in zip(some["nodes"].to_pylist(), some["total"].to_pylist())
            ]
            yield pa.record_batch([*some.columns, pa.array(roots, pa.binary())], [*some.schema.names, "root"])


def _blocks(placed: DataFrame, extra: Sequence[str], name: str) -> DataFrame:
    """One row per block: `tree`, `pos` of its root, `total`, its `nodes` in order and its `root`."""
    node = F.struct("pos", "digest", *extra)
    grouped = placed.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block"), "total").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    grouped = grouped.withColumnRenamed("block", "pos")
    kinds = ", ".join(f"{c} {t}" for c, t in grouped.dtypes)
    return stored(grouped.mapInArrow(tidy(_fold), f"{kinds}, root binary"), name)


def _upper(blocks: DataFrame) -> DataFrame:
    total = F.expr(f"(total + {BLOCK - 1}) div {BLOCK}")
    return blocks.select("tree", "pos", F.col("root").alias("digest"), total.alias("total"))


def _stages(placed: DataFrame, extra: Sequence[str]) -> list[DataFrame]:
    """The blocks of all trees, from those over leaves up to those that hold roots."""
    most = placed.agg(F.max("total")).first()[0] or 1
    stages = [_blocks(placed, extra, "merkle-leaves")]
    while most > BLOCK:
        stages.append(_blocks(_upper(stages[-1]), [], "merkle-nodes"))
        most = -(-most // BLOCK)
    return stages


@dataclass(frozen=True)
class Manifest:
    """Blocks of the trees of all partitions, stage by stage, of the tree over their roots, and the names of the partitions."""

    trees: list[DataFrame]
    top: list[DataFrame]
    key: str

    def subroots(self) -> DataFrame:
        """`tree` and `digest` of each partition's root."""
        return self.trees[-1].select("tree", F.col("root").alias("digest"))


def build(
    df: DataFrame, by: str = "lang", key: str = "doc_id", columns: Sequence[str] = COLUMNS,
    changed: Column | None = None, altered: dict[str, Column] | None = None,
) -> Manifest:
    """Trees over the rows of `df`: one per value of `by`, their leaves in ascending `key`, and one over their roots.

    `altered` gives columns new values in the rows that `changed` holds for (null: it does not); their leaves are kept
    beside the first ones. Nulls come first, in `by` and in `key`; rows of one key are ordered by their leaves.
    Columns that aren't named are not read. An empty table has no trees.
    """
    altered = altered or {}
    new = F.when(F.lit(False) if changed is None else changed, F.unhex(leaf_of([altered.get(c, F.col(c)) for c in columns])))
    tree = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")).alias("tree")
    leaves = df.select(tree, F.col(key).alias("key"), F.unhex(leaf_of([F.col(c) for c in columns])).alias("digest"), new.alias("new"))
    trees = _stages(_placed(leaves, ["key", "digest"], "merkle-order"), ["key", "new"])
    roots = trees[-1].select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    return Manifest(trees, _stages(_placed(roots, ["name"], "merkle-roots"), ["name"]), key)


def _downward(blocks: DataFrame, above: DataFrame | None, each: Callable, kinds: str) -> DataFrame:
    """`each(tree, node, index, path, subroot, root)` for every node of `blocks`, where `above` has what is over the blocks' roots."""
    schema = to_arrow_schema(StructType.fromDDL(kinds))
    if above is None:
        none = F.array().cast("array<binary>")
        over = blocks.withColumn("lefts", none).withColumn("rights", none).withColumn("top_root", F.col("root"))
        over = over.withColumn("subroot", F.lit(None).cast("binary"))
    else:
        over = blocks.join(above, ["tree", "pos"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block([_hex(n["digest"]) for n in row["nodes"]], row["total"])
                higher = list(zip(row["lefts"], row["rights"]))
                made = [each(row, n, block.siblings(i) + higher) for i, n in enumerate(row["nodes"])]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    return over.mapInArrow(run, kinds)


def _path_row(row: dict, node: dict, path: list) -> tuple:
    lefts, rights = [left for left, _ in path], [right for _, right in path]
    return row["tree"], node["pos"], lefts, rights, row["subroot"], row["top_root"]


def _top_row(row: dict, node: dict, path: list) -> tuple:
    lefts, rights = [left for left, _ in path], [right for _, right in path]
    return node.get("name", row["tree"]), 0 if "name" in node else node["pos"], lefts, rights, node["digest"], row["top_root"]


_PATH = "tree string, pos long, lefts array<binary>, rights array<binary>, subroot binary, top_root binary"


def _above_leaves(manifest: Manifest) -> DataFrame:
    """What lies over the root of each block of leaves: digests left and right of its path, `subroot` and `top_root`."""
    above = None
    for blocks in reversed(manifest.top):
        above = stored(_downward(blocks, above, _top_row, _PATH), "merkle-paths")
    for blocks in reversed(manifest.trees[1:]):
        above = stored(_downward(blocks, above, _path_row, _PATH), "merkle-paths")
    return above


def versions(manifest: Manifest) -> DataFrame:
    """For every leaf its `key`, `leaf`, `subroot`, `root`, `proof` and the `copied` nodes of its version.

    `proof` is the digest of all siblings of its path, level by level up to the root, left to right. `copied` are the nodes, from the leaf
    to the version's root, that differ from the first tree where the leaf was changed, else those of the first tree itself.
    """
    kind = dict(manifest.trees[0].select("nodes.key").dtypes)["key"].removeprefix("array<").removesuffix(">")

    def each(row: dict, node: dict, path: list) -> tuple:
        leaf = _hex(node["digest"])
        proof = digest([side for pair in path for side in pair])
        copies = copied_path(leaf if node["new"] is None else _hex(node["new"]), path)
        texts = leaf, row["subroot"].hex(), row["top_root"].hex(), proof
        return (node["key"], *(t if isinstance(t, str) else t.decode() for t in texts), node["new"] is not None, [c.decode() for c in copies])

    kinds = f"key {kind}, leaf string, subroot string, root string, proof string, changed boolean, copied array<string>"
    return _downward(manifest.trees[0], _above_leaves(manifest), each, kinds)


def manifest_report(df: DataFrame) -> DataFrame:
    """Per row of `df`: `doc_id`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root` and `verified`.

    One document in three, by the checksum of its id, is tampered with: A-Z of its text become lower case. Its version's
    root stands in `folded_root`; for the others, and where nothing changes by that, it is the first root. A null `doc_id` is never
    tampered with; repeated rows are leaves of their own; an empty table gives no rows.
    """
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = versions(build(df, changed=tampered, altered={"text": F.translate("text", UPPER, LOWER)}))
    folded = F.element_at("copied", -1)
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )
