"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.scratch import stored


def _least(pairs: DataFrame) -> DataFrame:
    """Per node `u`, the least of itself and its neighbours `v`; partial sums make a hub cheap."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = _least(down)
    linked = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """One row per node of `edges` (long columns `a` and `b`): `node` and the least node it reaches, `component`.

    Each round is two joins on a node; hubs are split by the skew join. The
    rounds grow with the logarithm of the longest path. Loops, repeated edges and
    null ends are ignored; no edges give no rows.
    """
    now = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        sign = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if sign == before or not sign[0]:
            break
        before = sign
        stars = _small_star(_large_star(now)).where("a <> b").distinct()
        now = stored(stars, "edges")
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
