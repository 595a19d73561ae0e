"""Exact top-k inner products, pruned by segment means and deviations from coarse to fine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationflow.llm.scratch import stored

_SEEDS = 64
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def _levels(dim: int) -> list[np.ndarray]:
    """Segment starts from one segment to segments of about four components."""
    out, n = [], 1
    while n == 1 or dim // n >= 4:
        out.append(np.unique(np.linspace(0, dim, n, endpoint=False).astype(int)))
        n *= 4
    return out


def _profiles(rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and segment: mean and deviation, scaled by the root of the length so that they compare as plain distances."""
    lengths = np.diff(np.append(starts, rows.shape[1])).astype(float)
    mean = np.add.reduceat(rows, starts, axis=1) / lengths
    square = np.add.reduceat(rows * rows, starts, axis=1) / lengths
    root = np.sqrt(lengths)
    return mean * root, np.sqrt(np.maximum(square - mean * mean, 0)) * root


def _scores(rows: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; beyond the range where doubles are exact, in Python integers cut off to longs."""
    if exact:
        return (rows @ query).astype(np.int64)
    whole = [int(x) for x in query]
    sums = (sum(int(a) * b for a, b in zip(row, whole)) for row in rows)
    return np.array([max(-_LONG - 1, min(_LONG, s)) for s in sums], np.int64)


def nearest(ids: np.ndarray, rows: np.ndarray, own: np.ndarray, query: np.ndarray, query_row: int, levels: list, k: int):
    """Indices and scores of the `k` best rows for one query; `levels` has starts and the rows' profiles.

    Score s and squared distance d fit s = (|q|^2 + |x|^2 - d) / 2. Differences
    of means and deviations bound d from below, at each level more tightly; a row
    goes when even this bound gives less than the k-th best score so far.
    """
    norms = own
    q_norm = float(query @ query)
    alive = np.flatnonzero(ids != query_row)
    exact = np.sqrt(q_norm * float(norms.max(initial=0))) < _EXACT / 4
    best, scores, first = np.empty(0, int), np.empty(0, np.int64), True
    for starts, means, deviations in levels:
        q_mean, q_dev = _profiles(query[None, :], starts)
        gap = ((means[alive] - q_mean) ** 2).sum(axis=1) + ((deviations[alive] - q_dev) ** 2).sum(axis=1)
        most = (q_norm + norms[alive] - gap) / 2
        slack = 1e-9 * (q_norm + norms[alive]) + 1
        if first and len(alive) > k:
            best = alive[np.argpartition(-most, min(_SEEDS, len(alive) - 1))[: max(k, _SEEDS)]]
            scores, first = _scores(rows[best], query, exact), False
        if len(best) >= k and len(alive) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            alive = alive[most + slack >= float(kth) - 1e-9 * abs(float(kth))]
    return alive, _scores(rows[alive], query, exact)


def _searcher(k: int):
    kinds = pa.schema([("query", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if queries.num_rows and rows.num_rows:
            matrix = np.stack([np.frombuffer(x.as_buffer(), "<f8") for x in rows["vector"].combine_chunks()])
            row_ids, vec_ids = rows["row_id"].to_numpy(), rows["vec_id"].to_pandas().astype("Int64")
            order_key = vec_ids.fillna(_LONG).to_numpy(np.int64)
            none = vec_ids.isna().to_numpy()
            norms = (matrix * matrix).sum(axis=1)
            levels = [(s, *_profiles(matrix, s)) for s in _levels(matrix.shape[1])] if matrix.shape[1] else []
            for query_row, vector in zip(queries["row_id"].to_pylist(), queries["vector"]):
                query = np.frombuffer(vector.as_buffer(), "<f8")
                at, scores = nearest(row_ids, matrix, norms, query, query_row, levels, k)
                top = np.lexsort((row_ids[at], order_key[at], none[at], -scores))[:k]
                found += [(query_row, int(row_ids[i]), None if none[i] else int(order_key[i]), int(s)) for i, s in zip(at[top], scores[top])]
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*found) if found else [[]] * 4, kinds)], schema=kinds)

    return search


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, vectors, dims = [], [], []
        for i, v in enumerate(batch["embedding"].to_pylist()):
            if v is None or any(x is None for x in v):
                continue
            x = np.floor(256 * np.array(v, np.float64)) + 0.0
            if np.isfinite(x).all():
                rows.append(i)
                vectors.append(x.astype("<f8").tobytes())
                dims.append(len(v))
        at = pa.array(rows, pa.int32())
        yield pa.record_batch(
            [batch["row_id"].take(at), batch["vec_id"].take(at), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())],
            ["row_id", "vec_id", "dim", "vector"],
        )


def top_k(df: DataFrame, every: int = 50, k: int = 5, query_block: int = 2048, row_block: int = 8192) -> DataFrame:
    """The `k` highest scores of each row of `df` whose `vec_id` is divisible by `every`, against all other rows.

    Gives `query_id`, `rank`, `vec_id`, `score`; ties go to the smaller `vec_id` (nulls last), then to the earlier row. A vector's
    components become floor(256 x); the score is the integer inner product. Vectors that are null or hold null or non-finite components
    take no part, nor do rows without a `vec_id` as queries; vectors are compared with those of their length. Rows of one
    `vec_id` are rows of their own. An empty table gives no rows.

    Queries and rows are dealt to blocks; a task searches one block of rows for one block of
    queries, and the best of each are ranked per query.
    """
    vectors = stored(
        df.select(F.monotonically_increasing_id().alias("row_id"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .mapInArrow(_vectors, "row_id long, vec_id long, dim int, vector binary"),
        "vectors",
    )
    asked = vectors.where(F.col("vec_id") % every == 0)
    n_rows, n_queries = vectors.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n_rows // row_block)), max(1, -(-n_queries // query_block))
    mine = lambda n: F.pmod(F.xxhash64("row_id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = asked.select("row_id", "dim", "vector", mine(query_blocks).alias("qb")).select("*", each(row_blocks).alias("rb"))
    rows = vectors.select("row_id", "vec_id", "dim", "vector", mine(row_blocks).alias("rb")).select("*", each(query_blocks).alias("qb"))
    keys = ["dim", "qb", "rb"]
    found = queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(
        _searcher(k), "query long, row long, vec_id long, score long"
    )
    best = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = asked.select(F.col("row_id").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "query").select("query_id", "rank", "vec_id", "score")
