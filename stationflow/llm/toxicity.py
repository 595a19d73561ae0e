"""Toxicity: non-negative positive-unlabelled learning on confirmed toxic and unlabelled documents."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"\w+")
_SLICE = 256
_BITS = 20
_CACHED_WORDS = 100_000


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept apart from training; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-case word: the word itself and its beginnings, so that inflected forms share some."""
    marked = f"<{word}>"
    grams = {marked, *(marked[: n + 1] for n in (3, 4, 5, 6) if n <= len(word))}
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) & ((1 << _BITS) - 1) for g in grams]


def text_features(text: str | None) -> np.ndarray:
    """Distinct features of a whole text."""
    found: set[int] = set()
    for word in set(_WORD.findall((text or "").lower())):
        found.update(word_features(word))
    return np.fromiter(sorted(found), np.int32, len(found))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Rows:
    """Documents as sparse rows over the chosen features."""

    def __init__(self, docs: list[np.ndarray], place: np.ndarray):
        columns = [c[c >= 0] for c in (place[d] for d in docs)]
        self.n = len(docs)
        self.columns = np.concatenate([np.empty(0, np.int64), *columns])
        self.rows = np.repeat(np.arange(self.n), [len(c) for c in columns])

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.n) + bias

    def gradient(self, slopes: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.columns, slopes[self.rows], n)


def fit_linear(
    toxic: _Rows, unlabelled: _Rows, n: int, prior: float, epochs: int, rate: float = 0.05, sparsity: float = 0.05
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with logistic loss.

    The risk of the negative class is that of the unlabelled rows less `prior`
    times that of the toxic rows taken as negative. Where it falls below zero, a step goes
    against it instead, so that unlabelled toxic rows are not learnt as clean ones.
    """
    weights, bias = np.zeros(n), 0.0
    first, second, tiny = np.zeros(n + 1), np.zeros(n + 1), 1e-8
    for step in range(1, epochs + 1):
        zt, zu = toxic.scores(weights, bias), unlabelled.scores(weights, bias)
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zt).mean()
        on_toxic, on_unlabelled = -prior * _sigmoid(zt) / toxic.n, _sigmoid(zu) / unlabelled.n
        if negative_risk >= 0:
            on_toxic = on_toxic - prior * _sigmoid(-zt) / toxic.n
        else:
            on_toxic, on_unlabelled = -on_toxic, -on_unlabelled
        slope = np.append(
            toxic.gradient(on_toxic, n) + unlabelled.gradient(on_unlabelled, n), on_toxic.sum() + on_unlabelled.sum()
        )
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + tiny)
        weights, bias = weights - move[:-1], bias - float(move[-1])
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * sparsity, 0)
    return weights, bias


@dataclass(frozen=True)
class Model:
    """Linear classifiers over the same features; a score is the mean of theirs."""

    features: np.ndarray
    weights: np.ndarray
    biases: np.ndarray

    def scores(self, texts: list[str | None], cache: dict[str, tuple[int, ...]]) -> np.ndarray:
        """Between 0 and 1 per text, null counting as empty; `cache` keeps words' chosen features."""
        place = {int(f): i for i, f in enumerate(self.features)}
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            found: set[int] = set()
            for word in set(_WORD.findall((text or "").lower())):
                own = cache.get(word)
                if own is None:
                    own = tuple(place[f] for f in word_features(word) if f in place)
                    if len(cache) < _CACHED_WORDS:
                        cache[word] = own
                if own:
                    found.update(own)
            sums = self.biases + (self.weights[:, sorted(found)].sum(axis=1) if found else 0.0)
            out[i] = float(_sigmoid(sums).mean())
        return out

    def score(self, text: Column) -> Column:
        """The score of a text column, batch by batch."""

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            cache: dict[str, tuple[int, ...]] = {}
            for texts in batches:
                parts = [self.scores(texts.iloc[at : at + _SLICE].tolist(), cache) for at in range(0, len(texts), _SLICE)]
                yield pd.Series(np.concatenate([np.empty(0), *parts]))
            pa.default_memory_pool().release_unused()

        return run(text)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            some = batch.slice(at, _SLICE)
            found = [text_features(t) for t in some["text"].to_pylist()]
            yield pa.record_batch([pa.array(found, pa.list_(pa.int32()))], ["features"])


def _features(docs: DataFrame, ids: DataFrame) -> list[np.ndarray]:
    """Features of the documents of `ids`, a table whose length a parameter bounds; one text per id."""
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    table = texts.select("text").mapInArrow(_featurise, "features array<int>").toArrow()
    return [np.asarray(x.values) for x in table["features"]]


def fit(
    docs: DataFrame, labels: DataFrame, max_toxic: int = 2000, max_unlabelled: int = 6000, models: int = 3, epochs: int = 300
) -> Model:
    """Classifiers learnt from `docs` (`doc_id`, `text`) and `labels` (`doc_id`, `toxic`), none of them held out.

    The sample is bounded: the `max_toxic` confirmed toxic and `max_unlabelled` arbitrary documents whose
    ids hash lowest. The class prior is the toxic share of all labelled documents. A feature is
    chosen when the toxic documents have it more often than the others by two standard errors. Each model
    gets its own share of the unlabelled documents. Without toxic documents every score is 0.

    Of repeated ids the least text is learnt; a document is toxic if any of its labels says so; null ids
    and labels are left out.
    """
    known = labels.where(~held_out()).where("doc_id is not null and toxic is not null")
    by_doc = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, n_toxic = by_doc.agg(F.count(F.lit(1)), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0))).first()
    hashed = F.xxhash64("doc_id")
    toxic_ids = by_doc.where("toxic = 1").select("doc_id").orderBy(hashed, "doc_id").limit(max_toxic)
    ids = docs.where(~held_out()).where("doc_id is not null").select("doc_id").distinct()
    toxic = _features(docs, toxic_ids)
    unlabelled = _features(docs, ids.orderBy(hashed, "doc_id").limit(max_unlabelled))
    if not toxic or not unlabelled:
        return Model(np.empty(0, np.int64), np.zeros((1, 0)), np.array([-1000.0]))
    size = 1 << _BITS
    often, rest = (np.bincount(np.concatenate([np.empty(0, np.int32), *d]), minlength=size) for d in (toxic, unlabelled))
    a, b = often / len(toxic), rest / len(unlabelled)
    error = np.sqrt((a * (1 - a)) / len(toxic) + (b * (1 - b)) / len(unlabelled)) + 1e-12
    chosen = np.flatnonzero((often >= min(3, len(toxic))) & (a - b > 2 * error))
    place = np.full(size, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    models = min(models, len(unlabelled))
    toxic_rows = _Rows(toxic, place)
    fitted = [
        fit_linear(toxic_rows, _Rows(unlabelled[i::models], place), len(chosen), n_toxic / n, epochs) for i in range(models)
    ]
    return Model(chosen, np.stack([w for w, _ in fitted]), np.array([b for _, b in fitted]))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` for every row of `docs`, by the text alone.

    Every whole text is scored, null as empty; repeated rows are scored each; a null id is not held out; an
    empty table gives no rows; other columns are not read.
    """
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    scored = docs.select("doc_id", held_out().alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the classifiers do not call toxic, with all their columns."""
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    return docs.where(model.score(F.col("text")) < 0.5)
