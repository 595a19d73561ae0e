"""Quality rules: fixed counts, and logistic regression over hashed word and character n-grams, calibrated."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.toxicity import held_out

#: Buckets of each family: words, characters within words, pairs of words.
_BITS = 16
_SIZE = 1 << _BITS
FAMILIES = 3
_SLICE = 256
_PIECE = 1 << 18
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Odd multipliers; a bucket is the upper bits of a product.
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _bucket(mixed: np.ndarray, family: int) -> np.ndarray:
    return (((mixed ^ (mixed >> np.uint64(29))) * _ODD[0]) >> np.uint64(64 - _BITS)).astype(np.int64) + family * _SIZE


@dataclass(frozen=True)
class Words:
    """The words of a text: the number of each among the distinct ones, and a hash of each of those."""

    joined: bytes
    numbers: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, data: bytes) -> Words:
        words = data.split()
        places = {w: i for i, w in enumerate(dict.fromkeys(words))}
        hashes = np.fromiter(map(zlib.crc32, places), np.uint64, len(places))
        return cls(b" ".join(words), np.fromiter(map(places.__getitem__, words), np.int64, len(words)), hashes)

    def units(self) -> np.ndarray:
        """Buckets of the words, repeats included."""
        return _bucket(self.hashes, 0)[self.numbers]

    def pairs(self) -> np.ndarray:
        """Buckets of the pairs of neighbouring words."""
        own = self.hashes[self.numbers]
        return _bucket(own[:-1] * _ODD[1] + own[1:] * _ODD[2], 2)

    def grams(self) -> Iterator[np.ndarray]:
        """Buckets of the grams of 2 to 4 characters of each word between spaces, repeats included, a piece at a time."""
        if not len(self.numbers):
            return
        text = f" {self.joined.decode('utf-8', 'surrogatepass')} "
        for at in range(0, len(text), _PIECE):
            codes = np.frombuffer(text[at : at + _PIECE + 3].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
            inner = codes != 32
            mixed, whole = codes * _ODD[0], np.ones(len(codes), bool)
            for n in (2, 3, 4):
                if len(codes) < n:
                    break
                mixed = mixed[:-1] + codes[n - 1 :] * _ODD[n - 1]
                whole = whole[:-1] if n == 2 else whole[:-1] & inner[n - 2 : -1]
                yield _bucket(mixed[:_PIECE][whole[:_PIECE]] + np.uint64(n), 1)

    def logit(self, weights: np.ndarray) -> float:
        """What the words, their grams and their pairs weigh, on average of each."""
        n = len(self.numbers)
        if not n:
            return 0.0
        parts = [(float(weights[g].sum()), len(g)) for g in self.grams()]
        total = float(weights[self.units()].mean()) + sum(p for p, _ in parts) / sum(k for _, k in parts)
        return total + (float(weights[self.pairs()].mean()) if n > 1 else 0.0)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and values, so that `logit` is their product with the weights."""
        buckets, values = [np.empty(0, np.int64)], [np.empty(0)]
        for found in ([self.units()], self.grams(), [self.pairs()] if len(self.numbers) > 1 else []):
            own, often = np.unique(np.concatenate([np.empty(0, np.int64), *found]), return_counts=True)
            buckets.append(own)
            values.append(often / max(1, often.sum()))
        return np.concatenate(buckets).astype(np.int32), np.concatenate(values).astype(np.float32)


def repeated_words(numbers: np.ndarray) -> int:
    """How many words, given by numbers below their count, lie in 3-word windows that occur twice or more."""
    if len(numbers) < 4:
        return 0
    k = int(numbers.max()) + 1
    codes = numbers[:-1] * k + numbers[1:]
    if k > 2_000_000:
        _, codes = np.unique(codes, return_inverse=True)
    codes = codes[:-1] * k + numbers[2:]
    order = np.argsort(codes, kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    twice = np.zeros(len(codes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(numbers), bool)
    for i in range(3):
        inside[i : i + len(codes)] |= twice
    return int(inside.sum())


def counts(data: bytes, words: Words) -> tuple[int, int, int, int, int]:
    """`n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words` of a text in UTF-8 and its words."""
    inked = data.translate(None, _BLANKS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words.numbers),
        len(inked.decode("utf-8", "surrogatepass")),
        len(data) - len(data.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words.numbers),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Rows:
    """Texts as sparse rows."""

    def __init__(self, buckets: list[np.ndarray], values: list[np.ndarray]):
        self.starts = np.concatenate([[0], np.cumsum([len(b) for b in buckets])]).astype(np.int64)
        self.columns = np.concatenate([np.empty(0, np.int32), *buckets])
        self.values = np.concatenate([np.empty(0, np.float32), *values])

    def some(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = self.starts[rows + 1] - self.starts[rows]
        at = np.repeat(self.starts[rows] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        return np.repeat(np.arange(len(rows)), lengths), self.columns[at], self.values[at]


def fit_logistic(
    rows: _Rows, y: np.ndarray, pick: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.05, decay: float = 1e-4, min_rows: int = 10
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on the rows of `pick`, both classes weighing the same.

    Buckets that fewer than `min_rows` of the rows have stay at zero.
    """
    n = FAMILIES * _SIZE
    _, columns, _ = rows.some(pick)
    often = np.bincount(columns, minlength=n) >= min(min_rows, max(1, len(pick) // 20))
    share = np.array([max(1e-9, (y[pick] == c).mean()) for c in (0, 1)])
    weights, bias, first, second = np.zeros(n), 0.0, np.zeros(n + 1), np.zeros(n + 1)
    rng, step = np.random.default_rng(0), 0
    for _ in range(epochs):
        order = rng.permutation(pick)
        for at in range(0, len(order), batch):
            some, step = order[at : at + batch], step + 1
            r, c, v = rows.some(some)
            z = np.bincount(r, weights[c] * v, len(some)) + bias
            slope = (_sigmoid(z) - y[some]) / share[y[some]] / 2 / len(some)
            gradient = np.append(np.bincount(c, slope[r] * v, n) * often + decay * weights, slope.sum())
            first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
            move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
            weights, bias = weights - move[:-1], bias - float(move[-1])
    return weights, bias


def calibrate(logits: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset by which logits become probabilities: weighted logistic fit by Newton steps, targets smoothed."""
    ones, zeros = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x, theta = np.stack([logits, np.ones(len(logits))], axis=1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = _sigmoid(x @ theta)
        gradient = x.T @ (weight * (p - target)) + 1e-6 * theta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(theta[0]), float(theta[1])


@dataclass(frozen=True)
class Model:
    """A calibrated linear classifier; `probability` is that of good quality."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def rows(self, texts: list[str | None]) -> list[tuple]:
        """Counts and probability of each text, null as empty."""
        out = []
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass")
            words = Words.of(data)
            z = self.slope * (words.logit(self.weights) + self.bias) + self.offset
            out.append((*counts(data, words), 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))))
        return out

    def measures(self, text: Column) -> Column:
        """Counts and probability of a text column as a struct, batch by batch."""
        fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "probability"]

        @F.pandas_udf(", ".join(f"{f} long" for f in fields[:-1]) + ", probability double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                made = [r for at in range(0, len(texts), _SLICE) for r in self.rows(texts.iloc[at : at + _SLICE].tolist())]
                yield pd.DataFrame(made, columns=fields).astype({f: "int64" for f in fields[:-1]} | {"probability": "float64"})
            pa.default_memory_pool().release_unused()

        return run(text)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            some = batch.slice(at, 64)
            found = [Words.of((t or "").encode("utf-8", "surrogatepass")).features() for t in some["text"].to_pylist()]
            lists = [pa.array([f[i] for f in found], pa.list_(kind)) for i, kind in ((0, pa.int32()), (1, pa.float32()))]
            yield pa.record_batch([some["quality"], some["calibrate"], *lists], ["quality", "calibrate", "buckets", "vals"])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 2000) -> Model:
    """A classifier learnt from `docs` (`doc_id`, `text`) and `labels` (`doc_id`, `quality`), none of them held out.

    The sample is bounded: of each class the `max_rows` documents whose ids hash
    lowest, whole texts. A quarter of it, by the hash, is kept for calibration, where each class weighs as
    much as it does among all labelled documents. Of repeated ids the least text is learnt, and the
    lesser of their labels; null ids and labels are left out. With fewer than two classes every
    probability is that of the only one, or 1 without labels.
    """
    known = labels.where(~held_out()).where("doc_id is not null and quality is not null")
    by_doc = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    ids = docs.select("doc_id").where("doc_id is not null").distinct().join(by_doc, "doc_id")
    seen = {r["quality"]: r["n"] for r in ids.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not (seen.get(0) and seen.get(1)):
        return Model(np.zeros(FAMILIES * _SIZE), 0.0, 1.0, -30.0 if seen.get(0) else 30.0)
    hashed = F.xxhash64("doc_id")
    chosen = [ids.where(F.col("quality") == c).orderBy(hashed, "doc_id").limit(max_rows) for c in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    split = (F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) == 0).alias("calibrate")
    table = texts.orderBy(hashed, "doc_id").select("quality", split, "text").mapInArrow(
        _featurise, "quality int, calibrate boolean, buckets array<int>, vals array<float>"
    ).toArrow()
    y, apart = table["quality"].to_numpy().astype(int), table["calibrate"].to_numpy().astype(bool)
    rows = _Rows([np.asarray(x.values) for x in table["buckets"]], [np.asarray(x.values) for x in table["vals"]])
    weights, bias = fit_logistic(rows, y, np.flatnonzero(~apart))
    check = np.flatnonzero(apart)
    if len(np.unique(y[check])) < 2:
        check = np.arange(len(y))
    r, c, v = rows.some(check)
    logits = np.bincount(r, weights[c] * v, len(check)) + bias
    of_class = np.array([seen[c] / (y[check] == c).sum() for c in (0, 1)])
    weight = of_class[y[check]] * len(check) / sum(seen.values())
    return Model(weights, bias, *calibrate(logits, y[check], weight))


def _judged(measures: Column, min_words: int, max_repeated: int, min_probability: float) -> tuple[Column, Column]:
    n, repeated = measures["n_words"], measures["n_repeat_words"]
    failed = (n < min_words) | (100 * repeated > max_repeated * n)
    return failed, ~failed & (measures["probability"] >= min_probability)


def quality_report(
    docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeated: int = 50, min_probability: float = 0.5
) -> DataFrame:
    """`doc_id`, counts, `base_failed`, `kept` and `probability` for every row of `docs`, by the text alone.

    A document fails the base rules with fewer than `min_words` words or when more than `max_repeated` per cent of
    them lie in 3-word windows that occur twice; others are kept when the classifier gives good quality
    `min_probability` or more. Null texts count as empty; repeated rows are judged each; an empty table gives no
    rows; other columns are not read.
    """
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    found = docs.select("doc_id", model.measures(F.col("text")).alias("m"))
    failed, kept = _judged(F.col("m"), min_words, max_repeated, min_probability)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(
        "doc_id", *[F.col("m").getField(c).alias(c) for c in names], failed.alias("base_failed"), kept.alias("kept"),
        F.col("m.probability").alias("probability"),
    )


def of_quality(
    df: DataFrame, labels: DataFrame, min_words: int = 50, max_repeated: int = 50, min_probability: float = 0.5
) -> DataFrame:
    """The rows of `df` that `quality_report` keeps, with all their columns."""
    model = fit(df.select("doc_id", "text"), labels.select("doc_id", "quality"))
    _, kept = _judged(F.col("measures"), min_words, max_repeated, min_probability)
    rows = df.select(F.struct("*").alias("row"), model.measures(F.col("text")).alias("measures"))
    return rows.where(kept).select("row.*")
