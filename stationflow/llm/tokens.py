"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words per Python worker."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

#: Fixed value: the splitting rule of the files whose words can be taken one by one.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same rule within ASCII and the letters of Latin-1, where a letter has one form and one lower case.
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\r\x0b\x0ca-z0-9ß-öø-ÿ]+")
#: What such a text may not hold: other characters, separators that only some call white space, special tokens.
_OTHER = r"[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]|<\|"
_ASKED = 100
_SLICE_BYTES = 4 << 20

_loaded: dict[tuple[str, int], "WordTokenizer"] = {}


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """`batch` in slices of a few megabytes of text, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy().astype(np.int64)
    block = np.cumsum(sizes) // _SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def id_column(raw: bytes, lengths: np.ndarray) -> pa.Array:
    """A binary column of `lengths` 32-bit ids each, over the bytes of all of them."""
    offsets = np.concatenate([[0], 4 * np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def ids_in(column: pa.Array) -> np.ndarray:
    """The ids of all rows of such a column, in a row."""
    if not len(column):
        return np.empty(0, "<u4")
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    start, end = int(edges[0]), int(edges[-1])
    return np.frombuffer(data, "<u4", (end - start) // 4, start) if end > start else np.empty(0, "<u4")


class WordTokenizer:
    """Ids as the library's `encode(text, add_special_tokens=False)` gives them.

    When the file lower-cases, splits into words and marks word ends, each word
    has ids of its own whatever stands around it. Texts of plain Latin letters are
    then split here, and only words that are not in the cache go to the library,
    many in a call. All other texts and files go to the library whole.
    """

    def __init__(self, path: str, cached: int = 400_000):
        self.library = Tokenizer.from_file(path)
        self.cached = cached
        #: Ids of words, and of runs between white space: their texts, and where their ids lie in `flat`.
        self.words: dict[str, bytes] = {}
        self.runs, self.flat = pa.array([], pa.string()), np.empty(0, "<u4")
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ends = self._word_ends()

    def _word_ends(self) -> np.ndarray | None:
        spec = json.loads(self.library.to_str())
        suffix = spec["model"].get("end_of_word_suffix")
        steps = json.dumps([spec.get("normalizer"), spec.get("pre_tokenizer")])
        kinds = re.findall(r'"type": "(\w+)"', steps)
        expected = ["Sequence", "NFC", "Replace", "Lowercase", "Sequence", "Split", "ByteLevel"]
        if not suffix or kinds != expected or json.dumps(_WORD_SPLIT) not in steps:
            return None
        vocabulary = spec["model"]["vocab"]
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        return ends

    @classmethod
    def load(cls, path: str, cached: int = 400_000) -> WordTokenizer:
        """One tokenizer per Python worker, kept from task to task."""
        key = (path, cached)
        if key not in _loaded:
            _loaded[key] = cls(path, cached)
        return _loaded[key]

    def _ask(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words from the library."""
        found: dict[str, bytes] = {}
        parts = [words[at : at + _ASKED] for at in range(0, len(words), _ASKED)]
        asked = self.library.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, encoding in zip(parts, asked):
            ids = np.array(encoding.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):  # a word without an end of its own: ask one by one
                each = self.library.encode_batch_fast(part, add_special_tokens=False)
                found.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(part, each))
                continue
            raw, last = ids.tobytes(), 0
            for word, cut in zip(part, (4 * cuts).tolist()):
                found[word] = raw[last:cut]
                last = cut
        return found

    def _ids_of_new(self, runs: list[str]) -> list[bytes]:
        """Ids of runs that are not in the cache, from those of their words."""
        known = self.words
        split = [_WORD.findall(run) for run in runs]
        found = self._ask(list({w: None for words in split for w in words if w not in known}))
        ids = [b"".join([known[w] if w in known else found[w] for w in words]) for words in split]
        if len(known) < self.cached // 2:  # once full, what was met first, so mostly what is frequent, stays
            known.update(found)
        return ids

    def _ids_of_runs(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct runs: all ids in a row, and for each run where its own begin and how many they are."""
        place = pc.index_in(runs, value_set=self.runs)
        new = place.is_null().to_numpy(zero_copy_only=False)
        asked = runs.filter(pa.array(new))
        ids = self._ids_of_new(asked.to_pylist())
        own = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        starts, sizes = np.empty(len(runs), np.int64), np.empty(len(runs), np.int64)
        at = place.drop_null().to_numpy()
        starts[~new], sizes[~new] = self.starts[at], self.sizes[at]
        starts[new], sizes[new] = len(self.flat) + np.cumsum(own) - own, own
        if len(self.runs) < self.cached:
            self.runs, self.flat = pa.concat_arrays([self.runs, asked]), flat
            self.starts, self.sizes = np.append(self.starts, starts[new]), np.append(self.sizes, own)
        return flat, starts, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        other = pc.match_substring_regex(texts, _OTHER).to_numpy(zero_copy_only=False)
        if self.ends is None:
            other = np.ones(len(texts), bool)
        lengths = np.zeros(len(texts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        plain, split = np.flatnonzero(other), np.flatnonzero(~other)
        if len(split):
            lists = pc.ascii_split_whitespace(pc.utf8_lower(texts.take(pa.array(split))))
            runs = lists.flatten().dictionary_encode()
            flat, starts, sizes = self._ids_of_runs(runs.dictionary)
            at = runs.indices.to_numpy()
            n = sizes[at]
            before = np.concatenate([[0], np.cumsum(n)])
            taken = flat[np.repeat(starts[at] - before[:-1], n) + np.arange(before[-1])]
            edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            lengths[split] = np.diff(before[edges])
            parts.append((split, taken))
        if len(plain):
            asked = self.library.encode_batch(texts.take(pa.array(plain)).to_pylist(), add_special_tokens=False)
            each = [e.ids for e in asked]
            lengths[plain] = [len(x) for x in each]
            parts.append((plain, np.array([i for x in each for i in x], "<u4")))
        if len(parts) < 2:
            return (parts[0][1] if parts else np.empty(0, "<u4")), lengths
        out, starts = np.empty(int(lengths.sum()), "<u4"), np.cumsum(lengths) - lengths
        for rows, ids in parts:
            n = lengths[rows]
            out[np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, lengths

    def encode_documents(self, texts: pa.Array, end_id: int) -> tuple[bytes, np.ndarray]:
        """Ids with `end_id` after each text, as little-endian 32-bit integers, and how many each text has with it."""
        ids, lengths = self.encode(texts)
        return np.insert(ids, np.cumsum(lengths), end_id).astype("<u4").tobytes(), lengths + 1
