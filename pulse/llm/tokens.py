"""Token ids of whole texts, with each distinct word encoded once.

The tokenizer drops white space and never joins characters across a blank or a line feed, so the
ids of a text are the ids of its blank-separated chunks in order. Chunks repeat a lot; encoding a
chunk once per worker is what makes whole corpora affordable. ``special tokens`` of the vocabulary
hold no blank, so they stay inside one chunk and get the same id as in the whole text.
"""

from __future__ import annotations

import os
from itertools import repeat

import numpy as np

CACHED_WORDS = 400_000
CACHED_CHARS = 40
GROUP = 64
SLICE_CHARS = 1 << 21


class ChunkEncoder:
    """Encodes texts; keeps the ids of up to ``cached`` chunks, others only for one call."""

    def __init__(self, path: str, cached: int | None = None):
        self.cached = CACHED_WORDS if cached is None else cached
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.place: dict[str, int] = {"": 0}
        self.start = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.n, self.used = 1, 0

    def _store(self, ids: list[int]) -> int:
        if self.n == len(self.start):
            self.start, self.size = np.resize(self.start, 2 * self.n), np.resize(self.size, 2 * self.n)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(ids)))
        self.start[self.n], self.size[self.n] = self.used, len(ids)
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.n += 1
        return self.n - 1

    def _add(self, words: list[str]) -> None:
        """Encode chunks, many in one text, and cut the ids apart by their places in it."""
        groups = [words[i : i + GROUP] for i in range(0, len(words), GROUP)]
        joined = self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
        for group, found in zip(groups, joined, strict=True):
            ids = found.ids
            at = [b for b, _ in found.offsets]
            k, end = 0, -1
            for word in group:
                end += len(word) + 1
                first = k
                while k < len(at) and at[k] < end:
                    k += 1
                self.place[word] = self._store(ids[first:k])

    def _places(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids begin (texts + 1 offsets)."""
        counts = [t.count(" ") + t.count("\n") + 1 for t in texts]
        bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        words = " ".join(texts).replace("\n", " ").split(" ") if texts else []
        at = self._places(words)
        kept = self.n, self.used
        passing: list[str] = []
        if (missing := np.flatnonzero(at < 0)).size:
            new = {words[i] for i in missing.tolist()}
            short = [w for w in new if len(w) <= CACHED_CHARS]
            room = max(0, self.cached - self.n)
            self._add(short[:room])
            kept = self.n, self.used
            passing = short[room:] + [w for w in new if len(w) > CACHED_CHARS]
            self._add(passing)
            at[missing] = self._places([words[i] for i in missing.tolist()])
        size, start = self.size[at], self.start[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(start - (ends - size), size) + np.arange(total)]
        for w in passing:
            del self.place[w]
        if passing:
            self.n, self.used = kept
        offsets = np.concatenate([[0], ends])[bounds]
        return ids, offsets


_ENCODERS: dict[tuple[str, int | None], ChunkEncoder] = {}


def encoder(path: str, cached: int | None = None) -> ChunkEncoder:
    """One encoder per worker process, vocabulary file and number of words kept."""
    if (path, cached) not in _ENCODERS:
        _ENCODERS[path, cached] = ChunkEncoder(path, cached)
    return _ENCODERS[path, cached]


def slices(texts: list[str]):
    """Index ranges of texts of about SLICE_CHARS characters; a long text comes alone."""
    first, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > SLICE_CHARS:
            yield first, i
            first, chars = i, 0
        chars += len(t)
    if first < len(texts):
        yield first, len(texts)
