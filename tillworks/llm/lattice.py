"""Lattice likelihood of words over a piece vocabulary, vectorised over words of equal length.

A word is its UTF-8 bytes behind a space. Every vocabulary piece and every single byte is a token, and a
word's probability is the sum over all ways to cut it into tokens, found by a log-space recursion over its
prefixes. Running the recursion backwards as well gives the expected count of every token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tillworks.llm.texts import mix

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240610).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BATCH_CELLS = 1 << 21  # prefixes times token lengths worked on at once


class Lattice:
    """Tokens 0 to 255 are the bytes, then come the pieces; ``scores`` are natural logarithms."""

    def __init__(self, pieces: list[bytes], scores: np.ndarray | None = None):
        self.tokens = [bytes([b]) for b in range(256)] + [p for p in pieces if len(p) > 1]
        self.longest = max(map(len, self.tokens))
        hashes = np.array([self._hash(t) for t in self.tokens], np.uint64)
        self._bits = 20
        while True:  # a table without clashes, so that one look is enough
            slots = (hashes >> np.uint64(64 - self._bits)).astype(np.int64)
            if len(np.unique(slots)) == len(slots) or self._bits == 26:
                break
            self._bits += 1
        order = np.argsort(hashes)
        self._sorted, self._order = hashes[order], order
        self._exact = len(np.unique(slots)) == len(slots)
        if self._exact:
            self._table = np.full(1 << self._bits, -1, np.int32)
            self._table[slots] = np.arange(len(hashes))
            self._hashes = hashes
        self.scores = np.full(len(self.tokens), -np.log(len(self.tokens))) if scores is None else scores

    @staticmethod
    def _hash(token: bytes) -> int:
        h = np.zeros(1, np.uint64)
        for b in token:
            h = h * _FACTOR + _BYTES[b : b + 1]
        return int(mix(h)[0])

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Token of each substring hash, -1 for none."""
        if self._exact:
            found = self._table[(hashes >> np.uint64(64 - self._bits)).astype(np.int64)]
            return np.where((found >= 0) & (self._hashes[found] == hashes), found, -1)
        at = np.minimum(np.searchsorted(self._sorted, hashes), len(self._sorted) - 1)
        return np.where(self._sorted[at] == hashes, self._order[at], -1)

    def edges(self, words: np.ndarray) -> np.ndarray:
        """``[word, end - 1, length - 1]``: the token of that length which ends there, -1 for none."""
        count, n = words.shape
        values = _BYTES[words]
        out = np.full((count, n, min(n, self.longest)), -1, np.int32)
        run = np.zeros((count, n), np.uint64)
        for length in range(1, out.shape[2] + 1):
            # hash of the `length` bytes that start at each place
            run = run[:, : n - length + 1] * _FACTOR + values[:, length - 1 :]
            out[:, length - 1 :, length - 1] = self._find(mix(run))
        return out

    def _log(self, edges: np.ndarray) -> np.ndarray:
        padded = np.append(self.scores, -np.inf)
        return padded[edges]

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """``[word, k]``: log probability of the first k bytes, over all segmentations."""
        count, n, longest = logs.shape
        alpha = np.full((count, n + 1), -np.inf)
        alpha[:, 0] = 0
        for k in range(1, n + 1):
            m = min(k, longest)
            terms = logs[:, k - 1, :m] + alpha[:, k - m : k][:, ::-1]
            top = terms.max(1)
            alpha[:, k] = top + np.log(np.exp(terms - top[:, None]).sum(1))
        return alpha

    def backward(self, logs: np.ndarray) -> np.ndarray:
        """``[word, k]``: log probability of the bytes after the first k."""
        count, n, longest = logs.shape
        beta = np.full((count, n + 1), -np.inf)
        beta[:, n] = 0
        for k in range(n - 1, -1, -1):
            m = min(n - k, longest)
            terms = logs[:, np.arange(k, k + m), np.arange(m)] + beta[:, k + 1 : k + m + 1]
            top = terms.max(1)
            beta[:, k] = top + np.log(np.exp(terms - top[:, None]).sum(1))
        return beta

    def batches(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions and bytes of the words, each behind a space, in groups of equal length."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            step = max(1, BATCH_CELLS // ((int(n) + 1) * min(int(n) + 1, self.longest)))
            for i in range(0, len(at), step):
                some = at[i : i + step]
                block = np.frombuffer(b"".join(b" " + words[k] for k in some), np.uint8).reshape(len(some), n + 1)
                yield some, block

    def expected_counts(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """Expected number of uses of every token when the words occur so many times."""
        total = np.zeros(len(self.tokens))
        for at, block in self.batches(words):
            edges = self.edges(block)
            logs = self._log(edges)
            alpha, beta = self.forward(logs), self.backward(logs)
            n, longest = logs.shape[1:]
            starts = np.arange(n)[:, None] - np.arange(longest)[None, :]
            share = logs + alpha[:, np.maximum(starts, 0)] + beta[:, 1:, None] - alpha[:, -1][:, None, None]
            use = edges >= 0
            weights = (np.exp(share) * times[at][:, None, None])[use]
            total += np.bincount(edges[use], weights, len(self.tokens))
        return total

    def log_probabilities(self, words: list[bytes], scores: list[np.ndarray]) -> np.ndarray:
        """``[word, model]``: the marginal under each of several sets of scores, on one search for tokens."""
        out = np.zeros((len(words), len(scores)))
        for at, block in self.batches(words):
            edges = self.edges(block)
            for k, own in enumerate(scores):
                self.scores = own
                out[at, k] = self.forward(self._log(edges))[:, -1]
        return out
