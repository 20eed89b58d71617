"""Counts of word sequences in a HAT-trie: hash containers under a shallow trie of word ids.

Sequences of one width are counted. They start in one hash container; a container that grows past a bound bursts
into a branch by the next word, with a smaller container under each. Past a bound of the whole trie its largest
subtrees leave as sorted runs and are forgotten, to be added up with other runs later.
"""

from __future__ import annotations

import itertools

import numpy as np
import xxhash

#: Sequences in a container before it bursts, and in all tries of a worker before subtrees leave.
BURST, MOST = 4_096, 500_000
#: Words that a worker numbers before everything leaves and numbering starts anew.
WORDS = 250_000
BREAK = b"\xff"  # stands between words that are in no sequence together; no byte of UTF-8
WIDEST = 4  # ids of a sequence are packed into 63 bits


class Branch(dict):
    """Word id to subtree; a subtree is a branch or a container (a plain dict of the remaining ids, packed)."""


def bits_of(width: int) -> int:
    if not 1 <= width <= WIDEST:
        raise ValueError(f"sequences have 1 to {WIDEST} words")
    return min(31, 63 // width)


def _size(node: dict) -> int:
    return sum(map(_size, node.values())) if type(node) is Branch else len(node)


class Trie:
    def __init__(self, width: int, burst: int = BURST):
        self.width, self.bits, self.burst, self.size = width, bits_of(width), burst, 0
        self.root: dict = {}

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of packed sequences, which come in ascending order: those of a first word go in together."""
        top = self.bits * (self.width - 1)
        if type(self.root) is not Branch and len(self.root) + len(keys) > self.burst and top:
            self._burst(None, 0, self.root, top)  # before it gets large
        if type(self.root) is not Branch:
            self._put(None, 0, self.root, keys.tolist(), counts.tolist(), top)
            return
        heads, rests, counts = keys >> top, (keys & ((1 << top) - 1)).tolist(), counts.tolist()
        starts = np.flatnonzero(np.diff(heads, prepend=-1)) if len(keys) else np.empty(0, np.int64)
        ends = [*starts[1:].tolist(), len(rests)]
        root, below = self.root, top - self.bits
        for head, start, end in zip(heads[starts].tolist(), starts.tolist(), ends):
            node = root.get(head)
            if node is None:
                node = root[head] = {}
            self._put(root, head, node, rests[start:end], counts[start:end], below)

    def _put(self, parent: Branch | None, head: int, node: dict, rests: list[int], counts: list[int], shift: int) -> None:
        """Add sequences to a container, or one by one down a branch; a container that gets too large bursts."""
        if type(node) is not Branch:
            before, get = len(node), node.get
            for rest, count in zip(rests, counts):
                node[rest] = get(rest, 0) + count
            self.size += len(node) - before
            if len(node) > self.burst and shift > 0:
                self._burst(parent, head, node, shift)
            return
        for rest, count in zip(rests, counts):
            first = rest >> shift
            child = node.get(first)
            if child is None:
                child = node[first] = {}
            self._put(node, first, child, [rest & ((1 << shift) - 1)], [count], shift - self.bits)

    def _burst(self, parent: Branch | None, head: int, container: dict, shift: int) -> None:
        branch = Branch()
        for rest, count in container.items():
            first = rest >> shift
            child = branch.get(first)
            if child is None:
                child = branch[first] = {}
            child[rest & ((1 << shift) - 1)] = count
        if parent is None:
            self.root = branch
        else:
            parent[head] = branch

    def _collect(self, node: dict, prefix: int, shift: int, found: tuple[list, list, list, list]) -> None:
        """Add to lists what is in a subtree: of each container the prefix and size, of each sequence the rest and count."""
        if type(node) is Branch:
            for head, child in node.items():
                self._collect(child, prefix | head << shift, shift - self.bits, found)
        else:
            prefixes, sizes, rests, counts = found
            prefixes.append(prefix)
            sizes.append(len(node))
            rests.extend(node)
            counts.extend(node.values())

    def release(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Take out whole subtrees, largest first, until at most ``keep`` sequences are left: packed keys and counts."""
        top = self.bits * (self.width - 1)
        found: tuple[list, list, list, list] = ([], [], [], [])
        if type(self.root) is not Branch or not keep:
            if self.size > keep:
                self._collect(self.root, 0, top, found)
                self.root, self.size = {}, 0
        else:
            sizes = {head: _size(node) for head, node in self.root.items()}
            for head in sorted(sizes, key=lambda head: -sizes[head]):
                if self.size <= keep:
                    break
                self._collect(self.root.pop(head), head << top, top - self.bits, found)
                self.size -= sizes[head]
        prefixes, sizes, rests, counts = (np.array(part, np.int64) for part in found)
        return np.repeat(prefixes, sizes) | rests, counts


class _Numbers(dict):
    """Word to number; a word that is new gets the next one."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Words:
    """Local numbers of words, from 1 on; 0 is a break, which is in no sequence."""

    def __init__(self):
        self._numbers, self._hashes = _Numbers({BREAK: 0}), np.zeros(1, np.uint64)

    def __len__(self) -> int:
        return len(self._numbers)

    @property
    def words(self) -> list[bytes]:
        return list(self._numbers)

    def number(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self._numbers.__getitem__, words), np.int64, len(words))

    @property
    def hashes(self) -> np.ndarray:
        """64-bit hash of each numbered word."""
        done, now = len(self._hashes), len(self)
        if done < now:
            new = np.fromiter(map(xxhash.xxh64_intdigest, itertools.islice(self._numbers, done, now)), np.uint64, now - done)
            self._hashes = np.concatenate([self._hashes, new])
        return self._hashes

    def order(self) -> tuple[np.ndarray, list[bytes]]:
        """Rank of each number in the order of the words, and the words in this order; the break comes last."""
        words = self.words
        by_word = sorted(range(len(words)), key=words.__getitem__)
        ranks = np.empty(len(by_word), np.int64)
        ranks[by_word] = np.arange(len(by_word))
        return ranks, [words[k] for k in by_word]


def run_of(keys: np.ndarray, counts: np.ndarray, width: int, ranks: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """A sorted run: of each place in a sequence the ranks of its words, in the order of the words, and the counts."""
    bits = bits_of(width)
    columns = [ranks[(keys >> bits * (width - 1 - k)) & ((1 << bits) - 1)] for k in range(width)]
    order = np.lexsort(columns[::-1])
    return [column[order] for column in columns], counts[order]


def windows(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sequence of ``width`` numbers from each place on, and whether it has no break."""
    n = max(0, len(ids) - width + 1)
    whole, packed = np.ones(n, bool), np.zeros(n, np.int64)
    for k in range(width):
        part = ids[k : k + n]
        whole &= part > 0
        packed = packed << bits_of(width) | part
    return packed, whole
