"""Byte-level BPE by a lazily determinised transducer, and streaming decoding by a UTF-8 state machine.

A rank file's merges are compiled into a transducer over bytes. Every prefix of a piece has one last token:
the token that ends there and stays as it is beside the last token of the prefix before it. A state holds,
for each earlier place from which some token may still be under way, where that token has got to in the
trie of all tokens, the last token before that place, and the tokens not yet given out on the way to it.
What all these ways have in common is decided and given out, so ids come after a lookahead of at most one
token's bytes. States are made when a text first reaches them and remembered.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers
from tillworks.llm.recent import Recent

#: Steps of the transducer, pair tests and pieces that a worker remembers. Beyond it the steps and tests are
#: made anew, and the pieces not met lately go; results are the same.
STEPS, PAIRS, PIECES = 500_000, 200_000, 300_000
#: Characters of a piece that is remembered; pieces encoded or ids decoded at a time; characters of a text that is not split at once.
SHORT, BLOCK, LONG = 32, 16_384, 1 << 20
_NONE = 1 << 60


def _read(path: str) -> bytes:
    if "://" not in path:
        with open(path, "rb") as file:
            return file.read()
    fs, name = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_input_stream(name) as stream:
        return stream.read()


class _Unsplit(Exception):
    """White space stands next to a single space, so a text cannot be split there."""


class Transducer:
    """The compiled merges of one rank file, which must hold all single bytes."""

    def __init__(self, path: str):
        lines = _read(path).split(b"\n")
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.tokens = {i: token for token, i in self.ranks.items()}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a rank file must hold every single byte")
        self._children: dict[int, int] = {}
        self._ends = [-1]  # by trie node: the token that ends there
        for token, i in self.ranks.items():
            node = 0
            for b in token:
                following = self._children.get(node << 8 | b)
                if following is None:
                    following = self._children[node << 8 | b] = len(self._ends)
                    self._ends.append(-1)
                node = following
            self._ends[node] = i
        self.complete = np.zeros(max(self.tokens) + 2, bool)  # of each id whether its bytes are whole characters
        for token, i in self.ranks.items():
            try:
                token.decode()
                self.complete[i] = True
            except UnicodeDecodeError:
                pass
        self._merged: dict[int, tuple[list[int], list[bytes], list[bytes], bool]] = {}
        self._pairs: dict[int, bool] = {}
        self._restart()

    def _restart(self) -> None:
        start = ((0, -1, ()),)
        self._states, self._numbers = [start], {start: 0}
        self._steps: dict[int, int] = {}
        self._decided: dict[int, bytes] = {}

    def _merging(self, data: bytes) -> tuple[list[int], list[bytes], list[bytes], list[bytes]]:
        """The definition, for short strings: join the adjacent pair of least rank, leftmost first, until none is a token.

        Of each moment the rank that is joined next, and the first and the last part; then the parts at the end.
        """
        parts, ranks, firsts, lasts = [data[k : k + 1] for k in range(len(data))], [], [], []
        while True:
            ranked = [self.ranks.get(a + b, _NONE) for a, b in itertools.pairwise(parts)]
            least = min(ranked, default=_NONE)
            ranks.append(least)
            firsts.append(parts[0])
            lasts.append(parts[-1])
            if least == _NONE:
                return ranks, firsts, lasts, parts
            k = ranked.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def merge(self, data: bytes) -> list[int]:
        """Ids of a short string by the definition."""
        return [self.ranks[p] for p in self._merging(data)[3]]

    def _moments(self, token: int) -> tuple[list[int], list[bytes], list[bytes], bool]:
        known = self._merged.get(token)
        if known is None:
            ranks, firsts, lasts, parts = self._merging(self.tokens[token])
            known = self._merged[token] = (ranks, firsts, lasts, len(parts) == 1)
        return known

    def whole(self, token: int) -> bool:
        """Whether merging a token's bytes gives the token."""
        return self._moments(token)[3]

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are.

        Both are merged by themselves, in the order of their ranks, until what meets at the border is due first.
        """
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is not None:
            return known
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        before, _, lasts, _ = self._moments(left)
        after, firsts, _, known = self._moments(right)
        i = j = 0
        while known:  # a token that merging does not give stands beside nothing
            across = self.ranks.get(lasts[i] + firsts[j], _NONE)
            if across < before[i] and across <= after[j]:
                known = False
                break
            if before[i] > after[j]:
                j += 1
            elif before[i] < _NONE:
                i += 1
            else:
                break
        self._pairs[key] = known
        return known

    def _step(self, key: int) -> int:
        """Make the step of ``state << 8 | byte``: twice the next state, and one more if ids are decided by it."""
        byte, ways, found, children = key & 255, [], None, self._children
        for node, last, path in self._states[key >> 8]:
            node = children.get(node << 8 | byte)
            if node is None:
                continue
            ways.append((node, last, path))
            if found is None:
                token = self._ends[node]
                if token >= 0 and (self.whole(token) if last < 0 else self.fits(last, token)):
                    found = (0, token, (*path, token))
        ways.append(found)
        shared = 0
        if ways[0][2]:
            for column in zip(*[path for _, _, path in ways]):
                if column.count(column[0]) < len(column):
                    break
                shared += 1
        if shared:
            self._decided[key] = struct.pack(f"<{shared}I", *ways[0][2][:shared])
            ways = [(node, last, path[shared:]) for node, last, path in ways]
        state = tuple(ways)
        number = self._numbers.get(state)
        if number is None:
            number = self._numbers[state] = len(self._states)
            self._states.append(state)
        step = self._steps[key] = number << 1 | (shared > 0)
        return step

    def run(self, pieces: Iterable[bytes]) -> Iterator[bytes]:
        """Packed ids of one string given in parts, as they are decided."""
        if len(self._steps) >= STEPS:
            self._restart()
        state, known, make, decided = 0, self._steps.get, self._step, self._decided
        for piece in pieces:
            for byte in piece:
                key = state << 8 | byte
                step = known(key)
                if step is None:
                    step = make(key)
                if step & 1:
                    yield decided[key]
                state = step >> 1
        rest = self._states[state][-1][2]
        if rest:
            yield struct.pack(f"<{len(rest)}I", *rest)

    def encode(self, data: bytes) -> bytes:
        """Packed ids of one piece; a piece that is a token is that token, as in the library."""
        known = self.ranks.get(data)
        return struct.pack("<I", known) if known is not None else b"".join(self.run((data,)))


class Encoder:
    """Splits texts by a pattern and encodes each match by itself.

    The given pattern always splits before a single space between two characters that are no white space.
    What stands between two such places is remembered with its ids.
    """

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.machine = Transducer(path)
        self._pattern = regex.compile(pattern)
        self._splits = pattern == public_tokenizers.PATTERN
        self._recent, self._encoded = Recent(PIECES), Recent(PIECES)

    def _piece(self, piece: str) -> bytes:
        found = self._encoded.get(piece)
        if found is None:
            found = self.machine.encode(piece.encode())
            if len(piece) <= SHORT:
                self._encoded.put(piece, found)
        return found

    def _pieces(self, text: str) -> bytes:
        known, piece = self._encoded.young.get, self._piece
        return b"".join([known(p) or piece(p) for p in self._pattern.findall(text)])

    def _between(self, part: str) -> bytes:
        """Ids of a space and what follows it up to the next one; raises _Unsplit where the pattern need not split."""
        found = self._recent.get(part)
        if found is None:
            if not part or part[0].isspace() or part[-1].isspace():
                raise _Unsplit
            found = self._pieces(" " + part)
            if len(part) <= SHORT:
                self._recent.put(part, found)
        return found

    def _matches(self, text: str) -> Iterator[bytes]:
        """Packed ids of any text, some matches at a time."""
        matches = self._pattern.finditer(text)
        while pieces := [m[0].encode() for m in itertools.islice(matches, BLOCK)]:
            yield b"".join(map(self.machine.encode, pieces))

    def blocks(self, text: str | None) -> Iterator[bytes]:
        """Packed ids (little-endian, four bytes) of a whole text, block by block; NULL counts as empty."""
        text = text or ""
        if not self._splits or len(text) > LONG or text != text.strip():
            yield from self._matches(text)
            return
        first, *parts = text.split(" ")
        known, between = self._recent.young.get, self._between
        try:
            if first[-1:].isspace():
                raise _Unsplit
            yield self._pieces(first) + b"".join([known(p) or between(p) for p in parts])
        except _Unsplit:
            yield from self._matches(text)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(self.blocks(text)), "<u4")


# States of a UTF-8 reader: between characters, then inside one. Of each: the bytes read of the character, and
# the following state by ranges of the next byte (fixed values of the encoding).
_LAST, _MIDDLE3, _E0, _ED, _MIDDLE4, _FOUR, _F0, _F4 = range(1, 9)
_ANY = (0x80, 0xBF)
_READERS = {
    0: (0, [((0x00, 0x7F), 0), ((0xC2, 0xDF), _LAST), ((0xE0, 0xE0), _E0), ((0xE1, 0xEC), _MIDDLE3), ((0xED, 0xED), _ED),
            ((0xEE, 0xEF), _MIDDLE3), ((0xF0, 0xF0), _F0), ((0xF1, 0xF3), _FOUR), ((0xF4, 0xF4), _F4)]),
    _LAST: (1, [(_ANY, 0)]),
    _MIDDLE3: (1, [(_ANY, 9)]),
    _E0: (1, [((0xA0, 0xBF), 9)]),
    _ED: (1, [((0x80, 0x9F), 9)]),
    9: (2, [(_ANY, 0)]),
    _FOUR: (1, [(_ANY, _MIDDLE4)]),
    _F0: (1, [((0x90, 0xBF), _MIDDLE4)]),
    _F4: (1, [((0x80, 0x8F), _MIDDLE4)]),
    _MIDDLE4: (2, [(_ANY, 10)]),
    10: (3, [(_ANY, 0)]),
}


def _table() -> tuple[list[int], list[list[int]]]:
    held, table = [0] * len(_READERS), [[0] * 256 for _ in _READERS]
    for state, (read, following) in _READERS.items():
        held[state] = read
        for byte in range(256):  # a byte that does not fit starts anew; what it broke off is not held back
            allowed = [*following, *_READERS[0][1]]
            table[state][byte] = next((to for (low, high), to in allowed if low <= byte <= high), 0)
    return held, table


HELD, UTF8 = _table()


class StreamDecoder:
    """Turns ids that come bit by bit into whole characters; a character that is not complete yet is held back."""

    def __init__(self, machine: Transducer, steps: dict[int, int] | None = None):
        self._tokens, self._steps = machine.tokens, {} if steps is None else steps
        self._complete = machine.complete
        self._state, self._rest = 0, b""

    def _step(self, key: int) -> int:
        state = key >> 32
        for byte in self._tokens[key & 0xFFFFFFFF]:
            state = UTF8[state][byte]
        self._steps[key] = state
        return state

    def feed(self, ids: np.ndarray | list[int]) -> bytes:
        """Bytes of the characters that the ids complete. An id that the file does not have raises KeyError."""
        ids, state, known = np.asarray(ids, np.int64), self._state, self._steps.get
        # Tokens of whole characters leave the state between characters as it is; only the others take steps.
        odd = np.flatnonzero(~self._complete[np.minimum(ids, len(self._complete) - 1)])
        following, ids = 0, ids.tolist()
        for k in odd.tolist():
            if state and k != following:
                state = 0  # a whole character broke off an incomplete one
            key = state << 32 | ids[k]
            state = known(key)
            if state is None:
                state = self._step(key)
            following = k + 1
        if following != len(ids):
            state = 0
        data = self._rest + b"".join([self._tokens[i] for i in ids])
        self._state, cut = state, len(data) - HELD[state]
        self._rest = data[cut:]
        return data[:cut]

    def feed_text(self, ids: Iterable[int]) -> str:
        """The same as text; bytes that are no UTF-8 become U+FFFD."""
        return self.feed(ids).decode("utf-8", "replace")

    def finish(self) -> bytes:
        """What is held back at the end."""
        rest, self._state, self._rest = self._rest, 0, b""
        return rest


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a rank file, built once per worker."""
    return Encoder(path)


_decoding: dict[str, dict[int, int]] = {}


def decoder(path: str) -> StreamDecoder:
    return StreamDecoder(encoder(path).machine, _decoding.setdefault(path, {}))


def encode(text: Column, path: str) -> Column:
    """Ids of a whole text; NULL and empty texts give none."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(column: pa.Array) -> pa.Array:
        e = encoder(path)
        found = [b"".join(e.blocks(t.as_py())) for t in column]
        ends = np.cumsum([0, *[len(x) // 4 for x in found]], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """Text of an id array; NULL and empty arrays give the empty text, bytes that are no UTF-8 become U+FFFD."""

    @F.arrow_udf(T.StringType())
    def text(column: pa.Array) -> pa.Array:
        out = []
        for one in column:
            stream, given = decoder(path), one.as_py() or []
            parts = [stream.feed(given[k : k + BLOCK]) for k in range(0, len(given), BLOCK)]
            out.append(b"".join([*parts, stream.finish()]).decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return text(ids)


_DIGEST = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def round_trip_digest(text: Column, path: str) -> Column:
    """Number and hash of a whole text's ids, and hash of the bytes they decode to, without moving the ids.

    Ids are made, hashed and decoded block by block, so a long text needs no memory beyond its own.
    """

    @F.arrow_udf(_DIGEST)
    def digest(column: pa.Array) -> pa.Array:
        e = encoder(path)
        counts, ids_hashes, text_hashes = [], [], []
        for t in column:
            n, ids_hash, text_hash, stream = 0, hashlib.sha256(), hashlib.sha256(), decoder(path)
            for packed in e.blocks(t.as_py()):
                n += len(packed) // 4
                ids_hash.update(packed)
                text_hash.update(stream.feed(np.frombuffer(packed, "<u4")))
            text_hash.update(stream.finish())
            counts.append(n)
            ids_hashes.append(ids_hash.hexdigest())
            text_hashes.append(text_hash.hexdigest())
        arrays = [pa.array(counts, pa.int64()), pa.array(ids_hashes, pa.string()), pa.array(text_hashes, pa.string())]
        return pa.StructArray.from_arrays(arrays, [f.name for f in _DIGEST])

    return digest(text)
