"""SentencePiece encoding and decoding for merge-type (BPE) models, by a prefix table.

For every prefix of a text the encoding's last token is unique. It is found from left to right: an
automaton gives the pieces that end at a position, and the right one is that which stands by itself
at the start, or next to the last token of the prefix before it, without the two merging otherwise.
The ids are then read backwards. Between two characters that no piece contains side by side nothing
merges, so a text falls into short stretches there, whose ids are remembered.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.recent import Recent

MARK = "▁"
#: Stretches, chunks and pair tests that a worker remembers (twice as many at most); those not met lately go.
STRETCHES, CHUNKS, PAIRS = 200_000, 100_000, 100_000
_PROBE = "  Ａ ﬁ  x\t​\n　é "
_CHUNKS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Encoder:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalizer = sentencepiece.SentencePieceNormalizer(model_file=path)
        lib = self.library
        self.scores, self.ids, self.lengths = {}, {}, {}
        for i in range(lib.get_piece_size()):
            if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i):
                continue
            piece = lib.id_to_piece(i)
            self.scores[piece], self.ids[piece], self.lengths[i] = lib.get_score(i), i, len(piece)
        self.pieces = {i: piece for piece, i in self.ids.items()}
        self.beside = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.falls_back = lib.is_byte(self.bytes[0])
        self.unknown = lib.unk_id()
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.plain = self.normalizer.normalize(_PROBE) == (MARK + _PROBE).replace(" ", MARK)
        self._whole = {i: self.merge(piece) == [piece] for piece, i in self.ids.items() if len(piece) > 1}
        self._fits, self._stretches, self._chunks = Recent(PAIRS), Recent(STRETCHES), Recent(CHUNKS)

    def merge(self, text: str) -> list[str]:
        """The definition, for short strings: merge the best-scored adjacent pair, leftmost first, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are."""
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            a, b = self.pieces[left], self.pieces[right]
            known = (a + b) not in self.scores and self.merge(a + b) == [a, b]
            self._fits.put(key, known)
        return known

    def _stretch(self, text: str) -> list[int]:
        """Ids of a text whose neighbouring characters all occur side by side in some piece."""
        if len(text) == 1:
            i = self.ids.get(text)
            if i is not None:
                return [i]
            return [self.bytes[b] for b in text.encode()] if self.falls_back else [self.unknown]
        last = [-1] * (len(text) + 1)
        for end, token in self.automaton.iter(text):
            if last[end + 1] >= 0:
                continue  # a prefix has one last token
            start = end + 1 - self.lengths[token]
            if start == 0:
                if self._whole.get(token, True):
                    last[end + 1] = token
            elif last[start] >= 0 and self.fits(last[start], token):
                last[end + 1] = token
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= self.lengths[last[at]]
        out.reverse()
        return out

    def _chunk(self, text: str) -> str:
        """Ids of a piece of text that starts with a mark, as decimals joined by commas: the form that takes least memory."""
        out: list[str] = []
        start = 0
        for k in range(1, len(text) + 1):
            if k == len(text) or text[k - 1 : k + 1] not in self.beside:
                stretch = text[start:k]
                known = self._stretches.get(stretch)
                if known is None:
                    known = ",".join(map(str, self._stretch(stretch)))
                    if len(stretch) <= 64:
                        self._stretches.put(stretch, known)
                out.append(known)
                start = k
        return ",".join(out)

    def _remember(self, chunk: str) -> str:
        found = self._chunks.get(chunk)
        if found is None:
            found = self._chunk(MARK + chunk)
            if len(chunk) <= 64:
                self._chunks.put(chunk, found)
        return found

    def chunks(self, text: str) -> list[str]:
        """Ids of a whole text, chunk by chunk, as decimals joined by commas."""
        if not text:
            return []
        if self.plain and "  " not in text and text[0] != " " and MARK not in text:
            known, remember = self._chunks.young, self._remember
            return [known.get(part) or remember(part) for part in text.split(" ")]
        normal = (MARK + text).replace(" ", MARK) if self.plain else self.normalizer.normalize(text)
        return [self._chunk(chunk) for chunk in _CHUNKS.findall(normal)]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text as the library gives them, without begin and end ids; NULL counts as empty."""
        return ids_of(",".join(self.chunks(text or "")))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)

    def forget_old(self) -> None:
        for memory in (self._fits, self._stretches, self._chunks):
            memory.forget_old()


def ids_of(decimals: str) -> list[int]:
    return list(map(int, decimals.split(","))) if decimals else []


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a model file, built once per worker."""
    return Encoder(path)


def encode(text: Column, path: str) -> Column:
    """Ids of a whole text; NULL and empty texts give none."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(column: pa.Array) -> pa.Array:
        e = encoder(path)
        return pa.array([e.encode(t) for t in column.to_pylist()], pa.list_(pa.int32()))

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """Text of an id array; NULL and empty arrays give the empty text."""

    @F.arrow_udf(T.StringType())
    def text(column: pa.Array) -> pa.Array:
        e = encoder(path)
        return pa.array([e.decode(list(i or [])) for i in column.to_pylist()], pa.string())

    return text(ids)


_DIGEST = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def round_trip_digest(text: Column, path: str) -> Column:
    """Number and hash of a whole text's ids and hash of the text they decode to, without moving the ids."""

    @F.arrow_udf(_DIGEST)
    def digest(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        e = encoder(path)
        for column in columns:
            yield _digests(e, column)
        e.forget_old()  # the worker lives on, and its memory counts with the executor's

    return digest(text)


def _digests(e: Encoder, column: pa.Array) -> pa.Array:
    n, ids_hash, text_hash = [], [], []
    for t in column:
        decimals = ",".join(e.chunks(t.as_py() or ""))
        ids = ids_of(decimals)
        n.append(len(ids))
        ids_hash.append(hashlib.sha256(decimals.encode()).hexdigest())
        text_hash.append(hashlib.sha256(e.decode(ids).encode()).hexdigest())
    pa.default_memory_pool().release_unused()
    arrays = [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
    return pa.StructArray.from_arrays(arrays, [f.name for f in _DIGEST])
