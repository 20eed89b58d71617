"""Token ids of documents in length-delimited binary record files, in ascending order of their id.

A record is framed by its length (8 bytes), the length's masked checksum (4), the payload and the
payload's masked checksum (4), all little-endian: the common framing of record files. A payload is a header
(document id, flags, number of ids; 16 bytes) and the ids, in two bytes each where the vocabulary allows it, else in four.
Beside every file lies an index of its records' offsets (8 bytes each, one more for the end), so that a
shuffled read can go to any record. A manifest lists the files of finished tasks; files of failed attempts
are in no manifest and count as absent.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillworks.llm.crc32c import masked
from tillworks.llm.texts import lean_batches

#: Stretches and pattern matches whose ids a worker remembers; beyond it works the same, only slower.
REMEMBERED_CHUNKS, REMEMBERED_PIECES = 800_000, 1_200_000
MANIFEST = "manifest"
_NO_ID, _WIDE = 1, 2  # flags of a payload
_HEADER = struct.Struct("<qII")
_MANIFEST_TYPE = "shard int, file string, n_records bigint, n_tokens bigint, n_bytes bigint"


def _alphabet() -> dict[int, int]:
    """Byte-level models write printable bytes as themselves, the others as code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


_ALPHABET = _alphabet()


class _Unsplit(Exception):
    """White space stands next to a single space, so the text has to be encoded as a whole."""


class Encoder:
    """Ids of whole texts by the tokenizers library, remembering those of frequent words.

    Between a character that is no white space and a single space before another one the byte-level
    pattern always splits, so the stretches between such places can be encoded on their own.
    """

    _parts = regex.compile(r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.wide = self.library.get_vocab_size() > 1 << 16
        self.type = np.dtype("<u4" if self.wide else "<u2")
        self._model = self.library.model
        self._chunks: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self.splits = self._byte_level()

    def _byte_level(self) -> bool:
        """Whether the file splits texts by the byte-level pattern and by nothing else."""
        content = json.loads(self.library.to_str())
        before = content["pre_tokenizer"] or {}
        return (
            content["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
        )

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.type).tobytes() for e in found]

    def _piece(self, piece: str) -> bytes:
        """Ids of one match of the pattern, by the file's model: its bytes in the model's alphabet."""
        tokens = self._model.tokenize(piece.encode().decode("latin-1").translate(_ALPHABET))
        ids = struct.pack(f"<{len(tokens)}{'I' if self.wide else 'H'}", *[t.id for t in tokens])
        if len(piece) <= 64:
            if len(self._pieces) >= REMEMBERED_PIECES:
                self._pieces.clear()
            self._pieces[piece] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        known, piece = self._pieces.get, self._piece
        return b"".join([known(p) or piece(p) for p in self._parts.findall(chunk)])

    def _between(self, part: str) -> bytes:
        """Ids of a space and what follows it up to the next one; raises _Unsplit where the text does not split there."""
        if not part or part[0].isspace() or part[-1].isspace():
            raise _Unsplit
        ids = self._chunk(" " + part)
        if len(self._chunks) < REMEMBERED_CHUNKS and len(part) <= 64:
            self._chunks[part] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, packed; NULL counts as empty."""
        if not text:
            return b""
        if not self.splits or any(a in text for a in self.added):
            return self._encode([text])[0]
        first, *rest = text.split(" ")
        if not rest:
            return self._chunk(text)
        last = rest.pop()
        known, between = self._chunks.get, self._between
        if not first or first[-1].isspace() or not last or last[0].isspace():
            return self._encode([text])[0]
        try:
            middle = b"".join([known(part) or between(part) for part in rest])
        except _Unsplit:
            return self._encode([text])[0]
        return self._chunk(first) + middle + self._chunk(" " + last)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side already
    return Encoder(path)


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def read_frame(stream) -> bytes | None:
    """The next payload of a file, None at its end; raises ValueError where a checksum does not fit."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError("damaged record length")
    size = struct.unpack("<Q", head[:8])[0]
    body = stream.read(size + 4)
    if len(body) < size + 4 or masked(body[:size]) != struct.unpack("<I", body[size:])[0]:
        raise ValueError("damaged record")
    return body[:size]


def payload(doc_id: int | None, packed: bytes, wide: bool) -> bytes:
    flags = (_NO_ID if doc_id is None else 0) | (_WIDE if wide else 0)
    return _HEADER.pack(doc_id or 0, flags, len(packed) // (4 if wide else 2)) + packed


def unpack(data: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and ids of a payload."""
    doc_id, flags, _ = _HEADER.unpack_from(data)
    ids = np.frombuffer(data, "<u4" if flags & _WIDE else "<u2", offset=_HEADER.size)
    return (None if flags & _NO_ID else doc_id), ids


def _file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def write(
    df: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = 0
) -> None:
    """Write the ids of every whole text of ``df``, each followed by the id ``end``, under the new folder ``path``.

    ``path`` is a URI that executors reach through pyarrow's file systems. Shards are ranges of ascending
    ``doc_id`` (a long), NULL ids first, rows that repeat an id next to each other by the hash of their
    text; a NULL or empty text is a record of the end alone. Other columns are not looked at. An empty
    table gives an empty manifest.
    """
    spark = df.sparkSession
    lean_batches(spark)
    rows = df.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("shard"), "doc_id", "text")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer)
        last = np.array([end], e.type).tobytes()
        stream, shard, name, offsets, tokens = None, None, f"{uuid.uuid4().hex}.records", [0], 0
        fs, folder = _file_system(path)
        for batch in batches:
            for one, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if stream is None:
                    shard = batch.column("shard")[0].as_py()
                    fs.create_dir(folder)
                    stream = fs.open_output_stream(f"{folder}/{name}", buffer_size=1 << 20)
                packed = e.encode(t.as_py()) + last
                record = frame(payload(one, packed, e.wide))
                stream.write(record)
                offsets.append(offsets[-1] + len(record))
                tokens += len(packed) // e.type.itemsize
        if stream is not None:
            stream.close()
            with fs.open_output_stream(f"{folder}/{name}.index") as index:
                index.write(np.array(offsets, "<u8").tobytes())
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "file": name, "n_records": len(offsets) - 1, "n_tokens": tokens, "n_bytes": offsets[-1]}],
                pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_records", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]),
            )

    placed.mapInArrow(save, _MANIFEST_TYPE).write.parquet(f"{path}/{MANIFEST}")


def _read(spark: SparkSession, path: str, ddl: str, types: list[tuple], row_of, seed: int | None = None) -> DataFrame:
    """``shard, start`` and what ``row_of`` makes of every record; ``start``: ids in all records before it."""
    manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    files = files.select("shard", "file", "start").repartition(max(1, manifest.count()))
    schema = pa.schema([("shard", pa.int32()), ("start", pa.int64()), *types])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _file_system(path)
        for batch in batches:
            for file in batch.to_pylist():
                out: list[tuple] = []
                for start, data in _records(fs, f"{folder}/{file['file']}", seed):
                    out.append((file["shard"], None if start is None else file["start"] + start, *row_of(data)))
                    if len(out) == 500:
                        yield _batch(out, schema)
                        out = []
                if out:
                    yield _batch(out, schema)

    return files.mapInArrow(load, f"shard int, start bigint, {ddl}")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _records(fs: pyarrow.fs.FileSystem, file: str, seed: int | None) -> Iterator[tuple[int | None, bytes]]:
    """Payloads of a file and the ids before each: in order, or by the index in an order drawn from ``seed``."""
    if seed is None:
        start = 0
        with fs.open_input_stream(file, buffer_size=1 << 20) as stream:
            while (data := read_frame(stream)) is not None:
                yield start, data
                start += len(unpack(data)[1])
        return
    with fs.open_input_stream(f"{file}.index") as stream:
        offsets = np.frombuffer(stream.read(), "<u8")[:-1]
    with fs.open_input_file(file) as stream:
        for offset in np.random.default_rng(seed).permutation(offsets).tolist():
            stream.seek(offset)
            yield None, read_frame(stream)


def read(spark: SparkSession, path: str, seed: int | None = None) -> DataFrame:
    """``shard, start, doc_id, ids`` of every record, its checksums verified.

    With a ``seed`` the records of each file come in a random order through its index, without ``start``.
    """
    types = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]
    return _read(spark, path, "doc_id bigint, ids array<int>", types, unpack, seed)


def digest(spark: SparkSession, path: str) -> DataFrame:
    """``shard, start, doc_id, n_tokens, ids_crc32`` of every record, without moving the ids."""

    def row_of(data: bytes) -> tuple[int | None, int, int]:
        doc_id, ids = unpack(data)
        return doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    types = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    return _read(spark, path, "doc_id bigint, n_tokens bigint, ids_crc32 bigint", types, row_of)
