"""Byte-level BPE by a sentencepiece model that is serialised from a rank file.

Every token's bytes are mapped to printable characters, one each; a piece's score is its negative rank, so sentencepiece
merges in the order of the ranks, and its id is the rank. Normalisation is identity, without a blank in front. Texts are
split by the pattern; each pre-token is encoded by itself, and ids are decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import few, narrow

_KEPT = 1 << 16


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one that can be seen, else the next from U+0100."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return [chr(b) if b in seen else chr(256 + sum(x not in seen for x in range(b))) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and number in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protocol buffer field: bytes, a whole number, or a 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of the ranks, which must be 0 to n - 1; the unknown piece comes last."""
    characters, tokens = byte_characters(), sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or {t for t in tokens if len(t) == 1} != {bytes([b]) for b in range(256)}:
        raise ValueError("ranks must be 0 to n - 1 and have every byte")
    pieces = [_field(1, "".join(characters[b] for b in t).encode()) + _field(2, float(-i)) + _field(3, 1) for i, t in enumerate(tokens)]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens)) + _field(41, (1 << 64) - 1) + _field(42, (1 << 64) - 1) + _field(43, (1 << 64) - 1)
    normalizer = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes texts and decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.table = {b: c for b, c in enumerate(byte_characters())}
        back = {c: b for b, c in self.table.items()}
        self.pieces = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(ranks))]
        self.known: dict[str, bytes] = {}

    def _encode(self, tokens: list[str]) -> None:
        """Note the ids of pre-tokens, as little-endian bytes. One that is a token itself is that token, whether merges
        lead to it or not."""
        todo = []
        for t in tokens:
            raw = t.encode("utf-8", "surrogatepass")
            if (rank := self.ranks.get(raw)) is not None:
                self.known[t] = rank.to_bytes(4, "little")
            else:
                todo.append((t, raw.decode("latin-1").translate(self.table)))
        for (t, _), ids in zip(todo, self.model.encode([x for _, x in todo], num_threads=1), strict=True):
            self.known[t] = np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of the text as little-endian unsigned 32-bit integers."""
        tokens = self.split(text)
        if len(self.known) > _KEPT:
            self.known.clear()
        if new := [t for t in set(tokens) if t not in self.known]:
            self._encode(new)
        return b"".join(map(self.known.__getitem__, tokens))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, kept in the worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row. Null texts are empty; repeated rows each give one."""
    rows = narrow(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in few(batches):
            n, ids, decoded = [], [], []
            for text in batch["text"].to_pylist():
                found = own.encode(text or "")
                n.append(len(found) // 4)
                ids.append(hashlib.sha256(found).hexdigest())
                decoded.append(hashlib.sha256(own.decode(found)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of every row; ``ids`` are little-endian unsigned 32-bit integers."""
    rows = narrow(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in few(batches):
            ids = [own.encode(text or "") for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary")


def decoded(rows: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from the ids that ``encoded`` gives; bytes that aren't UTF-8 become U+FFFD."""
    got = narrow(rows, doc_id=id_col, ids=ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in few(batches):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([None if x is None else own.decode(x).decode("utf-8", "replace") for x in batch["ids"].to_pylist()], pa.string())], ["doc_id", "text"])

    return got.mapInArrow(run, f"doc_id {got.schema['doc_id'].dataType.simpleString()}, text string")
