"""Byte-level BPE with a sentencepiece model made from a file of ranks.

Each token's bytes are mapped to printable characters, one for each byte; the
piece scores minus its rank, so sentencepiece merges in the order of ranks. The
normaliser is the identity. The merges of different pre-tokens never meet:
each match of the pattern is encoded on its own.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import column_of, parts, plain

#: Pre-tokens whose ids a worker remembers, and the longest that it remembers.
CACHE, CACHED_LENGTH = 1 << 18, 48


def byte_characters() -> list[str]:
    """Printable bytes map to themselves, the others to code points from 256 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in kept else next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field in protocol-buffer wire format."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


# Field numbers and enum values of the public sentencepiece_model.proto (fixed values).
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _UNKNOWN = 1, 2
_MODEL_TYPE, _VOCAB_SIZE, _UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 3, 4, 40, 41, 42, 43
_BPE = 2
_NAME, _ADD_DUMMY_PREFIX, _REMOVE_EXTRA_WHITESPACES, _ESCAPE_WHITESPACES = 1, 3, 4, 5


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """The model file; piece ids equal ranks, and one more id is the unknown piece."""
    letters = byte_characters()
    by_rank = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    out = [
        _field(
            _PIECES,
            _field(_PIECE, "".join(letters[b] for b in token).encode()) + _field(_SCORE, float(-rank)) + _field(_TYPE, _NORMAL),
        )
        for token, rank in by_rank
    ]
    size = len(by_rank)
    out.append(_field(_PIECES, _field(_PIECE, b"<unk>") + _field(_SCORE, 0.0) + _field(_TYPE, _UNKNOWN)))
    out.append(
        _field(
            _TRAINER,
            _field(_MODEL_TYPE, _BPE)
            + _field(_VOCAB_SIZE, size + 1)
            + _field(_UNK_ID, size)
            + b"".join(_field(i, -1) for i in (_BOS_ID, _EOS_ID, _PAD_ID)),
        )
    )
    no = b"".join(_field(i, 0) for i in (_ADD_DUMMY_PREFIX, _REMOVE_EXTRA_WHITESPACES, _ESCAPE_WHITESPACES))
    out.append(_field(_NORMALIZER, _field(_NAME, b"identity") + no))
    return b"".join(out)


class ByteBpe:
    """Encodes and decodes whole texts; ids travel as little-endian 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.letters = byte_characters()
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.ranks))
        self.bytes_of = [token for token, _ in sorted(self.ranks.items(), key=lambda x: x[1])]
        self.known: dict[str, bytes] = {}

    def _encode_new(self, tokens: list[str]) -> list[bytes]:
        """A pre-token that is itself in the vocabulary is that one id."""
        raw = [t.encode() for t in tokens]
        merged = [i for i, t in enumerate(raw) if t not in self.ranks]
        mapped = [raw[i].decode("latin-1").translate(self.letters) for i in merged]
        found = dict(zip(merged, self.pieces.encode(mapped, num_threads=1) if mapped else []))
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (found[i] if i in found else [self.ranks[t]] for i, t in enumerate(raw))]

    def encode(self, text: str | None) -> bytes:
        tokens = self.split(text or "")
        if len(self.known) > CACHE:
            self.known.clear()
        known = self.known
        new = list(set(tokens).difference(known))
        long: dict[str, bytes] = {}
        for t, ids in zip(new, self._encode_new(new)):
            (known if len(t) <= CACHED_LENGTH else long)[t] = ids
        if long:
            return b"".join([known.get(t) or long[t] for t in tokens])
        return b"".join([known[t] for t in tokens])

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBpe:
    """One codec for each worker process."""
    return ByteBpe(path, pattern)


Batches = Iterable[pa.RecordBatch]


def encoder(path: str, pattern: str, column: str = "text") -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Batches to the same batches with ``ids`` instead of ``column``."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for part in parts(batches, column):
            found = [bpe.encode(t.as_py()) for t in column_of(part, column)]
            ends = np.cumsum([0, *[len(f) // 4 for f in found]]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))
            kept = [n for n in part.schema.names if n != column]
            yield pa.RecordBatch.from_arrays([*[column_of(part, n) for n in kept], ids], [*kept, "ids"])

    return run


def decoder(path: str, pattern: str) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Batches with ``ids`` to the same batches with ``decoded`` bytes added."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            texts = [bpe.decode(ids) for ids in id_lists(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])

    return run


def id_lists(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Each row's ids; a null row has none."""
    lists = column_of(batch, "ids")
    values, ends = np.asarray(lists.values).astype(np.int32, copy=False), np.asarray(lists.offsets)
    for i in range(len(lists)):
        yield values[ends[i] : ends[i + 1]] if lists.is_valid()[i].as_py() else values[:0]


def digests(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Encoded and decoded batches to doc_id, n_tokens and the two digests."""
    for batch in batches:
        ids = [i.astype("<u4").tobytes() for i in id_lists(batch)]
        decoded = column_of(batch, "decoded")
        yield pa.RecordBatch.from_arrays(
            [
                column_of(batch, "doc_id"),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                pa.array([hashlib.sha256(d.as_buffer()).hexdigest() for d in decoded]),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def encode(docs: DataFrame, path: str, pattern: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>) in place of ``column``; null encodes as empty."""
    kept = [f for f in docs.schema.fields if f.name not in (column, "ids")]
    rows = docs.select(*[f"`{f.name}`" for f in kept], f"`{column}`")
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(encoder(path, pattern, column), schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes of the original text."""
    kept = [f for f in encoded.schema.fields if f.name != "decoded"]
    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])
    return encoded.select(*[f"`{f.name}`" for f in kept]).mapInArrow(decoder(path, pattern), schema)


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row of ``docs``.

    Encoder, decoder and digests run over the same batch in one pass, so ids
    do not travel between processes. Null counts as empty; repeated rows and
    very long texts are rows like others; an empty table gives an empty one.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        return digests(decoder(path, pattern)(encoder(path, pattern)(batches)))

    return plain(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode_checked(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` and ``n_tokens`` in place of ``text``.

    Each text is decoded again in the same pass; a text that does not come back
    byte for byte is an error, not a row. A null text has no ids; empty and very
    long texts and repeated rows are rows like others, columns of ``docs`` that
    are named ``ids`` or ``n_tokens`` give way, and an empty table gives an
    empty one.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("text", "ids", "n_tokens")]
    rows = docs.select(*[f"`{f.name}`" for f in kept], "text")
    names = [f.name for f in kept]

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, "text"):
            [done] = decoder(path, pattern)(encoder(path, pattern)([part]))
            for text, decoded in zip(column_of(part, "text"), column_of(done, "decoded")):
                if (text.as_py() or "").encode() != decoded.as_py():
                    raise ValueError("a text does not survive encoding and decoding")
            lists = column_of(done, "ids")
            counts = pa.array(np.diff(np.asarray(lists.offsets)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*[column_of(part, n) for n in names], counts, lists], [*names, "n_tokens", "ids"])

    extra = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return rows.mapInArrow(run, T.StructType([*kept, *extra]))
