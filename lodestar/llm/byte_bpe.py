"""Byte-level BPE by a sentencepiece model that is written from a rank file.

Each byte stands for one printable character; a vocabulary entry becomes the
piece of its bytes' characters, scored by its negative rank, so the library's
best-score merge is the lowest-rank merge. Text is cut by the vocabulary's
pattern, and every pre-token is encoded by itself: a pre-token that is an entry
is that entry's id, any other goes through the model. Decoding maps ids to
pieces and characters back to bytes. Nothing is trained.

Defined results: null and empty text give no ids; repeated rows are encoded
alike; an empty table gives an empty table; an input column named like a result
column is replaced. A very long pre-token is one call of the model.

A batch of rows is worked on and handed back in pieces of ``PIECE`` bytes of
text (or ids), so that neither a task's lists of ids nor the batches that Spark
reads back grow with the rows of a batch; a longer text stands alone."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import textnum as T

CACHE_ENTRIES = 150_000
PIECE = 1 << 19

# The printable bytes stand for themselves, the others for the
# code points from 256 on, in ascending order.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHAR = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in set(_PRINTABLE))}
CHAR_BYTE = {c: b for b, c in BYTE_CHAR.items()}
_AS_CHARS = {b: c for b, c in BYTE_CHAR.items()}


def to_chars(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_AS_CHARS)


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value) -> bytes:
    """One protobuf field: int and bool as varint, float as 32 bit, else bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(int(value))
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: an unknown piece first, then all entries in rank
    order. Field numbers are those of the public model format: piece (1:
    piece, 2: score, 3: type), trainer (3: model type, 4: size, 40-43: special
    ids), normalizer (1: name, 3-5: space handling)."""
    pieces = [_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))]
    for raw, rank in sorted(ranks.items(), key=lambda x: x[1]):
        pieces.append(_field(1, _field(1, to_chars(raw)) + _field(2, float(-rank)) + _field(3, 1)))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, 0) + b"".join(_field(n, -1) for n in (41, 42, 43))
    plain = _field(1, "identity") + _field(3, False) + _field(4, False) + _field(5, False)
    return b"".join(pieces) + _field(2, trainer) + _field(3, plain)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = load_ranks(ranks_path)
        self.find = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.rank_of = sorted(ranks.values())
        self.entry = {raw: (rank,) for raw, rank in ranks.items()}
        size = max(self.rank_of, default=-1) + 1
        self.piece = [b""] * size
        for i, rank in enumerate(self.rank_of):
            self.piece[rank] = bytes(CHAR_BYTE[c] for c in self.model.id_to_piece(i + 1))
        self.decimal = [str(i) for i in range(size)]
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, tokens: Iterable[str]) -> None:
        """Encode pre-tokens and remember them."""
        tokens = list(tokens)
        raw = [t.encode() for t in tokens]
        rest = [(t, r) for t, r in zip(tokens, raw, strict=True) if r not in self.entry]
        self.known.update((t, self.entry[r]) for t, r in zip(tokens, raw, strict=True) if r in self.entry)
        rank_of = self.rank_of
        for (t, _), ids in zip(rest, self.model.encode([to_chars(r) for _, r in rest], num_threads=1) if rest else (), strict=True):
            self.known[t] = tuple([rank_of[i - 1] for i in ids])

    def encode(self, text: str) -> list[int]:
        tokens = self.find(text)
        if new := set(tokens).difference(self.known):
            if len(self.known) + len(new) > CACHE_ENTRIES:  # what is remembered is bounded: start again from this text
                self.known.clear()
                new = set(tokens)
            self._learn(new)
        return list(chain.from_iterable(map(self.known.__getitem__, tokens)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.piece.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec per Python worker and vocabulary."""
    return Codec(ranks_path, pattern)


def _texts(column: pa.Array) -> Iterator[str]:
    for x in column:
        yield x.as_py() or ""


def _pieces(b: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """``b`` in row ranges of at most ``PIECE`` bytes of a text column, or of a
    list column of 32-bit ids."""
    c = b.column(b.schema.get_field_index(column))
    size = pc.multiply(pc.list_value_length(c), 4) if pa.types.is_list(c.type) else pc.binary_length(c)
    edge = np.concatenate([[0], np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    for i, j in T.slices(edge, PIECE):
        yield b.slice(i, j - i)


def _with(df: DataFrame, add: dict[str, str], work, column: str) -> DataFrame:
    """``df`` with the columns of ``add`` (name to type), which ``work`` makes
    from pieces of record batches (by size of ``column``), in place of any of
    the same names."""
    kept = [c for c in df.columns if c not in add]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in kept]
                       + [f"`{k}` {v}" for k, v in add.items()])

    def run(batches):
        for b in chain.from_iterable(_pieces(x, column) for x in batches):
            made = work(b)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in kept] + made, kept + list(add))

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` array<int> and ``n_tokens``."""
    def work(b):
        c = codec(ranks_path, pattern)
        out = [c.encode(t) for t in _texts(b.column(b.schema.get_field_index(text)))]
        return [pa.array(out, pa.list_(pa.int32())), pa.array([len(x) for x in out], pa.int64())]

    return _with(docs, {ids: "array<int>", "n_tokens": "bigint"}, work, text)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that the ids stand for (null: empty)."""
    def work(b):
        c = codec(ranks_path, pattern)
        return [pa.array([c.decode(x.as_py() or ()) for x in b.column(b.schema.get_field_index(ids))], pa.binary())]

    return _with(encoded, {decoded: "binary"}, work, ids)


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass and keep the digests of both instead of
    the ids: n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256."""
    def work(b):
        c = codec(ranks_path, pattern)
        n, ids_sha, out_sha = [], [], []
        for t in _texts(b.column(b.schema.get_field_index(text))):
            ids = c.encode(t)
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
            out_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string())]

    return _with(docs, {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, work, text)


def encode_documents(spark, docs: DataFrame, sf_dir: str, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Pipeline stage: the documents with their ids."""
    import public_tokenizers as P

    return encode(docs, P.path(vocabulary), P.PATTERN)


def op6_byte_bpe(spark, sf_dir: str, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    import public_tokenizers as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip_digests(docs, P.path(vocabulary), P.PATTERN).drop("text")
