"""Token ids in canonical length-limited Huffman code.

File format (a folder of Parquet tables, so that any store Spark reads can
hold it):

``codebook``  id, bits: the code length of each id that occurs. Codes are
              canonical: in order of (bits, id), each code is the one before
              plus one, shifted to its length.
``blocks``    part, block, first, n_ids, data: documents in ascending order of
              doc_id over (part, block). ``first`` counts the ids before the
              block within its part. A block decodes by itself.

``data`` is little-endian: n_docs, n_checkpoints, n_payload (uint32 each); per
document: doc_id (int64), flag 1 for a null doc_id (uint8), n_ids, byte offset
in the payload (uint32 each); per checkpoint the bit offset from the
document's start (uint32); the payload, every document from a whole byte, codes
with their highest bit first. A document has a checkpoint after every
``STEP`` ids, in document order.

The counts cover all ids; code lengths come from package-merge on at most one
weight per vocabulary entry. Decoding looks ``max_bits`` bits up in one table,
for all documents and checkpoints of a block side by side."""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import category, normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .staging import new_path, stage

STEP = 256
BLOCK_IDS = 1 << 17
MAX_BITS = 18
RUN_ENTRIES = 150_000
PART_ENTRIES = 450_000
ENCODE_IDS = 1 << 20
PUNCTUATION = b".,;:!?#$%&*"
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


# ---- code ------------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (0 for a count of 0)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids don't fit codes of {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = np.asarray(counts, np.int64)[order]
    n, level, is_leaf = len(order), np.asarray(counts, np.int64)[order], []
    is_leaf.append(np.ones(n, bool))
    for _ in range(max_bits - 1):
        pairs = level[0:len(level) // 2 * 2:2] + level[1::2]
        both = np.concatenate([weight, pairs])
        by = np.argsort(both, kind="stable")
        level = both[by]
        is_leaf.append(by < n)
    length, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):
        a = int(leaf[:take].sum())
        length[:a] += 1
        take = 2 * (take - a)
    out[order] = length
    return out


class Code:
    """Canonical codes, and the decoding table, of code lengths by id."""

    def __init__(self, length: np.ndarray):
        self.length = np.asarray(length, np.int64)
        self.code = np.zeros(len(length), np.uint64)
        ids = np.flatnonzero(length)
        ids = ids[np.lexsort((ids, self.length[ids]))]
        self.bits = int(self.length.max(initial=1))
        width = np.int64(1) << (self.bits - self.length[ids])
        start = np.cumsum(width) - width
        self.code[ids] = (start >> (self.bits - self.length[ids])).astype(np.uint64)
        self.symbol = np.zeros(1 << self.bits, np.int32)
        self.step = np.ones(1 << self.bits, np.int64)
        self.symbol[:int(width.sum())] = np.repeat(ids, width)
        self.step[:int(width.sum())] = np.repeat(self.length[ids], width)

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(payload bytes, byte offsets of the documents, bit position of each
        id from its document's start); documents start on whole bytes."""
        length = self.length[ids]
        total = np.concatenate([[0], np.cumsum(length)])
        edge = np.concatenate([[0], np.cumsum(sizes)])
        doc_bits = total[edge[1:]] - total[edge[:-1]]
        offset = np.concatenate([[0], np.cumsum((doc_bits + 7) // 8)])
        within = total[:-1] - np.repeat(total[edge[:-1]], sizes)
        at = within + np.repeat(offset[:-1] * 8, sizes)
        words = np.zeros(int(offset[-1]) // 8 + 2, np.uint64)
        if len(ids):
            word, end = at >> 6, (at & 63) + length
            code = self.code[ids]
            over = end > 64
            first = np.where(over, code >> np.where(over, end - 64, 0).astype(np.uint64),
                             code << np.where(over, 0, 64 - end).astype(np.uint64))
            head = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[head]] = np.bitwise_or.reduceat(first, head)
            words[word[over] + 1] |= code[over] << (128 - end[over]).astype(np.uint64)
        return words.byteswap().view(np.uint8)[:int(offset[-1])], offset, within

    def decode(self, payload: np.ndarray, start_bit: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Ids of all lanes (a document or a checkpoint each), lane by lane."""
        out_at = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(int(out_at[-1]), np.int32)
        b = np.concatenate([payload, np.zeros(8, np.uint8)]).astype(np.uint32)
        window = b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
        by = np.argsort(-count, kind="stable")
        at, put = start_bit[by].astype(np.int64), out_at[:-1][by]
        alive = np.searchsorted(-count[by], -np.arange(int(count.max(initial=0))), "left")
        shift, mask = 32 - self.bits, (1 << self.bits) - 1
        for k, n in enumerate(alive):
            pos = at[:n]
            v = (window[pos >> 3] >> (shift - (pos & 7))) & mask
            out[put[:n] + k] = self.symbol[v]
            at[:n] = pos + self.step[v]
        return out


# ---- tokenising ------------------------------------------------------------

class _Runs(dict):
    """Ids of each run of text without white space, by the library, as bytes.

    The vocabulary's normaliser and pre-tokeniser never join characters over
    ASCII white space, nor a letter or digit with ASCII punctuation behind it;
    ASCII letters are lower-cased. So a text's ids are those of its runs, and a
    run's those of its body and its closing punctuation. A run that holds one of
    the vocabulary's added tokens, which the library looks for before anything
    else, is left whole, as written. Parts of Latin letters go to the library's
    model as they are, where the vocabulary's normaliser and pre-tokeniser do no more than
    lower and map them (``_plain``). What is remembered is bounded: runs are
    forgotten all at once, parts in two generations."""

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.code, self.tokenizer = {2: "H", 4: "I"}[np.dtype(kind).itemsize], Tokenizer.from_file(path)
        self.marks = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.plain = self.tokenizer.model, _plain(self.tokenizer)
        self.recent: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def added(self, low: bytes) -> bool:
        return any(mark in low for mark in self.marks)

    def of(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        low = text.lower()
        if self.added(low):
            return b"".join([self._encoded(x) if self.added(x.lower()) else self[x] for x in text.split()])
        return b"".join(map(self.__getitem__, (low if text.isascii() else text).split()))

    def __missing__(self, run: bytes) -> bytes:
        if len(self) >= RUN_ENTRIES:
            self.clear()
        low = run.lower() if run.isascii() else run
        body = low.rstrip(PUNCTUATION)
        if body and len(body) < len(low) and _letter_or_digit(body):
            closing = low[len(body):]
            out = (self.recent.get(body) or self._part(body)) + (self.recent.get(closing) or self._part(closing))
        else:
            out = self.recent.get(low) or self._part(low)
        self[run] = out
        return out

    def _encoded(self, part: bytes) -> bytes:
        return array(self.code, self.tokenizer.encode(part.decode(), None, False, False).ids).tobytes()

    def _part(self, part: bytes) -> bytes:
        """The ids of a part that ``recent`` doesn't hold."""
        out = self.before.get(part)
        if out is None:
            text = part.decode()
            if self.plain and LETTERS.fullmatch(text):
                out = array(self.code, [t.id for t in self.model.tokenize(text.translate(self.plain))]).tobytes()
            else:
                out = self._encoded(part)
        if len(self.recent) >= PART_ENTRIES:
            self.before, self.recent = self.recent, {}
        self.recent[part] = out
        return out


def _plain(tokenizer) -> dict[int, str] | None:
    """What the model is given for each of the letters of ``LETTERS``, by code
    point; None if a part of such letters is not just their mapped lower-case
    forms, in one piece."""
    letters = [chr(c) for c in range(0x100) if LETTERS.fullmatch(chr(c))]
    before, cut = tokenizer.normalizer, tokenizer.pre_tokenizer
    if before is None or cut is None or tokenizer.post_processor is not None or tokenizer.truncation or tokenizer.padding:
        return None

    def pieces(text: str) -> list[str]:
        return [piece for piece, _ in cut.pre_tokenize_str(before.normalize_str(text))]

    out = {ord(c): "".join(pieces(c)) for c in letters}
    # every two letters stand side by side in it
    text = "".join(a + b for a in letters for b in letters)
    return out if pieces(text) == [text.translate(out)] else None


def _letter_or_digit(body: bytes) -> bool:
    """Whether the text ends with one, as the normaliser leaves it."""
    if body[-1] < 128:
        return body[-1:].isalnum()
    return category(normalize("NFC", body.decode()).lower()[-1])[0] in "LN"


@lru_cache(maxsize=2)
def _runs(path: str, kind: str) -> _Runs:
    return _Runs(path, kind)


def tokenize(docs: DataFrame, path: str, end_id: int, kind: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (the ids as ``kind`` integers, with ``end_id``), a value
    that orders documents of the same doc_id, and in one row of each batch the
    (id, count) pairs of the batch's ids."""
    end = np.array([end_id], kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            of = _runs(path, kind).of
            ids = [of(t.as_py() or b"") + end for t in b.column(1).cast(pa.large_binary())]
            total = np.bincount(np.frombuffer(b"".join(ids), kind))
            at = np.flatnonzero(total)
            pairs = [np.stack([at, total[at]]).astype("<i8").tobytes()] if ids else []
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.binary()), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                 pa.array(pairs + [None] * (len(ids) - len(pairs)), pa.binary())], ["doc_id", "ids", "tie", "counts"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, ids binary, tie bigint, counts binary")


def id_counts(tokens: DataFrame) -> DataFrame:
    """(id, n) over all documents; a task sends each id at most once."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for pairs in b.column(0).to_pylist():
                at, n = np.frombuffer(pairs, "<i8").reshape(2, -1)
                if len(total) <= at[-1]:
                    total = np.concatenate([total, np.zeros(at[-1] + 1 - len(total), np.int64)])
                total[at] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    return (tokens.select("counts").where("counts IS NOT NULL").mapInArrow(run, "id bigint, n bigint")
            .groupBy("id").agg(F.sum("n").alias("n")))


# ---- files -----------------------------------------------------------------

def _encoded(tokens: DataFrame, code, kind: str) -> DataFrame:
    """Per document: n, its code bits and its checkpoints."""
    width = np.dtype(kind).itemsize

    def one(b):
        raw = b.column(1).to_pylist()
        sizes = np.array([len(x) // width for x in raw], np.int64)
        payload, offset, within = code.value.encode(np.frombuffer(b"".join(raw), kind).astype(np.int64), sizes)
        data, edge = payload.tobytes(), np.concatenate([[0], np.cumsum(sizes)])
        marks = [within[i + STEP:j:STEP].astype("<u4").tobytes() for i, j in zip(edge[:-1], edge[1:], strict=True)]
        return pa.RecordBatch.from_arrays([
            b.column(0), b.column(2), pa.array(sizes, pa.int64()),
            pa.array([data[i:j] for i, j in zip(offset[:-1], offset[1:], strict=True)], pa.binary()),
            pa.array(marks, pa.binary())], ["doc_id", "tie", "n", "bits", "checkpoints"])

    def run(batches):
        for b in batches:
            ends = np.cumsum([len(x.as_buffer() or b"") for x in b.column(1)])
            i = 0
            while i < len(b):  # a bounded number of ids at a time
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + ENCODE_IDS * width, "right")))
                yield one(b.slice(i, j - i))
                i = j

    return tokens.mapInArrow(run, "doc_id bigint, tie bigint, n bigint, bits binary, checkpoints binary")


def pack(doc_ids: list, n: list[int], bits: list[bytes], checkpoints: list[bytes]) -> bytes:
    offset = np.cumsum([0, *map(len, bits)])
    marks = b"".join(checkpoints)
    return b"".join([
        struct.pack("<3I", len(n), len(marks) // 4, int(offset[-1])),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(),
        np.array(n, "<u4").tobytes(), offset[:-1].astype("<u4").tobytes(), marks, *bits])


def unpack(data: bytes, code: Code) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc_ids, ids per document, all ids) of a block."""
    n_docs, n_marks, n_payload = struct.unpack_from("<3I", data)
    at = 12

    def part(kind, n):
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    doc_ids, absent = part("<i8", n_docs), part("u1", n_docs)
    n, offset, marks = part("<u4", n_docs).astype(np.int64), part("<u4", n_docs), part("<u4", n_marks)
    lanes = (n + STEP - 1) // STEP
    first = np.cumsum(lanes) - lanes
    inner = np.ones(int(lanes.sum()), bool)
    inner[first[lanes > 0]] = False
    bit = np.zeros(len(inner), np.int64)
    bit[inner] = marks
    bit += np.repeat(offset.astype(np.int64) * 8, lanes)
    count = np.full(len(inner), STEP, np.int64)
    last = (first + lanes - 1)[lanes > 0]
    count[last] = (n - (lanes - 1) * STEP)[lanes > 0]
    ids = code.decode(part("u1", n_payload), bit, count)
    return [None if z else int(d) for d, z in zip(doc_ids, absent, strict=True)], n, ids


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, end_id: int, vocabulary: int,
              max_bits: int = MAX_BITS) -> None:
    """Tokenise ``docs`` and write the file format above under ``path``."""
    spark = docs.sparkSession
    kind = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    tokens = tokenize(docs, tokenizer_path, end_id, kind)
    with_zstd = new_path(spark, "token-ids")
    tokens.write.option("compression", "zstd").parquet(with_zstd)
    tokens = spark.read.schema(tokens.schema).parquet(with_zstd)

    counts = np.zeros(max(vocabulary, end_id + 1), np.int64)
    for r in id_counts(tokens).collect():  # at most one row per vocabulary entry
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts, max_bits)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id bigint, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    code = spark.sparkContext.broadcast(Code(lengths))

    def blocks(batches):
        part, block, first, held = 0, 0, 0, ([], [], [], [])
        for b in batches:
            for p, d, n, bits, marks in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if p != part:
                    if held[0]:
                        yield one(part, block, first, held)
                    part, block, first, held = p, 0, 0, ([], [], [], [])
                for to, x in zip(held, (d, n, bits, marks), strict=True):
                    to.append(x)
                if sum_of(held) >= BLOCK_IDS:
                    yield one(part, block, first, held)
                    block, first, held = block + 1, first + sum_of(held), ([], [], [], [])
        if held[0]:
            yield one(part, block, first, held)

    def sum_of(held):
        return sum(held[1])

    def one(part, block, first, held):
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()),
                                           "first": pa.array([first], pa.int64()), "n_ids": pa.array([sum(held[1])], pa.int64()),
                                           "data": pa.array([pack(*held)], pa.binary())})

    # ranges of doc_id by quantiles (one row), so that nothing is encoded twice to find them
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = tokens.agg(F.percentile_approx("doc_id", [i / n_parts for i in range(1, n_parts)] or [0.5], 100 * n_parts)).first()[0] or []
    part = F.coalesce(F.size(F.filter(F.lit(sorted(set(cuts))).cast("array<bigint>"), lambda c: c < F.col("doc_id"))), F.lit(0))
    ordered = (_encoded(tokens, code, kind).withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(part))
               .repartition(n_parts, "part").sortWithinPartitions("part", "doc_id", "tie"))
    (ordered.select("part", "doc_id", "n", "bits", "checkpoints")
     .mapInArrow(blocks, "part int, block int, first bigint, n_ids bigint, data binary")
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_ids(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids, from the files."""
    return _read(spark, path, "ids array<int>", lambda ids: pa.array(ids, pa.list_(pa.int32())))


def read_digests(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, from the files."""
    crc = lambda ids: pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())
    return _read(spark, path, "ids_crc32 bigint", crc)


def _read(spark, path: str, column: str, made) -> DataFrame:
    book = spark.read.schema("id bigint, bits int").parquet(f"{path}/codebook").collect()
    lengths = np.zeros(max((r["id"] for r in book), default=0) + 1, np.int64)
    for r in book:
        lengths[r["id"]] = r["bits"]
    code = spark.sparkContext.broadcast(Code(lengths))
    blocks = spark.read.schema("part int, block int, first bigint, n_ids bigint, data binary").parquet(f"{path}/blocks")
    # one row per range of doc_ids: bounded by the number of partitions
    parts = (blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .withColumn("part_start", F.sum("n").over(W.orderBy("part")) - F.col("n")).drop("n"))

    def run(batches):
        for b in batches:
            for first, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                doc_ids, n, ids = unpack(data, code.value)
                start = first + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                     made(np.split(ids, np.cumsum(n)[:-1]))], ["doc_id", "start", "n_tokens", column.split()[0]])

    placed = blocks.join(F.broadcast(parts), "part").select((F.col("part_start") + F.col("first")).alias("first"), "data")
    return placed.mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint, {column}")


def op2_huffman_ids(spark, sf_dir: str, vocabulary: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    """Null and empty text: the end id alone. Equal doc_ids are ordered by
    their ids' checksum; a null doc_id comes first; an empty table gives an
    empty file."""
    import public_tokenizers as P
    from tokenizers import Tokenizer

    path = new_path(spark, "huffman-ids")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    size = Tokenizer.from_file(P.path(vocabulary)).get_vocab_size()
    write_ids(docs, P.path(vocabulary), path, end_id, size)
    return read_digests(spark, path)
