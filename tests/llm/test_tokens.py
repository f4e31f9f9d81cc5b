"""Operators 2 and 6 against the libraries, and exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from lodestar.llm import byte_bpe, huffman_ids
from lodestar.llm.staging import new_path

from . import cases

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
PIECES = ["the", "  ", "\n", " ing", "é", "é", "日本", "語", "🙂", "́", "123", "$", "\x00", "\x85", "\xa0", " ", "\x1c", " ",
          "'s", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "ΑΣ", "tion", "aaaaaaa", "abc.", "É,", "x!?", "3.", "K̈", "ẖ.", "H̱", "Ġ", "▁", "<unk>", "İ"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def odd_texts(n):
    rng = random.Random(3)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_serialised_model_encodes_as_the_rank_library(reference):
    c = byte_bpe.codec(RANKS, P.PATTERN)
    for t in odd_texts(1500) + ["x" * 3000, cases.prose(1, 500)]:
        assert c.encode(t) == reference.encode_ordinary(t)
        assert c.decode(c.encode(t)) == t.encode()


def test_letter_parts_go_to_the_model_alone(library, monkeypatch):
    """The same ids, without the library's other steps."""
    runs, whole = huffman_ids._Runs(WORDS, "<u2"), []
    monkeypatch.setattr(huffman_ids._Runs, "_encoded", lambda self, x, f=huffman_ids._Runs._encoded: whole.append(x) or f(self, x))
    text = "Straßen ÜBER the Élan, reinforced naïve àéîõü zzqxvw İstanbul x\u0301y don't 3rd ªº µ ÷ Ÿ ﬁn"
    assert np.frombuffer(runs.of(text.encode()), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    letters = {w.encode() for w in ("Straßen", "ÜBER", "the", "Élan", "reinforced", "naïve", "àéîõü", "zzqxvw")}
    assert not {x for w in letters for x in (w, w.lower())} & set(whole) and "İstanbul".encode() in whole


def test_codec_memory_stays_bounded(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 20)
    c = byte_bpe.Codec(RANKS, P.PATTERN)
    for t in odd_texts(200) + [cases.prose(2, 300)]:
        assert c.encode(t) == reference.encode_ordinary(t)


def test_byte_bpe_columns(spark, reference):
    from pyspark.sql import functions as F

    docs = cases.table(spark).withColumns({"ids": F.lit("clash"), "extra": F.lit(1)})
    enc = byte_bpe.encode(docs, RANKS, P.PATTERN)
    assert enc.columns.count("ids") == 1 and "extra" in enc.columns
    for r in byte_bpe.decode(enc, RANKS, P.PATTERN).collect():
        assert r["ids"] == reference.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids"])
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    for r in byte_bpe.round_trip_digests(cases.table(spark), RANKS, P.PATTERN).collect():
        ids = reference.encode_ordinary(r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert byte_bpe.encode(cases.table(spark, []), RANKS, P.PATTERN).count() == 0


def test_batches_are_worked_on_in_pieces(spark, reference, monkeypatch):
    """A batch's rows neither wait for each other nor come back at once."""
    import pyarrow as pa

    texts = [None, "", cases.prose(3, 900)] + odd_texts(200) + [None]
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, work, schema: work)
    monkeypatch.setattr(byte_bpe, "PIECE", 1000)
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    out = list(byte_bpe.encode(docs, RANKS, P.PATTERN)(iter([batch, batch.slice(0, 0)])))
    assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b["text"].to_pylist()) <= 1000 for b in out)
    rows = [r for b in out for r in b.to_pylist()]
    assert [(r["doc_id"], r["text"], r["ids"]) for r in rows] == [
        (i, t, reference.encode_ordinary(t or "")) for i, t in enumerate(texts)]
    encoded = spark.createDataFrame([], "doc_id bigint, ids array<int>")
    back = list(byte_bpe.decode(encoded, RANKS, P.PATTERN)(
        iter([pa.record_batch({"doc_id": batch["doc_id"], "ids": pa.array([r["ids"] for r in rows], pa.list_(pa.int32()))})])))
    assert len(back) > 1 and [x for b in back for x in b["decoded"].to_pylist()] == [(t or "").encode() for t in texts]
    digests = list(byte_bpe.round_trip_digests(docs, RANKS, P.PATTERN)(iter([batch])))
    assert len(digests) == len(out) and [x for b in digests for x in b["n_tokens"].to_pylist()] == [len(r["ids"]) for r in rows]


def test_runs_encode_as_the_whole_text(library):
    runs = huffman_ids._Runs(WORDS, "<u2")
    for t in odd_texts(1500) + [cases.prose(1, 500)]:
        got = np.frombuffer(runs.of(t.encode()), "<u2").tolist()
        assert got == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 40, 700):
        counts = rng.integers(0, 1000, size) ** 2
        counts[0] = 1
        lengths = huffman_ids.code_lengths(counts, 12)
        used = counts > 0
        assert (lengths[used] > 0).all() and (lengths[~used] == 0).all() and lengths.max() <= 12
        assert used.sum() < 2 or (2.0 ** -lengths[used]).sum() == pytest.approx(1.0)
    import heapq

    counts = rng.integers(1, 50, 30)
    heap, cost = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert (huffman_ids.code_lengths(counts, 30) * counts).sum() == cost
    skewed = 2 ** np.arange(30)
    lengths = huffman_ids.code_lengths(skewed, 6)
    assert lengths.max() == 6 and (2.0 ** -lengths).sum() == pytest.approx(1.0)
    with pytest.raises(ValueError):
        huffman_ids.code_lengths(np.ones(70), 6)


def test_block_round_trip():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 10_000, 3000)
    code = huffman_ids.Code(huffman_ids.code_lengths(counts, 14))
    known = np.flatnonzero(counts)
    docs = [rng.choice(known, n) for n in (0, 1, 255, 256, 257, 5000, 3, 0)]
    sizes = np.array([len(d) for d in docs])
    payload, offset, within = code.encode(np.concatenate(docs), sizes)
    edge = np.concatenate([[0], np.cumsum(sizes)])
    data = huffman_ids.pack([None, *range(1, 8)], sizes.tolist(),
                            [payload[i:j].tobytes() for i, j in zip(offset[:-1], offset[1:])],
                            [within[i + 256:j:256].astype("<u4").tobytes() for i, j in zip(edge[:-1], edge[1:])])
    ids, n, out = huffman_ids.unpack(data, code)
    assert ids == [None, *range(1, 8)] and n.tolist() == sizes.tolist()
    assert out.tolist() == np.concatenate(docs).tolist()


def test_files_hold_all_documents_in_order(spark, library):
    path = new_path(spark, "test-ids")
    huffman_ids.write_ids(cases.table(spark).select("doc_id", "text"), WORDS, path, 2, library.get_vocab_size())
    rows = sorted(cases.documents(), key=lambda r: -1 if r[0] is None else r[0])
    want, at = [], 0
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.append((r[0], at, ids))
        at += len(ids)
    got = sorted((r["start"], r["doc_id"], r["ids"]) for r in huffman_ids.read_ids(spark, path).collect())
    assert [(d, s, i) for s, d, i in got] == want
    for r in huffman_ids.read_digests(spark, path).collect():
        ids = next(i for d, s, i in want if s == r["start"])
        assert r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_empty_table_gives_empty_files(spark):
    path = new_path(spark, "test-ids")
    huffman_ids.write_ids(cases.table(spark, []).select("doc_id", "text"), WORDS, path, 2, 49408)
    assert huffman_ids.read_digests(spark, path).count() == 0
