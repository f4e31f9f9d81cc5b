"""Ranked lexical search with Block-Max MaxScore.

Terms are runs of letters, digits and bytes above 0x7F, A-Z lower-cased. A
document scores the sum over an item's terms of w * ((10^9 tf) div (1000 tf + 12 m)):
w = floor(1000 ln((2N + 2) / (2df + 1))), m = 75 + (25 n N) div L for a document of n
terms among N documents of L terms in all.

1. One pass over the texts gives N and L. A second writes, shard by shard (about
   ``SHARD`` bytes of text, or one longer text), an inverted index of all terms: a
   posting list is cut into blocks of ``BLOCK`` documents, gaps and tf in as few bytes as
   the block needs, with the last document and the highest tf factor of each
   block and of the list. Nothing is shuffled.
2. Items are dealt into groups of about ``GROUP_TERMS`` terms. Their terms are
   joined with the index, document frequencies summed to w, and a task
   searches a shard for a group: shards are dealt into as many cells by hash,
   every cell gets the group's weights.
3. Search: an item's lists are ordered by their global bounds (w times the
   list's highest factor). As long as the lists still to come could lift a new document
   to the k-th best score found so far, a list is essential and read whole.
   All other lists are only looked up for the documents found: one whose
   score, with the bound of its own block and those of the lists to come, stays
   under the k-th best is rejected before any block is decompressed, and blocks without
   such a document never are.
4. Each shard's k best are merged by score, then document.

Bounds reject only documents strictly below the k-th best, so ties stay exact.
Scores are 64-bit integers.

Defined results: null and empty text have no terms and aren't counted in N; a null doc_id
takes no part; each row is a document, also one that repeats another's id; an
item with a null id or without known terms finds nothing; rows that repeat an
item count once, an id with two texts ranks for each text; an empty table
gives an empty table; further columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textnum as T
from .staging import stage

BLOCK = 128
SHARD = 4 << 20
#: terms (with repeats) of the items that are searched together
GROUP_TERMS = 1 << 18
_OUTSIDE = T.byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_WIDTHS = (1, 2, 4)
_LIST = ["term", "df", "top", "last", "best", "code"]
_INDEX = "shard bigint, term string, df bigint, top bigint, last binary, best binary, code binary"


# ---- posting lists -----------------------------------------------------------

def _width(high: np.ndarray) -> np.ndarray:
    """Bytes that hold numbers up to ``high``."""
    return np.where(high < 1 << 8, 1, np.where(high < 1 << 16, 2, 4))


class Postings:
    """The posting lists of one shard, written block by block.

    ``doc``, ``tf``: all postings, list after list (``edge``), documents
    ascending within a list; ``factor``: their tf factors."""

    def __init__(self, edge: np.ndarray, doc: np.ndarray, tf: np.ndarray, factor: np.ndarray):
        size = np.diff(edge)
        blocks = -(-size // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(blocks)])
        of = np.repeat(np.arange(len(size)), blocks)
        number = np.arange(len(of)) - self.first[:-1][of]
        start = edge[:-1][of] + number * BLOCK
        stop = np.minimum(start + BLOCK, edge[1:][of])
        self.last = doc[stop - 1].astype(np.int32)
        self.best = np.maximum.reduceat(factor, start) if len(start) else factor[:0]
        gap = doc.copy()
        gap[1:] -= doc[:-1]
        gap[edge[:-1]] = doc[edge[:-1]]
        inner = gap.copy()
        inner[start] = 0        # a block's first document follows from the block before
        lead = gap[start]
        high = lambda x: np.maximum.reduceat(x, start) if len(start) else x[:0]
        gap_width, tf_width = _width(np.maximum(high(inner), lead)), _width(high(tf))
        self.width = (gap_width * 8 + tf_width).astype(np.uint8)
        count = stop - start
        place = np.concatenate([[0], np.cumsum(count * (gap_width + tf_width))])
        data = np.zeros(place[-1], np.uint8)
        for width_of, values, base in ((gap_width, gap, place[:-1]), (tf_width, tf, place[:-1] + count * gap_width)):
            for w in _WIDTHS:
                at = np.flatnonzero(width_of == w)
                inside = np.arange(count[at].sum()) - np.repeat(np.cumsum(count[at]) - count[at], count[at])
                raw = values[np.repeat(start[at], count[at]) + inside].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :w]
                data[(np.repeat(base[at], count[at]) + inside * w)[:, None] + np.arange(w)] = raw
        self.data, self.place = data, place

    def row(self, i: int) -> tuple[bytes, bytes, bytes]:
        """(last documents, highest factors, code) of list ``i``; the code is
        the blocks' widths and then the blocks."""
        a, b = self.first[i], self.first[i + 1]
        return (self.last[a:b].tobytes(), self.best[a:b].astype(np.int32).tobytes(),
                self.width[a:b].tobytes() + self.data[self.place[a]:self.place[b]].tobytes())


class PostingList:
    """A list read from the index; ``read`` decompresses the blocks asked for."""

    def __init__(self, df: int, top: int, last: bytes, best: bytes, code: bytes):
        self.df, self.top = df, top
        self.last, self.best = np.frombuffer(last, np.int32).astype(np.int64), np.frombuffer(best, np.int32).astype(np.int64)
        n, raw = len(self.last), np.frombuffer(code, np.uint8)
        self.width, self.data = raw[:n], raw[n:]
        self.count = np.full(n, BLOCK)
        self.count[-1] = df - BLOCK * (n - 1)
        per = self.count * (self.width // 8 + self.width % 8)
        self.place = np.cumsum(per) - per
        self.before = np.concatenate([[0], self.last[:-1]])

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, tf) of the given blocks (ascending)."""
        count = self.count[blocks]
        edge = np.cumsum(count) - count
        gap, tf = np.empty(count.sum(), np.int64), np.empty(count.sum(), np.int64)
        gap_width, tf_width = self.width[blocks] // 8, self.width[blocks] % 8
        for out, width_of, base in ((gap, gap_width, self.place[blocks]), (tf, tf_width, self.place[blocks] + count * gap_width)):
            for w in _WIDTHS:
                at = np.flatnonzero(width_of == w)
                if not len(at):
                    continue
                n = count[at]
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                wide = np.zeros((len(inside), 4), np.uint8)
                wide[:, :w] = self.data[(np.repeat(base[at], n) + inside * w)[:, None] + np.arange(w)]
                out[np.repeat(edge[at], n) + inside] = wide.view("<u4").reshape(-1)
        doc = np.cumsum(gap)
        doc += np.repeat(self.before[blocks] - (doc[edge] - gap[edge]), count)
        return doc, tf


def tf_factor(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


# ---- search in a shard ---------------------------------------------------------

def search(lists: list[PostingList], weights: list[int], m: np.ndarray, k: int, read=None) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``k`` best of a shard, ties to smaller
    documents. ``weights``: w times the term's repeats in the item. ``read``
    collects the numbers of blocks decompressed and held, for tests."""
    bound = np.array([x.top * w for x, w in zip(lists, weights, strict=True)], np.int64)
    order = np.argsort(-bound, kind="stable")
    coming = np.append(np.cumsum(bound[order][::-1])[::-1], 0)      # bounds of a list and of all after it
    score = np.zeros(len(m), np.int64)
    found, floor, essential = np.zeros(len(m), bool), 1, True
    alive = None
    for at, i in enumerate(order):
        one, w = lists[i], weights[i]
        if essential and coming[at] < floor:
            essential = False
            alive = np.flatnonzero(found)
        if essential:
            doc, tf = one.read(np.arange(len(one.last)))
            score[doc] += w * tf_factor(tf, m[doc])
            found[doc] = True
            some = score[found] if at + 1 < len(order) else score[:0]
            n_read = len(one.last)
        else:
            alive = alive[score[alive] + coming[at] >= floor]
            block = np.searchsorted(one.last, alive)
            inside = block < len(one.last)
            high = np.where(inside, one.best[np.minimum(block, len(one.last) - 1)] * w, 0)
            could = score[alive] + high + coming[at + 1] >= floor
            alive, block, inside = alive[could], block[could], inside[could]
            need = np.unique(block[inside])
            if len(need):
                doc, tf = one.read(need)
                where = np.minimum(np.searchsorted(doc, alive), len(doc) - 1)
                hit = doc[where] == alive
                score[alive[hit]] += w * tf_factor(tf[where[hit]], m[alive[hit]])
            some, n_read = score[alive], len(need)
        if read is not None:
            read.append((n_read, len(one.last)))
        if len(some) >= k:
            floor = max(floor, int(np.partition(some, len(some) - k)[len(some) - k]))
    doc = np.flatnonzero(found) if alive is None else alive
    doc = doc[score[doc] >= floor]
    return (best := doc[np.lexsort((doc, -score[doc]))][:k]), score[best]


# ---- index -----------------------------------------------------------------------

def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw, offsets = T.byte_view(texts)
    raw = T.lower(raw)
    return raw, *T.words(raw, offsets, _OUTSIDE)


def corpus_size(rows: DataFrame) -> tuple[int, int]:
    """(N, L) of ``rows`` (doc_id, text)."""
    def run(batches):
        for b in batches:
            texts = T.string_array(b.column(1))
            for i, j in T.slices(T.byte_view(texts)[1]):
                n = np.bincount(_terms(texts.slice(i, j - i))[3], minlength=j - i)
                yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["n", "l"])

    got = rows.mapInArrow(run, "n bigint, l bigint").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return got["n"] or 0, got["l"] or 0


def build_index(rows: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Rows of ``_INDEX``, one per shard and term, and one per shard with a
    null term: its documents' ids (in ``last``) and m (in ``code``)."""
    def lengths(n: np.ndarray) -> np.ndarray:
        if int(n.max(initial=0)) * n_docs * 25 >= 2**63:
            return np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)
        return 75 + 25 * n * n_docs // n_terms

    def written(shard, ids, texts):
        by = np.argsort(ids, kind="stable")
        raw, starts, ends, row = _terms(texts.take(pa.array(by)))
        m = lengths(np.bincount(row, minlength=len(by)))
        coded = T.word_strings(raw, starts, ends).dictionary_encode()
        del raw, starts, ends
        key = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(by) + row
        key.sort()
        head = np.flatnonzero(np.diff(key, prepend=-1))
        term, doc = np.divmod(key[head], len(by))
        tf = np.diff(head, append=len(key))
        del key, head, row
        lists = len(coded.dictionary)
        edge = np.searchsorted(term, np.arange(lists + 1))
        del term
        factor = tf_factor(tf, m[doc])
        made = Postings(edge, doc, tf, factor)
        top = np.maximum.reduceat(factor, edge[:-1]) if lists else factor
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([None], pa.string()), pa.array([len(by)]), pa.array([0]),
             pa.array([ids[by].tobytes()], pa.binary()), pa.array([b""], pa.binary()), pa.array([m.tobytes()], pa.binary())],
            ["shard", "term", "df", "top", "last", "best", "code"])
        for a in range(0, lists, 1 << 14):
            z = min(lists, a + (1 << 14))
            coded_rows = [made.row(i) for i in range(a, z)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(z - a, shard)), coded.dictionary.slice(a, z - a).cast(pa.string()), pa.array(np.diff(edge)[a:z]),
                 pa.array(top[a:z]), *(pa.array([x[i] for x in coded_rows], pa.binary()) for i in range(3))],
                ["shard", "term", "df", "top", "last", "best", "code"])

    def run(batches):
        shard, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            column = T.string_array(b.column(1))
            offsets = T.byte_view(column)[1]
            for i, j in T.slices(offsets, SHARD):
                more = int(offsets[j] - offsets[i])
                if size and size + more > SHARD:
                    yield from written(shard, np.concatenate(ids), pa.concat_arrays(texts))
                    shard, ids, texts, size = shard + 1, [], [], 0
                ids.append(b.column(0).slice(i, j - i).to_numpy(zero_copy_only=False))
                texts.append(column.slice(i, j - i))
                size += more
        if ids:
            yield from written(shard, np.concatenate(ids), pa.concat_arrays(texts))

    return rows.mapInArrow(run, _INDEX)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _all(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def item_terms(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, int]:
    """(item_id, key, group, term, repeats) of the distinct items, and the
    number of groups."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    rows = (items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
            .distinct().withColumn("key", F.xxhash64("item_id", "text"))
            .withColumn("terms", F.regexp_extract_all(_lower(F.col("text")), F.lit(pattern), F.lit(0))))
    groups = max(1, -(-(rows.agg(F.sum(F.size("terms"))).first()[0] or 0) // GROUP_TERMS))
    return (rows.select("item_id", "key", F.pmod("key", F.lit(groups)).cast("int").alias("group"), F.explode("terms").alias("term"))
            .groupBy("item_id", "key", "group", "term").agg(F.count(F.lit(1)).alias("repeats"))), groups


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    n_docs, n_terms = corpus_size(rows)
    index = stage(build_index(rows, n_docs, n_terms), "posting-lists")
    asked, n_groups = item_terms(items, item_id, item_text)
    asked = stage(asked, "item-terms")
    df = index.join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("n"))
    weight = F.floor(1000 * F.log((F.lit(2.0 * n_docs + 2)) / (2 * F.col("n") + 1)))
    queries = stage(asked.join(df.select("term", weight.alias("w")), "term")
                    .select("item_id", "key", "group", "term", (F.col("w") * F.col("repeats")).alias("w")), "item-weights")
    n_shards = max(1, index.where("term IS NULL").count())
    cell_of = F.pmod(F.xxhash64("shard"), F.lit(n_shards)).cast("int").alias("cell")
    wanted = queries.select("term", F.col("group").alias("of")).distinct()
    here = (index.join(wanted, "term").select(F.col("of").alias("group"), cell_of, "shard", *_LIST).unionByName(
        index.where("term IS NULL").select(_all(n_groups).alias("group"), cell_of, "shard", *_LIST)))
    asked_here = queries.select("group", _all(n_shards).alias("cell"), "item_id", "key", "term", "w")

    def found(index_rows: pa.Table, items: pa.Table) -> pa.Table:
        out = {"item_id": [], "key": [], "doc_id": [], "score": []}
        shards, of = {}, {}
        for shard, term, df, top, last, best, code in zip(*(index_rows[c].to_pylist() for c in ["shard", *_LIST]), strict=True):
            shards.setdefault(shard, {})[term] = (
                (np.frombuffer(last, np.int64), np.frombuffer(code, np.int64)) if term is None else PostingList(df, top, last, best, code))
        for item, key, term, w in zip(*(items[c].to_pylist() for c in ("item_id", "key", "term", "w")), strict=True):
            of.setdefault((item, key), []).append((term, w))
        for lists in shards.values():
            ids, m = lists[None]
            for (item, key), terms in of.items():
                if known := [(lists[t], w) for t, w in terms if t in lists]:
                    doc, score = search(*map(list, zip(*known, strict=True)), m, k)
                    out["item_id"] += [item] * len(doc)
                    out["key"] += [key] * len(doc)
                    out["doc_id"] += ids[doc].tolist()
                    out["score"] += score.tolist()
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    best = (here.groupBy("group", "cell").cogroup(asked_here.groupBy("group", "cell"))
            .applyInArrow(found, "item_id bigint, key bigint, doc_id bigint, score bigint"))
    rank = F.row_number().over(W.partitionBy("item_id", "key").orderBy(F.desc("score"), "doc_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_block_max_search(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return ranked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
b AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
q AS (SELECT item_id, term, count(*) AS c FROM b GROUP BY ALL),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(ts)) AS BIGINT) AS l FROM d WHERE len(ts) > 0),
m AS (SELECT doc_id, 75 + (25 * len(ts) * s.n) // s.l AS m FROM d, s WHERE len(ts) > 0),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * s.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, s.n),
r AS (SELECT q.item_id, p.doc_id, CAST(sum(q.c * f.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * m.m))) AS BIGINT) AS score
      FROM q JOIN p ON q.term = p.term JOIN f ON f.term = p.term JOIN m ON m.doc_id = p.doc_id GROUP BY 1, 2),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""
