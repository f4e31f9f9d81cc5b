"""Line deduplication with a bound of one edit, by deletion neighbourhoods.

A line (split at line feeds) with a word in it goes when a line within
``max_edits`` (0 or 1) inserted, deleted or replaced characters stands earlier in
the corpus (``min_near``: lines of fewer characters must be equal; 0, the default,
treats all lines alike); order is by (doc_id, hash of the text, line number). The earliest
line of each kind stays, other lines stay as they are.

Equal lines are found by hash. For near lines, the deletion neighbourhood of a
line is the line less each one of its characters; the variants are hashed keys
with what makes equal keys mean one edit (replaced at the same place, or one
line the other less a character), each key's earliest line is the partner of
the others, and the pair's edit distance is verified on the texts. So a group
of thousands of near lines costs a row per variant, never a row per pair.

Only lines that can have a partner get that far: lines within one edit agree
in all but one of any few segments, so lines alone with all their "all but one
segment" keys are left out, first with 2 segments and then with ``SEGMENTS``;
what is left of a line's neighbourhood are the places in segments that it shares
all others around.
The first answer goes back to the texts as a fixed-size bit filter of line
hashes (``FILTER_BITS``); what it lets through by chance is removed by an exact
join.

Defined results: null and empty text have no lines and stay; lines of white
space stay; rows that repeat a doc_id and its text share one fate; a null doc_id
comes first; an empty table gives an empty table; further columns are carried,
but for n_lines and n_removed, which are replaced. Line hashes have 64 bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnum as T
from .staging import release, stage

SEGMENTS = 32
FILTER_BITS = 25
U = np.uint64
_CODE = None


def code_hashes(text: str) -> np.ndarray:
    """A 64-bit number per code point."""
    global _CODE
    if _CODE is None:
        _CODE = T.mix(np.arange(1, 0x110001, dtype=np.uint64)) | U(1)
    return _CODE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


class Lines:
    """All lines of some texts that hold a word, with O(1) hashes of slices."""

    def __init__(self, texts: list[str], whole: bool = False):
        joined = "".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        edge = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.sums = T.prefix_hashes(code_hashes(joined))
        self.inverse = T.powers(len(code) + 1)[1]
        feed = np.zeros(0, np.int64) if whole else np.flatnonzero(code == 10)
        row = np.searchsorted(edge, feed, "right") - 1
        # line starts: text starts and places behind a line feed
        start = np.concatenate([edge[:-1], feed + 1])
        of = np.concatenate([np.arange(len(texts)), row])
        by = np.lexsort((np.concatenate([np.zeros(len(texts), np.int64), np.ones(len(feed), np.int64)]), start, of))
        self.start, self.row = start[by], of[by]
        self.end = np.empty_like(self.start)
        last = np.ones(len(self.start), bool)
        last[:-1] = self.row[1:] != self.row[:-1]
        self.end[last] = edge[1:][self.row[last]]
        self.end[~last] = self.start[1:][~last[:-1]] - 1
        first = np.searchsorted(self.row, np.arange(len(texts)))
        self.number = np.arange(len(self.row)) - first[self.row]
        white = (code == 32) | ((code >= 9) & (code <= 13))
        solid = np.concatenate([[0], np.cumsum(~white)])
        keep = solid[self.end] > solid[self.start]
        self.start, self.end, self.row, self.number = self.start[keep], self.end[keep], self.row[keep], self.number[keep]
        self.size = self.end - self.start
        self.hash = T.mix(self.slice_hash(self.start, self.end) + self.size.astype(np.uint64) * U(0xD6E8FEB86659FD93))

    def slice_hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.inverse[a]

    def gapped_keys(self, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, key, a, b): lines within one edit share the key of all but
        one segment, which is a:b of the line. Lengths are rounded down a little, so that most lines have
        one rounded length in common with those one character shorter."""
        def rounded(n):
            step = 1 << np.maximum(0, np.floor(np.log2(np.maximum(n, 1))).astype(np.int64) - 3)
            return n // step * step

        lines, keys, froms, tos = [], [], [], []
        own, less = rounded(self.size), rounded(np.maximum(self.size - 1, 0))
        for base, of in ((own, np.arange(len(own))), (less[less != own], np.flatnonzero(less != own))):
            for s in range(segments):
                head, tail = base * s // segments, base - base * (s + 1) // segments
                a, b = self.start[of], self.end[of]
                key = T.mix(self.slice_hash(a, a + head)) + T.mix(self.slice_hash(b - tail, b) + U(1)) * U(3)
                lines.append(of)
                froms.append(head)
                tos.append(b - a - tail)
                keys.append(T.mix(key + T.mix(base.astype(np.uint64) * U(segments) + U(s))))
        return tuple(np.concatenate(x) for x in (lines, keys, froms, tos))

    def neighbourhood(self, i: int, places: np.ndarray | None = None) -> list[tuple[np.ndarray, int]]:
        """(keys, role) of line ``i``: replaced at a place; one character
        longer than another line (role 1); that other line itself (role 0).
        ``places``: the characters that may be left out (all by default)."""
        a, b = int(self.start[i]), int(self.end[i])
        at = np.arange(a, b) if places is None else a + places
        n = np.array([b - a], np.uint64)
        head = self.slice_hash(np.full(len(at), a), at)
        tail = self.slice_hash(at + 1, np.full(len(at), b))
        place = T.powers(b - a + 1)[0][at - a]
        # the hash that the line has without its character k
        without = head + tail * place
        whole = self.slice_hash(np.array([a]), np.array([b]))
        replaced = T.mix(T.mix(without + n * U(0x9E37)) + (at - a).astype(np.uint64) + U(1))
        longer = T.mix(T.mix(without) ^ (n - U(1)) * U(0xC2B2AE3D27D4EB4F))
        itself = T.mix(T.mix(whole) ^ n * U(0xC2B2AE3D27D4EB4F))
        return [(replaced, 2), (np.unique(longer), 1), (itself, 0)]


def _batches(rows: pa.RecordBatch, text: int, limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch of at most ``limit`` bytes of text (or one text)."""
    _, offsets = T.byte_view(T.string_array(rows.column(text)))
    for i, j in T.slices(offsets, limit):
        part = rows.slice(i, j - i)
        yield part, [x.as_py() or "" for x in part.column(text)]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


def line_table(rows: DataFrame, min_near: int = 0) -> DataFrame:
    """(doc_id, tie, number, h, keys) of all lines of ``rows`` (doc_id, tie, text)."""
    def run(batches):
        for b in batches:
            for part, texts in _batches(b, 2):
                x = Lines(texts)
                line, key, _, _ = x.gapped_keys(2)
                line, key = line[x.size[line] >= min_near], key[x.size[line] >= min_near]
                by = np.argsort(line, kind="stable")
                ends = np.searchsorted(line[by], np.arange(len(x.row) + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(x.row)), part.column(1).take(pa.array(x.row)), pa.array(x.number, pa.int32()),
                     _signed(x.hash), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(key[by]))],
                    ["doc_id", "tie", "number", "h", "keys"])

    return rows.mapInArrow(run, "doc_id bigint, tie bigint, number int, h bigint, keys array<bigint>")


def sharing(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` (h, key, ...) whose key another h has too."""
    shared = keys.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a < b").select("key")
    return keys.join(shared, "key", "left_semi")


def bit_filter(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """2^bits bits, two per hash, gathered as 64-bit words."""
    place = F.explode(F.array(F.col("h").bitwiseAND(F.lit((1 << bits) - 1)),
                              F.shiftrightunsigned("h", 64 - bits)))
    words = (hashes.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v")).toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["w"].to_numpy()] = words["v"].to_numpy().view(np.uint64)
    return out


def passes(words: np.ndarray, h: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for p in (h & U((1 << bits) - 1), h >> U(64 - bits)):
        ok &= (words[(p >> U(6)).astype(np.int64)] >> (p & U(63)) & U(1)).astype(bool)
    return ok


def line_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, text) of the lines whose hash is among ``wanted``."""
    words = rows.sparkSession.sparkContext.broadcast(bit_filter(wanted))

    def run(batches):
        for b in batches:
            for _, texts in _batches(b, 2):
                x = Lines(texts)
                at = np.flatnonzero(passes(words.value, x.hash))
                at = at[np.unique(x.hash[at], return_index=True)[1]]
                joined = "".join(texts)
                yield pa.RecordBatch.from_arrays(
                    [_signed(x.hash[at]), pa.array([joined[x.start[i]:x.end[i]] for i in at], pa.string())], ["h", "text"])

    return rows.mapInArrow(run, "h bigint, text string").join(wanted, "h", "left_semi").dropDuplicates(["h"])


def _keys_of(lines: DataFrame, schema: str, make) -> DataFrame:
    """Rows made from the lines of ``lines`` (h, text, ...), each one whole."""
    def run(batches):
        for b in batches:
            for part, texts in _batches(b, 1):
                yield from make(part, Lines(texts, whole=True))

    return lines.mapInArrow(run, schema)


def near_lines(first: DataFrame, keys: DataFrame, rows: DataFrame) -> DataFrame:
    """h of the distinct lines that have an earlier line within one edit.
    ``first``: (h, at) with the earliest place of each line."""
    wanted = stage(sharing(keys).select("h").distinct(), "line-candidates")
    texts = stage(line_texts(rows, wanted), "line-texts")

    def gapped(part, x):
        line, key, a, b = x.gapped_keys(SEGMENTS)
        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(x.row[line])), _signed(key),
                                          pa.array(a, pa.int32()), pa.array(b, pa.int32())], ["h", "key", "a", "b"])

    # where a line can differ from another: at most two segments' worth of
    # places per rounded length, a bounded list per line
    gaps = (sharing(_keys_of(texts, "h bigint, key bigint, a int, b int", gapped))
            .groupBy("h").agg(F.collect_set(F.struct("a", "b")).alias("gaps")))
    close = stage(texts.join(gaps, "h").join(first, "h"), "line-close")

    def variants(part, x):
        spans = part.column(2)
        for i in range(len(x.row)):
            h, line = part.column(0)[int(x.row[i])], int(x.row[i])
            places = np.unique(np.concatenate([np.arange(g["a"], g["b"]) for g in spans[line].as_py()]))
            for key, role in x.neighbourhood(i, places):
                yield h.as_py(), key, role

    def variant_batches(part, x):
        h, keys, roles = [], [], []
        for name, key, role in variants(part, x):
            h.append(np.full(len(key), name, np.int64))
            keys.append(key)
            roles.append(np.full(len(key), role, np.int32))
        if h:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)), _signed(np.concatenate(keys)), pa.array(np.concatenate(roles))],
                                             ["h", "key", "role"])

    emitted = stage(_keys_of(close.select("h", "text", "gaps"), "h bigint, key bigint, role int", variant_batches)
                    .join(first, "h"), "line-variants")
    place = F.struct("at", "h")
    earliest = emitted.groupBy("key").agg(
        F.min(place).alias("any"), F.min(F.when(F.col("role") == 0, place)).alias("shorter"),
        F.min(F.when(F.col("role") == 1, place)).alias("longer"), F.count(F.lit(1)).alias("n")).where("n > 1")
    partner = (F.when(F.col("role") == 2, F.col("any")).when(F.col("role") == 1, F.col("shorter")).otherwise(F.col("longer")))
    pairs = (emitted.join(earliest, "key").withColumn("partner", partner)
             .where(F.col("partner.at") < F.col("at")).select("h", F.col("partner.h").alias("other")).distinct())
    a, b = close.select("h", F.col("text").alias("a")), close.select(F.col("h").alias("other"), F.col("text").alias("b"))
    near = stage(pairs.join(a, "h").join(b, "other").where(F.levenshtein("a", "b", 1).between(0, 1))
                 .select("h").distinct().withColumn("near", F.lit(True)), "near-lines")
    release(wanted, texts, close, emitted)
    return near


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_edits: int = 1,
                min_near: int = 0) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and n_lines
    (lines with a word before) and n_removed."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    docs = docs.drop("n_lines", "n_removed")
    tie = F.xxhash64(F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), tie.alias("tie"), F.col(text).alias("text"))
    lines = stage(line_table(rows, min_near), "lines")
    at = F.struct("doc_id", "tie", "number")
    distinct = lines.groupBy("h").agg(F.min(at).alias("at"), F.first("keys").alias("keys"), F.count(F.lit(1)).alias("n"))
    distinct = stage(distinct, "distinct-lines")
    first = distinct.select("h", "at")
    repeated = distinct.where("n > 1").select("h", "at", F.lit(False).alias("near"))
    if max_edits:
        keys = distinct.select("h", F.explode("keys").alias("key"))
        near = near_lines(first, keys, rows)
        repeated = (distinct.select("h", "at", "n").join(near, "h", "left").withColumn("near", F.coalesce("near", F.lit(False)))
                    .where("n > 1 OR near").drop("n"))
    repeated = stage(repeated.withColumnRenamed("at", "earliest"), "repeated-lines")
    release(distinct, *([near] if max_edits else []))
    gone = (lines.drop("keys").join(repeated, "h").where(F.col("near") | (at != F.col("earliest")))
            .groupBy("doc_id", "tie").agg(F.collect_set("number").alias("_gone")))
    gone = stage(gone, "gone-lines")
    release(lines, repeated)
    gone = gone.withColumnsRenamed({"doc_id": "_doc", "tie": "_tie"})
    out = docs.join(gone, F.col(doc_id).cast("long").eqNullSafe(F.col("_doc")) & (tie == F.col("_tie")), "left").drop("_doc", "_tie")
    return (out.withColumn("n_lines", _worded(F.col(text)))
            .withColumn("n_removed", F.coalesce(F.size("_gone"), F.lit(0)))
            .withColumn(text, F.when(F.col("n_removed") > 0, _without(F.col(text), F.col("_gone"))).otherwise(F.col(text)))
            .drop("_gone"))


def _worded(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.size(F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]")))


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines of the given numbers."""
    def kept(lines):
        numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(numbers, lambda i: F.get(lines, i)), "\n")

    return F.get(F.transform(F.array(F.split(text, "\n", -1)), kept), 0)


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def drop_repeated_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated lines go, and with them the documents that had
    nothing else (a document without any line stays)."""
    out = dedup_lines(docs)
    return (out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
            .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")))
            .select(*docs.columns))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, p, ls[p] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS p FROM d)
      WHERE regexp_matches(ls[p], '[^\x20\x09-\x0D]')),
u AS (SELECT line, min(struct_pack(a := doc_id, b := p)) AS at, length(line) AS n FROM l GROUP BY line),
x AS (SELECT x.line AS a, y.line AS b, x.at AS at_a, y.at AS at_b FROM u AS x JOIN u AS y
      ON left(x.line, x.n // 2) = left(y.line, x.n // 2) AND y.n BETWEEN x.n AND x.n + 1 AND x.line <> y.line
      UNION ALL
      SELECT x.line AS a, y.line AS b, x.at AS at_a, y.at AS at_b FROM u AS x JOIN u AS y
      ON right(x.line, x.n - x.n // 2) = right(y.line, x.n - x.n // 2) AND y.n BETWEEN x.n AND x.n + 1 AND x.line <> y.line),
v AS (SELECT * FROM x WHERE len([i FOR i IN range(0, length(a) + 1) IF left(a, i) = left(b, i)
      AND right(a, length(b) - 1 - i) = right(b, length(b) - 1 - i)]) > 0),
g AS (SELECT b AS line FROM v WHERE at_a < at_b UNION SELECT a AS line FROM v WHERE at_b < at_a),
r AS (SELECT l.doc_id, l.p FROM l JOIN u ON l.line = u.line LEFT JOIN g ON l.line = g.line
      WHERE g.line IS NOT NULL OR u.at <> struct_pack(a := l.doc_id, b := l.p)),
k AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM r GROUP BY doc_id),
w AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN k.n > 0 THEN array_to_string([ls[i] FOR i IN range(1, len(ls) + 1) IF NOT list_contains(k.ps, i)], chr(10))
                      ELSE text END AS text,
       CAST(coalesce(w.n, 0) AS INTEGER) AS n_lines, CAST(coalesce(k.n, 0) AS INTEGER) AS n_removed
FROM d LEFT JOIN k ON d.doc_id = k.doc_id LEFT JOIN w ON d.doc_id = w.doc_id
"""
