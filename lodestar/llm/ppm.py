"""Language-model scores by prediction by partial matching over bytes.

A text, with A-Z lower-cased, is a row of bytes between end marks. The trie
holds, for each context of up to ``ORDER`` symbols, how often each symbol
followed it in the training texts. A symbol's probability comes from the
longest known context: (2c - 1) / 2n for one that followed c times in n
occurrences of the context. A context with q distinct symbols leaves q / 2n to a
shorter one, where the symbols that the longer one knew are excluded, and last
to all symbols alike. The score of a text is the sum of
the log10 probabilities of its bytes and its end.

Counting: each task counts its texts' longest contexts, Spark sums the counts
of all tasks and derives those of the shorter contexts. Texts are scored against
a copy of the trie; its size is bounded by ``max_nodes`` counts per order (the
contexts seen most often are held). Symbols whose contexts may be known but are
not held are joined with the counts of those contexts, order by order, so all
scores are exact whatever the number of contexts.

Base score: words and one end per text under add-one unigram counts. The words
seen most often, at most ``HEAD_WORDS`` of them, are scored in place; every
other word of every text is joined with the word counts, so all counts are
exact whatever the vocabulary. Words are identified by 64-bit hashes.

Defined results: null and empty text are the end alone; a training set without
rows gives base probabilities of 1 / (V + 1) with V = 0 and symbols all alike;
rows that repeat a doc_id and its text get one score each; a null doc_id is
hashed as the empty text; an empty table gives an empty table; further columns
are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnum as T
from .staging import stage

ORDER = 5
SYMBOLS = 257          # bytes, and the mark between texts
END = 256
BITS = 9
MAX_NODES = 1 << 22
HEAD_WORDS = 1 << 19
HELD_COUNTS = 1 << 21  # counts that a counting task keeps before it sends them on
U = np.uint64


def symbols(raw: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one row of symbols, ``order`` marks before each text and
    one after, and the places of the predicted symbols' rows."""
    size = np.diff(offsets)
    start = np.cumsum(size + order + 1) - (size + order + 1)
    out = np.full(int((size + order + 1).sum()), END, np.uint64)
    out[np.arange(len(raw)) + np.repeat(start + order - offsets[:-1], size)] = raw
    return out, start


def grams(row: np.ndarray, start: np.ndarray, size: np.ndarray, order: int) -> np.ndarray:
    """Packed (context, symbol) of every predicted symbol, text by text; the
    oldest symbol stands highest."""
    key = np.zeros(len(row) - order, np.uint64)
    for j in range(order + 1):
        key = key << U(BITS) | row[j:len(row) - order + j]
    inside = np.ones(len(key), bool)
    for j in range(order):  # windows that end in the marks before a text
        at = start[1:] - 1 - j
        inside[at[at >= 0]] = False
    return key[inside]


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sum of their counts."""
    if not len(keys):
        return keys, counts
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    head = np.flatnonzero(np.diff(keys, prepend=keys[0] ^ U(1)))
    return keys[head], np.add.reduceat(counts, head)


def _lower_case(column) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    raw, offsets = T.byte_view(T.string_array(column))
    return T.lower(raw), offsets


def count_texts(texts: DataFrame, order: int) -> DataFrame:
    """(kind, key, n): kind 0 counts (context, symbol) keys of the longest
    order, kind 1 counts word hashes; sums over all texts."""
    def run(batches: Iterator[pa.RecordBatch]):
        held = [[[], []], [[], []]]

        def reduce(kind):
            keys, counts = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in held[kind])
            keys, counts = add_up(keys, counts.astype(np.int64))
            held[kind] = [[keys], [counts]]
            return keys, counts

        def out(kind):
            keys, counts = reduce(kind)
            held[kind] = [[], []]
            for i in range(0, len(keys), 1 << 18):
                k, n = keys[i:i + (1 << 18)], counts[i:i + (1 << 18)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(n)], ["kind", "key", "n"])

        for b in batches:
            raw, offsets = _lower_case(b.column(0))
            for i, j in T.slices(offsets):
                part, off = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                row, start = symbols(part, off, order)
                starts, ends, _ = T.words(part, off)
                for kind, keys in ((0, grams(row, start, np.diff(off), order)), (1, T.word_hashes(part, starts, ends))):
                    k, n = np.unique(keys, return_counts=True)
                    held[kind][0].append(k)
                    held[kind][1].append(n)
                    if sum(map(len, held[kind][0])) > HELD_COUNTS and len(reduce(kind)[0]) > HELD_COUNTS // 2:
                        yield from out(kind)
        for kind in (0, 1):
            yield from out(kind)

    counted = texts.mapInArrow(run, "kind int, key bigint, n bigint")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Trie:
    """The contexts of one model, ready for whole-array scoring.

    Per order o: ``cells`` maps (context, symbol) to a count, ``contexts`` maps
    a context to n, q and the n and q of its suffix without its own symbols.
    ``limits`` has per order the occurrences from which contexts are held (0:
    all are); they rise with the order, so a held context's suffixes are held."""

    def __init__(self, cells: list[tuple[np.ndarray, np.ndarray]], limits: list[int] | None = None):
        self.order = len(cells) - 1
        self.limits = limits or [0] * len(cells)
        self.cells, self.contexts, self.stats = [], [], []
        known = [T.Lookup(k, n) for k, n in cells]
        for o, (keys, counts) in enumerate(cells):
            ctx = keys >> U(BITS)
            names, at = np.unique(ctx, return_inverse=True)
            n = np.bincount(at, counts, len(names)) if len(keys) else np.zeros(0)
            q = np.bincount(at, minlength=len(names)).astype(float)
            if o:  # what the suffix keeps when this context's symbols are excluded
                low = T.Lookup(*self._names(cells[o - 1]))
                suffix = keys & ((U(1) << U(BITS * o)) - U(1))
                shared = known[o - 1].find(suffix)
                gone_n = np.bincount(at, np.where(shared >= 0, cells[o - 1][1][np.maximum(shared, 0)], 0), len(names))
                gone_q = np.bincount(at, shared >= 0, len(names))
                below = low.find(names & ((U(1) << U(BITS * (o - 1))) - U(1)))
                rest_n = np.where(below >= 0, self.stats[o - 1][0][np.maximum(below, 0)], 0) - gone_n
                rest_q = np.where(below >= 0, self.stats[o - 1][1][np.maximum(below, 0)], 0) - gone_q
            else:
                rest_n, rest_q = np.zeros(len(names)), np.full(len(names), SYMBOLS) - q
            self.cells.append(known[o])
            self.contexts.append(T.Lookup(names, np.zeros(len(names))))
            self.stats.append((n, q, rest_n, rest_q))
            self.longest = np.log10((2 * counts - 1) / (2 * n[at])) if len(keys) else np.zeros(0)

    @staticmethod
    def _names(cell):
        names = np.unique(cell[0] >> U(BITS))
        return names, np.zeros(len(names))

    def open(self, keys: np.ndarray) -> np.ndarray:
        """Whether a context longer than the longest held one may be known."""
        out = np.zeros(len(keys), bool)
        left = np.arange(len(keys) if self.limits[-1] else 0)
        for o in range(self.order, -1, -1):
            if not len(left):
                break
            key = keys[left] & ((U(1) << U(BITS * (o + 1))) - U(1))
            left = left[self.contexts[o].find(key >> U(BITS)) < 0]
            out[left] = self.limits[o] > 0  # the last order without a held context decides
        return out

    def log10(self, keys: np.ndarray, n: np.ndarray | None = None, q: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each packed (context, symbol); ``n`` and ``q``
        are what a longer context, not held, has left to the first held one
        (nan: there is none)."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        if n is None:
            at = self.cells[-1].find(keys)
            out[at >= 0] = self.longest[at[at >= 0]]  # most symbols: their longest context knows them
            left = np.flatnonzero(at < 0)
        for o in range(self.order, -1, -1):
            key = keys[left] & ((U(1) << U(BITS * (o + 1))) - U(1))
            at = self.contexts[o].find(key >> U(BITS))
            known, safe = at >= 0, np.maximum(at, 0)
            stat = [np.where(known, s[safe], 0) if len(s) else np.zeros(len(left)) for s in self.stats[o]]
            fresh = np.isnan(n) if n is not None else np.ones(len(left), bool)
            n_now = np.where(fresh, stat[0], n if n is not None else 0)
            q_now = np.where(fresh, stat[1], q if q is not None else 0)
            cell = self.cells[o].find(key)
            hit = cell >= 0
            if hit.any():
                c = self.cells[o].values[cell[hit]]
                out[left[hit]] += np.log10((2 * c - 1) / (2 * n_now[hit]))
            miss = ~hit
            # nothing left to predict here: the escape is certain
            some = miss & known & (n_now > 0)
            out[left[some]] += np.log10(q_now[some] / (2 * n_now[some]))
            n = np.where(known, stat[2], np.nan if n is None else n)[miss]
            q = np.where(known, stat[3], np.nan if q is None else q)[miss]
            left = left[miss]
            if not len(left):
                return out
        out[left] -= np.log10(np.where(np.isnan(q), SYMBOLS, q))
        return out


def trie_of(counts: DataFrame, order: int, max_nodes: int) -> Trie:
    """The trie from the summed counts of the longest order. Per order the
    driver reads at most ``max_nodes`` counts: those of the contexts with the
    most occurrences, by a power-of-two limit."""
    cells, limits, limit = [], [], 0
    for o in range(order + 1):
        own = _cells(counts, o)
        ctx = F.shiftrightunsigned("key", BITS).alias("ctx")
        sizes = own.groupBy(ctx).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("cells"))
        steps = sizes.groupBy(F.floor(F.log2("total")).alias("step")).agg(F.sum("cells").alias("cells")).orderBy(F.desc("step")).collect()
        held, least = 0, 0
        for r in steps:
            held += r["cells"]
            if held > max_nodes:
                least = 2 ** (r["step"] + 1)
                break
        limit = max(limit, least)
        limits.append(limit)
        if limit:
            own = own.withColumn("ctx", ctx).join(sizes.where(F.col("total") >= limit).select("ctx"), "ctx", "left_semi").drop("ctx")
        got = own.select("key", "n").toArrow()
        keys = got["key"].to_numpy().astype(np.uint64)
        by = np.argsort(keys)
        cells.append((keys[by], got["n"].to_numpy().astype(np.float64)[by]))
    return Trie(cells, limits)


def _low(key: str, symbols: int) -> Column:
    """The last ``symbols`` symbols of a packed key."""
    return F.col(key).bitwiseAND(F.lit((1 << BITS * symbols) - 1).cast("long"))


def _cells(counts: DataFrame, o: int) -> DataFrame:
    """(key, n) of order ``o`` from the counts of the longest order."""
    return counts.groupBy(_low("key", o + 1).alias("key")).agg(F.sum("n").alias("n"))


def rare_contexts(counts: DataFrame, o: int, limit: int) -> DataFrame:
    """The contexts of order ``o`` that occur less than ``limit`` times: ctx, n,
    q, rest_n and rest_q as in the trie, and the counts by symbol (257 at most)."""
    ctx = F.shiftrightunsigned("key", BITS)
    cells = _cells(counts, o).withColumn("ctx", ctx)
    own = [F.sum("n").alias("own_n"), F.count(F.lit(1)).alias("own_q"),
           F.collect_list(F.struct(_low("key", 1).alias("symbol"), "n")).alias("own_cells")]
    if not o:
        return (cells.groupBy("ctx").agg(*own).where(F.col("own_n") < limit)
                .withColumns({"rest_n": F.lit(0).cast("long"), "rest_q": F.lit(SYMBOLS) - F.col("own_q")}))
    below = _cells(counts, o - 1).withColumnsRenamed({"key": "low", "n": "low_n"})
    sizes = below.groupBy(F.shiftrightunsigned("low", BITS).alias("suffix")).agg(F.sum("low_n").alias("all_n"), F.count(F.lit(1)).alias("all_q"))
    return (cells.withColumn("low", _low("key", o)).join(below, "low")
            .groupBy("ctx").agg(*own, F.sum("low_n").alias("gone")).where(F.col("own_n") < limit)
            .withColumn("suffix", _low("ctx", o - 1)).join(sizes, "suffix")
            .select("ctx", "own_n", "own_q", "own_cells", (F.col("all_n") - F.col("gone")).alias("rest_n"), (F.col("all_q") - F.col("own_q")).alias("rest_q")))


def open_scores(scored: DataFrame, counts: DataFrame, trie: Trie) -> DataFrame:
    """Per _id and _tie: open_times and open_log, the number of the symbols in
    ``open`` and the sum of their log10 probabilities."""
    rows = (scored.where(F.size("open") > 0).select("doc_id", "tie", F.explode("open").alias("key"))
            .groupBy("doc_id", "tie", "key").agg(F.count(F.lit(1)).alias("times"))
            .withColumns({"log": F.lit(0.0), "n": F.lit(None).cast("double"), "q": F.lit(None).cast("double"), "over": F.lit(False)}))
    for o in range(trie.order, -1, -1):
        if not trie.limits[o]:
            break
        rows = rows.withColumn("ctx", F.shiftrightunsigned(_low("key", o + 1), BITS))
        rows = rows.join(rare_contexts(counts, o, trie.limits[o]), "ctx", "left")
        known = F.col("own_n").isNotNull() & ~F.col("over")
        count = F.get(F.filter("own_cells", lambda x: x["symbol"] == _low("key", 1)), 0)["n"]
        rows = rows.select("doc_id", "tie", "key", "times", "log", "over", "rest_n", "rest_q", known.alias("known"), count.alias("c"),
                           F.coalesce("n", "own_n").cast("double").alias("n"), F.coalesce("q", "own_q").cast("double").alias("q"))
        hit = F.col("known") & F.col("c").isNotNull()
        step = (F.when(hit, F.log10((2 * F.col("c") - 1) / (2 * F.col("n"))))
                .when(F.col("known") & (F.col("n") > 0), F.log10(F.col("q") / (2 * F.col("n")))).otherwise(0.0))
        rows = rows.select("doc_id", "tie", "key", "times", (F.col("log") + step).alias("log"), (F.col("over") | hit).alias("over"),
                           F.when(F.col("known"), F.col("rest_n").cast("double")).otherwise(F.col("n")).alias("n"),
                           F.when(F.col("known"), F.col("rest_q").cast("double")).otherwise(F.col("q")).alias("q"))
    shared = scored.sparkSession.sparkContext.broadcast(trie)

    def held(batches):
        for b in batches:
            key, log, n, q = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5, 6))
            left = ~b.column(7).to_numpy(zero_copy_only=False)
            log = log.copy()
            log[left] += shared.value.log10(key[left].astype(np.uint64), n[left].astype(float), q[left].astype(float))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(log)], ["_id", "_tie", "times", "log"])

    ready = rows.select("doc_id", "tie", "times", "key", "log", F.coalesce("n", F.lit(float("nan"))), F.coalesce("q", F.lit(float("nan"))), "over")
    return (ready.mapInArrow(held, "_id bigint, _tie bigint, times bigint, log double").groupBy("_id", "_tie")
            .agg(F.sum("times").alias("open_times"), F.sum(F.col("times") * F.col("log")).alias("open_log")))


def score_texts(docs: DataFrame, trie: Trie, head: tuple[np.ndarray, np.ndarray], order: int) -> DataFrame:
    """Per row: doc_id, tie (hash of the text), score, n_tokens, and for the
    words of ``head`` known and log10 (count + 1); the other words and the
    symbols that the trie leaves open as arrays."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((trie, T.Lookup(head[0], np.log10(head[1] + 1.0))))

    def run(batches):
        for b in batches:
            trie, words = shared.value
            raw, offsets = _lower_case(b.column(1))
            n_rows = len(offsets) - 1
            score, tokens, sums, known = np.zeros(n_rows), np.ones(n_rows, np.int64), np.zeros(n_rows), np.zeros(n_rows, np.int64)
            tail_row, tail_key, open_row, open_key = [], [], [], []
            for i, j in T.slices(offsets):
                part, off = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                row, start = symbols(part, off, order)
                size = np.diff(off) + 1
                key = grams(row, start, np.diff(off), order)
                later, p = trie.open(key), np.zeros(len(key))
                p[~later] = trie.log10(key[~later])
                open_row.append(np.repeat(np.arange(i, j), size)[later])
                open_key.append(key[later])
                score[i:j] = np.add.reduceat(p, np.cumsum(size) - size)
                starts, ends, of = T.words(part, off)
                key = T.word_hashes(part, starts, ends)
                at = words.find(key)
                hit = at >= 0
                tokens[i:j] += np.bincount(of, minlength=j - i)
                known[i:j] += np.bincount(of[hit], minlength=j - i)
                sums[i:j] += np.bincount(of[hit], words.values[at[hit]], j - i)
                tail_row.append(of[~hit] + i)
                tail_key.append(key[~hit])
            lists = []
            for rows, keys in ((tail_row, tail_key), (open_row, open_key)):
                rows, keys = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, keys))
                ends_at = np.searchsorted(rows, np.arange(n_rows + 1))
                lists.append(pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pa.array(np.asarray(keys, np.uint64).view(np.int64))))
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2), b.column(3), pa.array(score), pa.array(tokens), pa.array(known), pa.array(sums), *lists,
            ], ["doc_id", "tie", "held_out", "score", "n_tokens", "head_known", "head_log", "tail", "open"])

    return docs.mapInArrow(run, "doc_id bigint, tie bigint, held_out boolean, score double, n_tokens bigint, "
                                "head_known bigint, head_log double, tail array<bigint>, open array<bigint>")


def language_model_scores(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
                          order: int = ORDER, max_nodes: int = MAX_NODES, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score;
    the model learns from the rows that ``held_out`` leaves."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = stage(count_texts(rows.where(~F.col("held_out")).select("text"), order), "ppm-counts")
    vocabulary = counts.where("kind = 1").select("key", "n")
    seen = vocabulary.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    ends = rows.where(~F.col("held_out")).count()
    train_tokens, distinct = seen["n"] + ends, seen["v"] + (ends > 0)
    nodes = counts.where("kind = 0").select("key", "n")
    trie = trie_of(nodes, order, max_nodes)
    head = vocabulary.orderBy(F.desc("n"), "key").limit(head_words).toArrow()
    head = (head["key"].to_numpy().view(np.uint64), head["n"].to_numpy().astype(float))

    scored = stage(score_texts(rows.select("doc_id", "text", F.xxhash64("text").alias("tie"), "held_out"), trie, head, order), "ppm-scores")
    # the other words: each text's distinct ones, joined with the exact counts
    tail = (scored.where(F.size("tail") > 0).select("doc_id", "tie", F.explode("tail").alias("key"))
            .groupBy("doc_id", "tie", "key").agg(F.count(F.lit(1)).alias("times")))
    tail = (tail.join(vocabulary, "key", "left").groupBy("doc_id", "tie").agg(
        F.sum("times").alias("tail_times"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("tail_log"))
        .withColumnsRenamed({"doc_id": "_id", "tie": "_tie"}))
    # rows that repeat a doc_id and its text were counted together
    alike = F.col("tail_times") / F.size("tail")
    norm = float(np.log10(train_tokens + distinct + 1))
    joined = scored.join(tail, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("tie").eqNullSafe(F.col("_tie")), "left")
    score = F.col("score")
    if trie.limits[-1]:
        rest = open_scores(scored, nodes, trie).withColumnsRenamed({"_id": "_open_id", "_tie": "_open_tie"})
        joined = joined.join(rest, F.col("doc_id").eqNullSafe(F.col("_open_id")) & F.col("tie").eqNullSafe(F.col("_open_tie")), "left")
        score = score + F.coalesce(F.col("open_log") * F.size("open") / F.col("open_times"), F.lit(0.0))
    base = F.col("head_log") + F.coalesce(F.col("tail_log") / alike, F.lit(0.0)) + F.lit(float(np.log10(ends + 1.0))) - F.col("n_tokens") * F.lit(norm)
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce(F.col("tail_known") / alike, F.lit(0.0)).cast("long") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))


def op4_ppm_scores(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return language_model_scores(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2)


def brute_force(train: list[bytes], text: bytes, order: int = ORDER) -> float:
    """The score of one lower-cased text by a plain trie (for tests)."""
    counts: dict[tuple, dict[int, int]] = {}
    for t in train:
        row = [END] * order + list(t) + [END]
        for i in range(order, len(row)):
            for o in range(order + 1):
                node = counts.setdefault(tuple(row[i - o:i]), {})
                node[row[i]] = node.get(row[i], 0) + 1
    total, row = 0.0, [END] * order + list(text) + [END]
    for i in range(order, len(row)):
        excluded: set[int] = set()
        for o in range(order, -1, -1):
            node = {s: c for s, c in counts.get(tuple(row[i - o:i]), {}).items() if s not in excluded}
            if not node:
                continue
            n, q = sum(node.values()), len(node)
            if row[i] in node:
                total += np.log10((2 * node[row[i]] - 1) / (2 * n))
                break
            total += np.log10(q / (2 * n))
            excluded |= set(node)
        else:
            total -= np.log10(SYMBOLS - len(excluded))
    return total
