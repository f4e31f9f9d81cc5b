"""Phrases that occur together, counted in quotient filters.

Texts are split into pieces at ``.,;:!?`` and line ends, pieces into words at
blanks and tabs. Phrases of 2 to ``longest`` words found ``min_count`` times in
a language are candidates; a candidate's score is that of its weakest cut into
two parts, floor(1000 * f * n / (f(left) * f(right))).

1. Blocks of text are written as numbers of the block's own distinct words,
   next to these words, their counts and hashes.
2. Word counts are summed. No word found less than ``min_count`` times can be in a
   candidate or in a part of one: a bit filter of fixed size leaves out such
   words, but for a few. A word's id are the first bits of its hash, as many as it takes
   to give each frequent word an id that no other word of its language has
   among those that the filter lets through; this is checked, not assumed (should whole hashes
   meet, all is done again with another seed). So tasks need no dictionary, and the text isn't shuffled.
3. Length by length, blocks count their n-grams in counting quotient filters
   (``quotient_filter``), cut into ranges of quotients; filters of one language
   and range are merged, and n-grams found ``min_count`` times go on. The number
   of ranges follows the corpus, so that a range is bounded. An n-gram
   is counted only if both its shorter n-grams may be frequent, again by a
   bit filter: what filters let through by chance is counted exactly
   and falls below ``min_count`` by itself.
4. Cuts and longer phrases are looked up by joins of the frequent n-grams.

All counts are exact, and products are decimals of 38 digits.

Defined results: null and empty text have no words; a null lang is ``und``, as
the lang of that name; a null doc_id and repeated rows count as any other row;
an empty table gives an empty table; further columns are ignored."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import quotient_filter as Q
from . import textnum as T
from .line_dedup import bit_filter, passes
from .staging import stage

U = np.uint64
#: bytes of text in a block: its row stays below what a small executor heap keeps apart as large objects
BLOCK = 1 << 18
HELD = 4 << 20
#: n-grams that a task gathers before it sends its filters off
FLUSH = 1 << 19
#: words of the corpus per range of quotients
RANGE = 1 << 21
RANK_BUCKETS = 256
_ENDS = T.byte_class((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
_OUTSIDE = _ENDS | T.byte_class((0x20, 0x20), (0x09, 0x09))


def numbered(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(tokens, words, counts): the words' places in ``words`` plus 1, with a 0
    before each piece; the distinct words and their counts."""
    raw, offsets = T.byte_view(texts)
    raw = T.lower(raw)
    starts, ends, row = T.words(raw, offsets, _OUTSIDE)
    coded = T.word_strings(raw, starts, ends).dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(_ENDS[raw], dtype=np.int64)[starts] if len(starts) else np.zeros(0, np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (row[1:] != row[:-1]) | (before[1:] != before[:-1])
    tokens = np.zeros(len(starts) + int(new.sum()), np.int32)
    tokens[np.arange(len(starts)) + np.cumsum(new)] = number + 1
    return tokens, coded.dictionary, np.bincount(number, minlength=len(coded.dictionary))


def word_ids(words: pa.Array, lang: str, seed: int) -> np.ndarray:
    """64-bit hashes of the words of a language."""
    def hashed(strings: pa.Array) -> np.ndarray:
        raw, offsets = T.byte_view(strings)
        return T.word_hashes(raw, offsets[:-1], offsets[1:])

    return T.mix(hashed(words) + T.mix(hashed(pa.array([lang], pa.large_string())) + U(seed)))


def token_blocks(rows: DataFrame, seed: int) -> DataFrame:
    """(lang, tokens, hashes, words, counts) of ``rows`` (lang, text), a block
    holding one language and about ``BLOCK`` bytes, or one longer text."""
    def made(lang, parts):
        tokens, words, counts = numbered(pa.concat_arrays(parts))
        hashes = word_ids(words, lang, seed).view(np.int64)
        whole = pa.array([0, len(words)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([tokens.tobytes()], pa.binary()), pa.ListArray.from_arrays(whole, pa.array(hashes)),
             pa.ListArray.from_arrays(whole, words.cast(pa.string())), pa.ListArray.from_arrays(whole, pa.array(counts, pa.int64()))],
            ["lang", "tokens", "hashes", "words", "counts"])

    def run(batches):
        held, size = defaultdict(list), defaultdict(int)
        for b in batches:
            coded = b.column(0).dictionary_encode()
            texts = T.string_array(b.column(1))
            own = coded.indices.to_numpy(zero_copy_only=False)
            for i, lang in enumerate(coded.dictionary.to_pylist()):
                part = texts.take(pa.array(np.flatnonzero(own == i)))
                offsets = T.byte_view(part)[1]
                for a, z in T.slices(offsets, BLOCK):
                    held[lang].append(part.slice(a, z - a))
                    size[lang] += int(offsets[z] - offsets[a])
                    if size[lang] >= BLOCK:
                        yield made(lang, held.pop(lang))
                        del size[lang]
            if sum(size.values()) >= HELD:
                for lang in list(held):
                    yield made(lang, held.pop(lang))
                size.clear()
        for lang, parts in held.items():
            yield made(lang, parts)

    return rows.mapInArrow(run, "lang string, tokens binary, hashes array<bigint>, words array<string>, counts array<bigint>")


def id_bits(counts: DataFrame, often: np.ndarray, min_count: int) -> int | None:
    """How many bits of the hashes tell each frequent word from all words of
    its language that pass the bit filter ``often``; None if 63 do not."""
    shared = counts.sparkSession.sparkContext.broadcast(often)      # of fixed size

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(passes(shared.value, b.column(1).to_numpy().view(np.uint64))))

    known = stage(counts.select("lang", "h", (F.col("f") >= min_count).alias("often"))
                  .mapInArrow(run, "lang string, h bigint, often boolean"), "phrase-hashes")
    n = known.agg(F.count(F.lit(1)).alias("all"), F.count_if("often").alias("often")).first()
    bits = min(63, max(8, (n["all"] * n["often"]).bit_length() + 3))
    while True:
        shared_ids = (known.groupBy("lang", F.shiftrightunsigned("h", 64 - bits).alias("id"))
                      .agg(F.count(F.lit(1)).alias("n"), F.max("often").alias("often")).where("n > 1 AND often"))
        if shared_ids.isEmpty():
            return bits
        if bits == 63:
            return None
        bits = min(63, bits + 4)


def gram_hash(ids: list[np.ndarray]) -> np.ndarray:
    x = np.zeros(len(ids[0]), np.uint64)
    for one in ids:
        x = T.mix(x * U(0xD1342543DE82EF95) + one.astype(np.uint64) + U(1))
    return x


def frequent_grams(blocks: DataFrame, k: int, bits: int, ranges: int, min_count: int, often: np.ndarray,
                   below: np.ndarray | None) -> DataFrame:
    """(lang, gram, f, h) of the n-grams of ``k`` words found ``min_count``
    times, from 2^``ranges`` ranges. Bit filters: ``often`` of the frequent words,
    ``below`` of the frequent n-grams of k - 1 words."""
    packing = Q.Packing(k, bits)
    top = min(packing.widths[0], ranges)
    shared = blocks.sparkSession.sparkContext.broadcast((often, below))     # of fixed size

    def grams(tokens: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
        words, shorter = shared.value
        table = np.full(len(hashes) + 1, -1, np.int64)
        known = np.flatnonzero(passes(words, hashes))
        table[known + 1] = (hashes[known] >> U(64 - bits)).astype(np.int64)
        ids = table[tokens]
        ok = ids[:max(0, len(ids) - k + 1)] >= 0
        for j in range(1, k):
            ok &= ids[j:len(ids) - k + 1 + j] >= 0
        at = np.flatnonzero(ok)
        for j in (0, 1) if shorter is not None else ():
            at = at[passes(shorter, gram_hash([ids[at + j + i] for i in range(k - 1)]))]
        return packing.permute(packing.pack([ids[at + i] for i in range(k)]))

    def counted(batches):
        held, waiting, size = {}, defaultdict(list), 0

        def sent(lang):
            lanes, counts = held.pop(lang)
            parts = Q.segments(packing, lanes, counts, top)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(parts)), pa.array([r for r, _ in parts], pa.int64()), pa.array([f for _, f in parts], pa.binary())],
                ["lang", "range", "filter"])

        def settle():
            """Counts what waits, into what is held."""
            for lang in list(waiting):
                lanes, counts = packing.count([np.concatenate(x) for x in zip(*waiting.pop(lang), strict=True)])
                if old := held.pop(lang, None):
                    lanes, counts = packing.count([np.concatenate(x) for x in zip(old[0], lanes, strict=True)],
                                                  np.concatenate([old[1], counts]))
                held[lang] = lanes, counts

        for b in batches:
            for i, lang in enumerate(b.column(0).to_pylist()):
                tokens = np.frombuffer(b.column(1)[i].as_buffer(), np.int32)
                lanes = grams(tokens, b.column(2)[i].values.to_numpy().view(np.uint64))
                if not len(lanes[0]):
                    continue
                waiting[lang].append(lanes)
                size += len(lanes[0])
                if size >= FLUSH // 2:      # blocks are small: many are sorted at once
                    settle()
                    size = 0
                while sum(len(c) for _, c in held.values()) >= FLUSH:
                    yield sent(max(held, key=lambda x: len(held[x][1])))
        settle()
        for lang in list(held):
            yield sent(lang)

    def merged(key, table):
        lang, r = (x.as_py() for x in key)
        lanes, counts = Q.merge(packing, table["filter"].to_pylist(), top, r)
        enough = counts >= min_count
        ids = packing.unpack(packing.restore([x[enough] for x in lanes]))
        flat = np.stack(ids, 1).reshape(-1)
        return pa.table({"lang": pa.array([lang] * len(ids[0]), pa.string()),
                         "gram": pa.ListArray.from_arrays(pa.array(np.arange(len(ids[0]) + 1) * k, pa.int32()), pa.array(flat, pa.int64())),
                         "f": pa.array(counts[enough], pa.int64()), "h": pa.array(gram_hash(ids).view(np.int64))})

    return (blocks.select("lang", "tokens", "hashes").mapInArrow(counted, "lang string, range bigint, filter binary")
            .groupBy("lang", "range").applyInArrow(merged, "lang string, gram array<bigint>, f bigint, h bigint"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 5, min_count: int = 100,
                 covered: int = 100) -> DataFrame:
    """lang, phrase, a, l, r, n, score of all candidates that no longer
    candidate covers: one that holds their words, found in at least
    ``covered`` % of their places."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    for seed in count():
        blocks = stage(token_blocks(rows, seed), "phrase-blocks")
        counts = (blocks.select("lang", F.explode(F.arrays_zip("words", "hashes", "counts")).alias("w"))
                  .groupBy("lang", F.col("w.words").alias("word"), F.col("w.hashes").alias("h")).agg(F.sum("w.counts").alias("f")))
        counts = stage(counts, "phrase-words")
        frequent = counts.where(F.col("f") >= min_count)
        often = bit_filter(frequent.select("h"))
        if bits := id_bits(counts, often, min_count):
            break
    totals = stage(counts.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    words = stage(frequent.select("lang", "word", F.shiftrightunsigned("h", 64 - bits).alias("id"), "f"), "phrase-ids")
    ranges = (-(-(totals.agg(F.sum("n")).first()[0] or 0) // RANGE)).bit_length()
    levels, below = [words.select("lang", F.array("id").alias("gram"), "f")], None
    for k in range(2, longest + 1):
        found = stage(frequent_grams(blocks, k, bits, ranges, min_count, often, below), f"phrase-grams-{k}")
        levels.append(found.select("lang", "gram", "f"))
        if k < longest:
            below = bit_filter(found.select("h"))
    grams = levels[0]
    for one in levels[1:]:
        grams = grams.unionByName(one)
    return _scored(grams, words, totals, covered)


def _scored(grams: DataFrame, words: DataFrame, totals: DataFrame, covered: int) -> DataFrame:
    """The candidates among all frequent n-grams, scored and in words."""
    many = grams.where(F.size("gram") > 1)
    size = F.size("gram")

    def part(side: str, count: str) -> DataFrame:
        return grams.select("lang", F.col("gram").alias(side), F.col("f").alias(count))

    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("gram", i, n))))
    inside = (many.where(size > 2).select("lang", F.explode(spans).alias("gram"), F.col("f").alias("longer"))
              .groupBy("lang", "gram").agg(F.max("longer").alias("longer")))
    kept = (many.join(inside, ["lang", "gram"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("f"))).drop("longer"))
    cuts = (kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
            .withColumns({"left": F.slice("gram", F.lit(1), F.col("k")), "right": F.slice("gram", F.col("k") + 1, size - F.col("k"))})
            .join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]))
    score = F.expr("(cast(1000 * cast(f as decimal(18,0)) as decimal(19,0)) * cast(n as decimal(18,0)))"
                   " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    best = (cuts.join(totals, "lang").withColumn("score", score).groupBy("lang", "gram")
            .agg(F.min(F.struct("score", "k", "l", "r", "f", "n")).alias("b")))
    spelled = (best.select("lang", "gram", F.posexplode("gram").alias("at", "id")).join(words.select("lang", "id", "word"), ["lang", "id"])
               .groupBy("lang", "gram").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w")))
    return best.join(spelled, ["lang", "gram"]).select(
        "lang", F.array_join(F.col("w.word"), " ").alias("phrase"), F.col("b.f").alias("a"), F.col("b.l").alias("l"),
        F.col("b.r").alias("r"), F.col("b.n").alias("n"), F.col("b.score").alias("score"))


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    found = collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # the best of each of RANK_BUCKETS parts of a language first, so that no task ranks all its phrases
    part = F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))
    best = (found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_BUCKETS))).withColumn("rank", part)
            .where(F.col("rank") <= 2000))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order))
    return (best.withColumn("rank", rank.cast("long")).where(F.col("rank") <= 2000)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')), '[^\x20\x09]+') AS ws FROM d),
t AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM p GROUP BY lang),
s AS (SELECT lang, k, unnest([ws[i:i + k - 1] FOR i IN range(1, len(ws) - k + 2)]) AS g FROM p, range(1, 6) AS x(k)),
f AS (SELECT lang, k, g, count(*)::HUGEINT AS f FROM s GROUP BY lang, k, g HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE k > 1),
o AS (SELECT lang, unnest([g[i:i + m - 1] FOR i IN range(1, k - m + 2)]) AS g, f FROM c, range(2, 5) AS y(m) WHERE m < k),
u AS (SELECT lang, g, max(f) AS f FROM o GROUP BY lang, g),
e AS (SELECT c.* FROM c LEFT JOIN u ON c.lang = u.lang AND c.g = u.g WHERE u.f IS NULL OR 100 * u.f < 100 * c.f),
x AS (SELECT e.lang, e.g, e.f AS a, z.cut, l.f AS l, r.f AS r, t.n, (1000 * e.f * t.n) // (l.f * r.f) AS score
      FROM e JOIN range(1, 5) AS z(cut) ON z.cut < e.k JOIN t ON t.lang = e.lang
      JOIN f AS l ON l.lang = e.lang AND l.g = e.g[1:z.cut] JOIN f AS r ON r.lang = e.lang AND r.g = e.g[z.cut + 1:]),
b AS (SELECT lang, g, any_value(a) AS a, any_value(n) AS n, min(struct_pack(score := score, cut := cut, l := l, r := r)) AS m
      FROM x GROUP BY lang, g),
w AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, m.l AS l, m.r AS r, n, m.score AS score FROM b),
k AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM w)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score FROM k WHERE rank <= 2000
"""
