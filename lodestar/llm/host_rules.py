"""Quality rules per document and per host (native DataFrame expressions).

Document rules: fewer than ``min_words`` words, or more than
``max_repeat_pct`` percent of the words inside 3-word windows that occur at
least twice in the text. Host rule: the failures of a host's documents are
summed, the host's failure rate is shrunk towards the mean of all hosts with a
beta prior fitted to the host rates by moments, and a host whose shrunk rate
is above ``max_host_rate`` loses all its documents.

Defined results: null and empty text count as no words (so the document fails);
a null host is one host of its own; repeated rows are judged and counted as
often as they occur; an empty table gives an empty table; columns of the input
that carry a name of the result are replaced by the result's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

WHITE = r"[\x20\x09-\x0D]"
SOLID = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def let(value: Column, body) -> Column:
    """Bind ``value`` once for use inside nested lambdas (an inlined
    expression would be evaluated again for every element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE + "+", -1), "")


def word_count(text: Column) -> Column:
    return F.size(split_words(F.coalesce(text, F.lit("")))).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows whose content occurs twice or more.

    Windows are hashed to 64 bits, sorted with their position, equal
    neighbours give the repeated positions, and each position p covers
    [p, p + 2] less what the next one covers: n log n in the text's words."""

    def covered(at: Column) -> Column:
        own = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(own, F.lit(0), lambda a, x: a + x)

    def positions(s: Column) -> Column:
        same = F.filter(s, lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)))
        return let(F.array_sort(F.transform(same, lambda e: e["i"])), covered)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(F.array_sort(windows), positions)).cast("long")


def document_rules(docs: DataFrame, text: str = "text", min_words: int = 50,
                   max_repeat_pct: int = 50) -> DataFrame:
    """``docs`` with the rule measures and ``base_failed``."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(SOLID))
    counted = let(split_words(body), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    out = docs.drop(*RESULT).withColumns({
        "_w": counted,
        "word_chars": F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    })
    out = out.withColumns({"n_words": F.col("_w.n_words"), "n_repeat_words": F.col("_w.n_repeat_words")}).drop("_w")
    return out.withColumn("base_failed", (F.col("n_words") < min_words)
                          | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")))


def host_verdicts(judged: DataFrame, host: str, max_host_rate: float = 0.5) -> DataFrame:
    """One row per host: (_host, host_rate, host_kept). The prior is one row of
    moments; it is the only thing that the driver reads."""
    hosts = judged.groupBy(_key(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f"))
    rate = F.col("f") / F.col("n")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    alpha, beta = beta_prior(prior["m"], prior["v"])
    shrunk = (F.col("f") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    return hosts.select("_host", shrunk.alias("host_rate"), (shrunk <= max_host_rate).alias("host_kept"))


def beta_prior(mean: float | None, variance: float | None) -> tuple[float, float]:
    """Beta parameters with the given mean and variance of host rates; the
    strength stays within [1, 10^6] pseudo-documents."""
    if mean is None:
        return 0.5, 0.5
    spread = mean * (1 - mean)
    strength = min(max(spread / variance - 1, 1.0), 1e6) if variance and variance > 0 else 1e6
    return mean * strength, (1 - mean) * strength


def _key(host: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("null"))


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text",
                  max_host_rate: float = 0.5, **rules) -> DataFrame:
    """``docs`` without its text, with the rule measures, host_rate and
    ``kept``. The measures are written once (they are a few numbers per
    document) and serve the host statistics and the result."""
    docs = docs.drop("host_rate", "kept")
    judged = stage(document_rules(docs, text, **rules).drop(text), "quality-rules")
    hosts = host_verdicts(judged, host, max_host_rate)
    return (judged.withColumn("_host", _key(host)).join(hosts, "_host", "left")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_kept")).drop("_host", "host_kept"))


def op9_host_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, [x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
g AS (SELECT doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS gram
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM w WHERE len(ws) >= 3)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM g) WHERE k >= 2),
c AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM r) GROUP BY doc_id),
b AS (SELECT w.doc_id, w.source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
h AS (SELECT source, count(*) AS n, sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS f FROM j GROUP BY source),
m AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM h),
s AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1e6) ELSE 1e6 END AS k FROM m),
hv AS (SELECT source, (f + m * k) / (n + m * k + (1 - m) * k) <= 0.5 AS ok FROM h CROSS JOIN s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM j JOIN hv ON j.source IS NOT DISTINCT FROM hv.source
"""
