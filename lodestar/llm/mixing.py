"""Mixing sources to target weights by systematic sampling (native).

Every source has a weight; the sources share ``share`` times all words by
weight, no source gets more than ``cap`` times its own words, and what is above
is shared again by weight. Within a source each document expects
target / source_size copies; the expected copies are summed in a fixed order,
one offset in [0, 1) is added, and a document is taken once for every integer
that the running sum passes while going over it.

The order is (size class, hash of doc_id, size, doc_id): documents of like size
lie next to each other, so the taken words come near the target. The running
sum is made in three short levels (size class, two hash digits, two more) and
inside one chunk, so a source with a third of all rows spreads over thousands
of chunks. The hash depends on the data alone: reruns agree.

Defined results: null and empty text have size 0 and take 0 words; a source
whose documents have no words has target 0 and takes none; a null source comes
last; repeated rows are separate documents; an empty table gives an empty
table; input columns named like a result column are replaced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .host_rules import word_count

RESULT = ["size", "source_size", "target", "copies", "taken"]


def _key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``sizes`` (_key, _source, source_size; one row per source) with weight,
    target and offset.

    Sources in ascending order of cap / weight: those before the first one that
    the common level does not fill are at their cap, the others share the rest
    by weight. The windows without partition hold one row per source."""
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("_n") - 1, F.lit(len(weights))).cast("int"))
    limit = F.lit(float(cap)) * F.col("source_size")
    by_fill = W.orderBy(F.col("_limit") / F.col("weight"), "_n")
    everything = W.partitionBy()
    return (
        sizes.withColumn("_n", F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())))
        .withColumn("weight", weight).withColumn("_limit", limit)
        .withColumn("_i", F.row_number().over(by_fill))
        .withColumn("_rest", F.lit(float(share)) * F.sum("source_size").over(everything)
                    - (F.sum("_limit").over(by_fill.rowsBetween(W.unboundedPreceding, 0)) - F.col("_limit")))
        .withColumn("_open", F.sum("weight").over(by_fill.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("_level", F.col("_rest") / F.col("_open"))
        .withColumn("_fits", F.when(F.col("_level") * F.col("weight") <= F.col("_limit"), F.col("_i")))
        .withColumn("_level", F.min_by("_level", "_fits").over(everything))
        .withColumn("target", F.least(F.col("_limit"), F.coalesce(F.col("_level") * F.col("weight"), F.col("_limit"))))
        .select("_key", "source_size", "target",
                (F.conv(F.substring(F.md5(F.col("_key")), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)).alias("_offset"))
    )


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                source: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken; one row per
    input row (``repeated`` expands it into the mix)."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    sized = docs.drop(*RESULT).withColumns({
        "size": word_count(F.col(text)), "_key": _key(source),
        "_a": F.substring(digest, 1, 2), "_b": F.substring(digest, 3, 2),
    }).withColumn("_class", F.length(F.bin(F.col("size"))))
    targets = source_targets(
        sized.groupBy("_key").agg(F.first(F.col(source)).alias("_source"), F.sum("size").alias("source_size")),
        weights, share, cap)

    level = ["_key", "_class", "_a", "_b"]
    starts, counts = targets, sized.groupBy(*level).agg(F.count(F.lit(1)).alias("_rows"))
    for k in (2, 3, 4):
        part = counts.groupBy(*level[:k]).agg(F.sum("_rows").alias("_rows")) if k < 4 else counts
        before = W.partitionBy(*level[:k - 1]).orderBy(level[k - 1]).rowsBetween(W.unboundedPreceding, -1)
        part = part.withColumn(f"_start{k}", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
        starts = part.join(starts, level[:k - 1])
    starts = starts.withColumn("_start", F.col("_start2") + F.col("_start3") + F.col("_start4"))

    rank = F.col("_start") + F.row_number().over(
        W.partitionBy(*level).orderBy("size", F.col(doc_id).asc_nulls_first(), F.xxhash64(F.col(text))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(F.col("_offset") + F.col("_rate") * F.col("_rank")) - F.floor(
        F.col("_offset") + F.col("_rate") * (F.col("_rank") - 1))
    out = sized.join(starts.drop("_start2", "_start3", "_start4"), level).withColumns({"_rank": rank, "_rate": rate})
    out = out.withColumn("copies", crossed.cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*[c for c in docs.columns if c not in RESULT], *RESULT)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    return (mixed.where(F.col("copies") > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("_copy"))


def take_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents as often as the mix takes them."""
    return repeated(mix_sources(docs)).select(*docs.columns)


def op7_systematic_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len([x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+')
                  IF x <> '']) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM s0),
s2 AS (SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
              2.0::DOUBLE * source_size AS lim FROM s1),
s3 AS (SELECT *, row_number() OVER (ORDER BY lim / weight, n) AS i FROM s2),
s4 AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - (sum(lim) OVER (ORDER BY i) - lim))
              / sum(weight) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s3),
lv AS (SELECT level FROM s4 WHERE level * weight <= lim ORDER BY i LIMIT 1),
t AS (SELECT source, source_size, least(lim, coalesce((SELECT level FROM lv) * weight, lim)) AS target,
             md5(coalesce('=' || source, 'null')) AS m FROM s4),
r AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY length(bin(size)), substr(md5(CAST(doc_id AS VARCHAR)), 1, 4),
             size, doc_id) AS rank FROM d),
x AS (SELECT r.doc_id, r.size, t.source_size, t.target, r.rank,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
             CAST(('0x' || substr(t.m, 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(u + rate * rank) - floor(u + rate * (rank - 1))) * size AS BIGINT) AS taken
FROM x
"""
