"""Decision-tree and feature-preparation queries over documents + labels
(features: lang, source, length bin; target: quality) and part/customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import prep as P
from lodestar.operators import tree as TR
from lodestar.sources.tables import load

FEATURES = ["lang", "source", "len_bin"]
TARGET = "quality"
# Fixed values of this binding: document length bins.
LEN_BINS = [("<", 500, "short"), ("<", 2000, "medium"), "long"]


def _doc_features(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", "source", P.bin_column(F.col("n_chars"), LEN_BINS).alias("len_bin"))


def _training(spark, sf_dir):
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias(TARGET))
    return _doc_features(spark, sf_dir).join(labels, "doc_id")


def tree_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G9 + G13 at the root: rows per (attribute, value, target)."""
    rows = TR.training_rows(_training(spark, sf_dir), TARGET, FEATURES)
    return (rows.select("target", "c", F.explode("feats").alias("attr", "value")).where("value IS NOT NULL")
            .groupBy("attr", "value", "target").agg(F.sum("c").alias("c")))


def tree_split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G11 + G12 at the root: per attribute, values, weighted Gini, split
    information and gain ratio."""
    rows = TR.training_rows(_training(spark, sf_dir), TARGET, FEATURES)
    stats = TR.split_statistics(rows)
    # sums of doubles depend on summation order in their last bits: report 12 decimals
    return stats.select("attr", "n_values", *[F.round(c, TR.GAIN_DECIMALS).alias(c)
                                              for c in ("weighted_gini", "split_info", "parent_gini")],
                        "gain_ratio")


def tree_best_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 at the root."""
    rows = TR.training_rows(_training(spark, sf_dir), TARGET, FEATURES)
    best = TR.best_splits(TR.split_statistics(rows))
    return best.select("split_attr", "gain_ratio", "n_values")


def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 + I4 + I7: the whole trained tree as a node table."""
    m = TR.fit(_training(spark, sf_dir), TARGET, FEATURES)
    return m.nodes.select("node_id", "parent_id", "value", "depth", "label", "n", "split_attr")


def tree_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I7 + G10: the tree as a listing, one row per node with its children."""
    listing = TR.describe(TR.fit(_training(spark, sf_dir), TARGET, FEATURES))
    entry = F.transform("children", lambda c: F.concat(c["value"], F.lit(" -> "), c["child_label"]))
    return listing.select("node_id", "depth", "label", "split_attr",
                          F.coalesce(F.array_join(entry, "; "), F.lit("")).alias("children"))


def tree_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 + J14: train on labelled documents, score every document."""
    m = TR.fit(_training(spark, sf_dir), TARGET, FEATURES)
    scored = TR.predict(m, _doc_features(spark, sf_dir), key="doc_id")
    return scored.select("doc_id", "prediction")


def prep_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16 + T14: drop parts with a zero size or price, bin size and price."""
    part = P.drop_zero_records(load(spark, sf_dir, "part"), ["p_size", "p_retailprice"])
    return part.select(
        "p_partkey",
        P.bin_column(F.col("p_size"), [("<", 10, "small"), ("<", 30, "medium"), "large"]).alias("size_bin"),
        P.bin_column(F.col("p_retailprice"), [("<", 1000.0, "low"), ("<=", 1500.0, "mid"), "high"]).alias("price_bin"))


def prep_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic 90/10 split of customers, with an account-balance bin."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey",
                    P.bin_column(F.col("c_acctbal"), [("<", 0.0, "negative"), ("<", 5000.0, "medium"), "high"])
                    .alias("bal_bin"),
                    P.key_split(F.col("c_custkey")).alias("split"))


QUERIES = {
    "tree_counts": tree_counts,
    "tree_split_stats": tree_split_stats,
    "tree_best_split": tree_best_split,
    "tree_nodes": tree_nodes,
    "tree_describe": tree_describe,
    "tree_predict": tree_predict,
    "prep_bins": prep_bins,
    "prep_split": prep_split,
}

_TRAIN = """
WITH f AS (SELECT doc_id, lang, source,
             CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 2000 THEN 'medium' ELSE 'long' END AS len_bin
           FROM documents),
t AS (SELECT f.*, CAST(l.quality AS VARCHAR) AS target FROM f JOIN labels l ON f.doc_id = l.doc_id
      WHERE l.quality IS NOT NULL),
long AS (SELECT 'lang' AS attr, lang AS value, target FROM t
   UNION ALL SELECT 'source', source, target FROM t
   UNION ALL SELECT 'len_bin', len_bin, target FROM t),
cnt AS (SELECT attr, value, target, count(*) AS c FROM long WHERE value IS NOT NULL GROUP BY ALL),
root AS (SELECT sum(c) AS n, 1.0 - sum(c * c) / (sum(c) * sum(c)) AS g0 FROM (
           SELECT target, count(*) AS c FROM t GROUP BY target)),
per_val AS (SELECT attr, value, sum(c) AS nv, sum(c * c) AS sq FROM cnt GROUP BY attr, value),
per_attr AS (
  SELECT attr, count(*) AS n_values,
         sum((nv / n) * (1.0 - sq / (nv * nv))) AS weighted_gini,
         sum(-(nv / n) * log2(nv / n)) AS split_info, any_value(g0) AS parent_gini
  FROM per_val CROSS JOIN root GROUP BY attr),
stats AS (SELECT *, round(CASE WHEN split_info <> 0 THEN (parent_gini - weighted_gini) / split_info
                               ELSE 0.0 END, 12) AS gain_ratio FROM per_attr)
"""


def _grown() -> str:
    """The tree unrolled: one block of views per depth, from the definitions
    of impurity and gain ratio over the training rows themselves."""
    out = [_TRAIN.split("long AS")[0].rstrip().rstrip(","),
           "rows0 AS (SELECT md5('root') AS node_id, CAST(NULL AS VARCHAR) AS parent_id, CAST(NULL AS VARCHAR) AS value, "
           "lang, source, len_bin, target, '' AS used FROM t)"]
    last = len(FEATURES)
    for d in range(last + 1):
        long = " UNION ALL ".join(
            f"SELECT node_id, '{f}' AS attr, {f} AS v, target FROM rows{d} WHERE {f} IS NOT NULL AND NOT contains(used, '|{f}|')"
            for f in FEATURES)
        picked = " ".join(f"WHEN '{f}' THEN r.{f}" for f in FEATURES)
        out += [
            f"by_class{d} AS (SELECT node_id, parent_id, value, target, count(*) AS k FROM rows{d} GROUP BY ALL)",
            f"node{d} AS (SELECT node_id, parent_id, value, sum(k) AS n, count(*) AS classes, "
            f"first(target ORDER BY k DESC, target) AS label FROM by_class{d} GROUP BY node_id, parent_id, value)",
            f"long{d} AS ({long})",
            f"cell{d} AS (SELECT node_id, attr, v, target, count(*) AS k FROM long{d} GROUP BY ALL)",
            f"branch{d} AS (SELECT node_id, attr, v, sum(k) AS nv, 1 - sum(k * k) / (sum(k) * sum(k)) AS impurity FROM cell{d} GROUP BY ALL)",
            f"whole{d} AS (SELECT node_id, attr, 1 - sum(kt * kt) / (sum(kt) * sum(kt)) AS impurity, sum(kt) AS n FROM "
            f"(SELECT node_id, attr, target, sum(k) AS kt FROM cell{d} GROUP BY ALL) GROUP BY ALL)",
            f"gain{d} AS (SELECT b.node_id, b.attr, count(*) AS n_values, any_value(w.impurity) - sum(b.nv / w.n * b.impurity) AS gain, "
            f"-sum(b.nv / w.n * log2(b.nv / w.n)) AS info FROM branch{d} b JOIN whole{d} w ON b.node_id = w.node_id AND b.attr = w.attr GROUP BY ALL)",
            f"ratio{d} AS (SELECT *, round(CASE WHEN info <> 0 THEN gain / info ELSE 0 END, 12) AS ratio FROM gain{d})",
            f"best{d} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY ratio DESC, attr) AS i FROM ratio{d}) WHERE i = 1)",
            f"done{d} AS (SELECT n.node_id, n.parent_id, n.value, {d} AS depth, n.label, n.n, CASE WHEN n.classes > 1 AND b.n_values > 1 "
            f"AND b.ratio <> 0 AND {d} < {last} THEN b.attr END AS split_attr FROM node{d} n LEFT JOIN best{d} b ON n.node_id = b.node_id)",
        ]
        if d < last:
            out.append(
                f"rows{d + 1} AS (SELECT md5(node_id || chr(31) || split_attr || '=' || value) AS node_id, node_id AS parent_id, value, "
                f"lang, source, len_bin, target, used || '|' || split_attr || '|' AS used FROM (SELECT r.node_id, s.split_attr, "
                f"CASE s.split_attr {picked} END AS value, r.lang, r.source, r.len_bin, r.target, r.used FROM rows{d} r JOIN done{d} s "
                f"ON r.node_id = s.node_id WHERE s.split_attr IS NOT NULL) WHERE value IS NOT NULL)")
    out.append("nodes AS (" + " UNION ALL ".join(f"SELECT * FROM done{d}" for d in range(last + 1)) + ")")
    return ",\n".join(out)


def _scored() -> str:
    """Every document at the root, then one step down per depth."""
    steps = ["at0 AS (SELECT doc_id, lang, source, len_bin, md5('root') AS node_id FROM f)"]
    for d in range(len(FEATURES)):
        picked = " ".join(f"WHEN '{f}' THEN a.{f}" for f in FEATURES)
        steps.append(f"at{d + 1} AS (SELECT a.doc_id, a.lang, a.source, a.len_bin, coalesce(k.node_id, a.node_id) AS node_id FROM at{d} a "
                     f"JOIN nodes n ON n.node_id = a.node_id LEFT JOIN nodes k ON k.parent_id = n.node_id "
                     f"AND k.value = CASE n.split_attr {picked} END)")
    return ",\n".join(steps)


ORACLE = {
    "tree_nodes": _grown() + " SELECT node_id, parent_id, value, depth, label, CAST(n AS BIGINT) AS n, split_attr FROM nodes",
    "tree_describe": _grown() + """ SELECT n.node_id, n.depth, n.label, n.split_attr,
  coalesce(string_agg(k.value || ' -> ' || k.label, '; ' ORDER BY k.value), '') AS children
FROM nodes n LEFT JOIN nodes k ON k.parent_id = n.node_id GROUP BY ALL""",
    "tree_predict": _grown() + ",\n" + _scored() + f""" SELECT a.doc_id, n.label AS prediction
FROM at{len(FEATURES)} a JOIN nodes n ON n.node_id = a.node_id""",
    "tree_counts": _TRAIN + "SELECT attr, value, target, c FROM cnt",
    "tree_split_stats": _TRAIN + """SELECT attr, n_values, round(weighted_gini, 12) AS weighted_gini,
  round(split_info, 12) AS split_info, round(parent_gini, 12) AS parent_gini, gain_ratio FROM stats""",
    "tree_best_split": _TRAIN + """SELECT attr AS split_attr, gain_ratio, n_values FROM stats
ORDER BY gain_ratio DESC, attr ASC LIMIT 1""",
    "prep_bins": """
SELECT p_partkey,
  CASE WHEN p_size IS NULL THEN NULL WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_bin,
  CASE WHEN p_retailprice IS NULL THEN NULL WHEN p_retailprice < 1000.0 THEN 'low'
       WHEN p_retailprice <= 1500.0 THEN 'mid' ELSE 'high' END AS price_bin
FROM part WHERE p_size <> 0 AND p_retailprice <> 0""",
    "prep_split": """
SELECT c_custkey,
  CASE WHEN c_acctbal IS NULL THEN NULL WHEN c_acctbal < 0.0 THEN 'negative' WHEN c_acctbal < 5000.0 THEN 'medium'
       ELSE 'high' END AS bal_bin,
  CASE WHEN c_custkey % 10 < 1 THEN 'test' ELSE 'train' END AS split
FROM customer""",
}
