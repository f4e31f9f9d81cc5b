"""Categorical decision tree (job E): Gini impurity, gain ratio, level-wise
induction and scoring (G9-G13, W4, I3-I5, I7, J14).

Training first reduces the table to its distinct (features, target) rows with
a count, in one partially aggregated pass: the base table is read once, and the
tree grows on rows whose number follows the value domain. Each depth is one
pass over them that computes the split statistics of *all* open nodes at once
from weighted (node, attr, value, target) counts. Rows of closed nodes leave
the working set; each level is written to the shared folder, so lineage does
not grow with depth. Scoring descends once per distinct feature row and joins
the labels back on the features, so no node id is ever a key of the table's
rows. Node ids have a fixed width (md5 of parent id, attribute and value).

Rules (per path): an attribute is used at most once on each root-to-leaf
path; a node becomes a leaf when its target is pure, when no remaining
attribute has two values, or when the best gain ratio (rounded to 12
decimals) is 0. The best split has the highest gain ratio; ties go to the
smallest attribute name. A node's label is its most frequent target value;
ties go to the smallest value. Scoring descends by the row's value and stops
at the current node when the value was not seen in training.

Null feature values do not take part in a split's statistics (the
attribute's statistics use the rows where it is set) and such rows stop at
the node that splits on that attribute; null targets are dropped.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.session import cut_lineage, materialize

ROOT = hashlib.md5(b"root").hexdigest()
SEP = "\x1f"
GAIN_DECIMALS = 12


@dataclass
class TreeModel:
    nodes: DataFrame      # node_id, parent_id, value, depth, label, n, split_attr (null = leaf)
    children: DataFrame   # node_id, value, child_id
    target: str
    features: list
    levels: int


def feature_map(df: DataFrame, features) -> F.Column:
    return F.create_map(*[x for f in features for x in (F.lit(f), F.col(f"`{f}`").cast("string"))])


def gini(counts_col_sq_sum, n) -> F.Column:
    """1 - sum((c/n)^2), from sum(c^2) and n."""
    return F.lit(1.0) - counts_col_sq_sum / (n * n)


def node_summary(rows: DataFrame) -> DataFrame:
    """G9, G10, G11, G13 per node: size, number of classes, majority label
    (lexicographic tie), Gini impurity."""
    keys = ["node_id"] + [c for c in ("parent_id", "value") if c in rows.columns]
    tc = rows.groupBy(*keys, "target").agg(F.sum("c").alias("c"))
    return (tc.groupBy(*keys)
            .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_classes"),
                 F.sum(F.col("c") * F.col("c")).alias("sq"),
                 F.min(F.struct((-F.col("c")).alias("neg"), F.col("target").alias("t"))).alias("best"))
            .select(*keys, "n", "n_classes", F.col("best.t").alias("label"),
                    gini(F.col("sq").cast("double"), F.col("n").cast("double")).alias("gini")))


def split_statistics(rows: DataFrame) -> DataFrame:
    """For every open node and every attribute not yet used on its
    path: number of values, weighted child Gini, split information and gain
    ratio (0 when split information is 0), rounded to 12 decimals.

    Everything comes from one table of (node, attr, value, target) counts:
    the node total is a window sum over that node-attribute's value rows
    (few rows: one per value), the parent Gini an aggregate over its target
    totals joined back on (node, attr). Rows whose value is null for an
    attribute do not count for that attribute."""
    long = rows.select("node_id", "target", "c",
                       F.explode(F.map_filter("feats", lambda k, v: ~F.array_contains(F.col("used"), k)
                                              & v.isNotNull())).alias("attr", "value"))
    cnt = long.groupBy("node_id", "attr", "value", "target").agg(F.sum("c").alias("c"))
    parent = (cnt.groupBy("node_id", "attr", "target").agg(F.sum("c").alias("ct"))
              .groupBy("node_id", "attr")
              .agg(gini(F.sum(F.col("ct") * F.col("ct")).cast("double"),
                        F.sum("ct").cast("double")).alias("g0")))
    per_node_attr = Window.partitionBy("node_id", "attr")
    per_val = (cnt.groupBy("node_id", "attr", "value")
               .agg(F.sum("c").alias("nv"), F.sum(F.col("c") * F.col("c")).alias("sq"))
               .withColumn("n", F.sum("nv").over(per_node_attr).cast("double")))
    p = F.col("nv") / F.col("n")
    per_val = per_val.select("node_id", "attr", "value", "nv",
                             (p * gini(F.col("sq").cast("double"), F.col("nv").cast("double"))).alias("wg"),
                             (-p * F.log2(p)).alias("si"))
    per_attr = (per_val.groupBy("node_id", "attr")
                .agg(F.count(F.lit(1)).alias("n_values"), F.sum("wg").alias("weighted_gini"),
                     F.sum("si").alias("split_info"))
                .join(parent.withColumnRenamed("g0", "parent_gini"), ["node_id", "attr"]))
    ratio = F.when(F.col("split_info") != 0,
                   (F.col("parent_gini") - F.col("weighted_gini")) / F.col("split_info")).otherwise(F.lit(0.0))
    return per_attr.withColumn("gain_ratio", F.round(ratio, GAIN_DECIMALS))


def best_splits(stats: DataFrame) -> DataFrame:
    """Per node the attribute with the highest gain ratio, ties by name."""
    w = Window.partitionBy("node_id").orderBy(F.col("gain_ratio").desc(), F.col("attr").asc())
    return (stats.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") == 1)
            .select("node_id", F.col("attr").alias("split_attr"), "gain_ratio", "n_values"))


def fit(df: DataFrame, target: str | None = None, features=None, max_levels: int | None = None) -> TreeModel:
    """I3 + I4: grow the tree level by level. ``target`` defaults to the
    last column (ignoring ``row_id``)."""
    cols = [c for c in df.columns if c != "row_id"]
    target = target or cols[-1]
    features = list(features or [c for c in cols if c != target])
    rows = cut_lineage(training_rows(df, target, features)
                       .withColumn("parent_id", F.lit(None).cast("string"))
                       .withColumn("value", F.lit(None).cast("string")))
    nodes = None
    level = 0
    limit = max_levels if max_levels is not None else len(features)
    while True:
        summary = node_summary(rows)           # one row per node, with its parent and branch value
        best = best_splits(split_statistics(rows))
        decided = (summary.join(best, "node_id", "left")
                   .withColumn("split_attr",
                               F.when((F.col("n_classes") > 1) & (F.col("n_values") > 1)
                                      & (F.col("gain_ratio") != 0) & F.lit(level < limit),
                                      F.col("split_attr")))
                   .select("node_id", "parent_id", "value", F.lit(level).alias("depth"),
                           "label", "n", "split_attr", "gain_ratio"))
        decided, _, counts = materialize(decided, stats=[F.count("split_attr").alias("n_splits")])
        nodes = decided if nodes is None else nodes.unionByName(decided)
        if counts["n_splits"] == 0:
            break
        splits = decided.where(F.col("split_attr").isNotNull()).select("node_id", "split_attr")
        rows = (rows.drop("parent_id", "value").join(splits, "node_id")
                .withColumn("value", F.try_element_at(F.col("feats"), F.col("split_attr")))
                .where(F.col("value").isNotNull())
                .select(child_id(F.col("node_id"), F.col("split_attr"), F.col("value")).alias("node_id"),
                        "feats", "target", "c", F.array_union("used", F.array("split_attr")).alias("used"),
                        F.col("node_id").alias("parent_id"), "value"))
        rows = cut_lineage(rows)
        level += 1
    # a child is every non-root node: (parent, branch value) -> child id
    children = nodes.where(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("node_id"), "value", F.col("node_id").alias("child_id"))
    return TreeModel(nodes=nodes, children=children, target=target, features=features, levels=level)


def child_id(node, attr, value) -> F.Column:
    """Fixed-width id of the child of ``node`` for ``attr`` = ``value``."""
    return F.md5(F.concat(node, F.lit(SEP), attr, F.lit("="), value))


def predict(model: TreeModel, df: DataFrame, key: str = "row_id") -> DataFrame:
    """J14 + I5: each distinct feature row descends one level per step by
    joining its node and value to the children table; an unseen value keeps
    the node. The labels are joined back on the feature values (null-safe).
    Output: key, prediction."""
    feats = [c for c in model.features if c in df.columns]
    if not feats or not model.levels:      # nothing to descend by: the root's label, one value
        root = model.nodes.where(F.col("node_id") == ROOT).select(F.first("label")).scalar()
        return df.select(key, root.alias("prediction"))
    cur = df.select(*feats).distinct()
    cur = cur.select(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(feats)],
                     feature_map(cur, feats).alias("feats"), F.lit(ROOT).alias("node_id"))
    own = [f"_f{i}" for i in range(len(feats))]
    splits = model.nodes.where(F.col("split_attr").isNotNull()).select("node_id", "split_attr")
    for _ in range(model.levels):
        cur = (cur.join(splits, "node_id", "left")
               .withColumn("value", F.try_element_at(F.col("feats"), F.col("split_attr")))
               .join(model.children, ["node_id", "value"], "left")
               .select(*own, "feats", F.coalesce(F.col("child_id"), F.col("node_id")).alias("node_id")))
    labelled = cur.join(model.nodes.select("node_id", "label"), "node_id").select(*own, F.col("label").alias("prediction"))
    same = F.lit(True)
    for o, c in zip(own, feats):
        same = same & F.col(c).eqNullSafe(F.col(o))
    return df.select(key, *feats).join(labelled, same).select(key, "prediction")


def describe(model: TreeModel) -> DataFrame:
    """The model as a table, one row per node with the values and labels
    of its children (one entry per value of the split attribute)."""
    kids = (model.nodes.where(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("node_id"))
            .agg(F.array_sort(F.collect_list(F.struct("value", F.col("label").alias("child_label")))).alias("children")))
    return model.nodes.join(kids, "node_id", "left")


def training_rows(df: DataFrame, target: str, features) -> DataFrame:
    """The root working set: distinct (features, target) rows with their count
    ``c``, all at the root node, nothing used yet."""
    distinct = (df.where(F.col(f"`{target}`").isNotNull())
                .groupBy(*[F.col(f"`{f}`").cast("string").alias(f) for f in features],
                         F.col(f"`{target}`").cast("string").alias("_target"))
                .agg(F.count(F.lit(1)).alias("c")))
    return distinct.select(F.lit(ROOT).alias("node_id"), feature_map(distinct, features).alias("feats"),
                           F.col("_target").alias("target"), "c", F.array().cast("array<string>").alias("used"))
