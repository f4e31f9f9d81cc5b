"""Connected components of an edge table, in Spark.

Every task first joins the edges it holds, ``LOCAL`` at a time: of these only
one per node stays, to the smallest node it reaches by them. A table of at most
``LOCAL`` edges is one such task and done. Else edges are rewired in two
alternating steps: every node's larger neighbours are attached to its smallest
neighbour (or itself), then its smaller ones and itself to the smallest; each
step is one grouped minimum and one join, whose large groups Spark can split.
Rounds are written to the shared folder; they end when no edge changes, after
about log(longest path) of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage_lean as stage

#: edges that a task joins at once
LOCAL = 1 << 18


def smallest_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the nodes that aren't the smallest of their component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _joined(limit: int):
    """For mapInArrow: edges (u, v) to fewer that connect the same nodes,
    ``limit`` at a time."""
    def run(batches):
        held, n = [], 0

        def out():
            u, v = smallest_reached(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= limit:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    return run


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """(node, root) of all nodes with an edge; ``root`` is the smallest node
    that can be reached."""
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    edges, limit = stage(edges, name), LOCAL
    for _ in range(2):
        few = edges.count() <= limit        # one task holds them all
        edges = stage((edges.coalesce(1) if few else edges).mapInArrow(_joined(limit), "u bigint, v bigint"), name)
        if few:
            return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), name)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_anti")
                             .select(F.col("v").alias("node"), F.col("v").alias("root")))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]
