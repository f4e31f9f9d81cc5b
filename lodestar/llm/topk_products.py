"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Candidates and queries are dealt into blocks of bounded size by hash; a cell
holds one block of each. In a cell every vector component that is not zero is a
posting (component, row, weight). Component by component, the queries that
hold it add weight times weight to a dense array of scores; a partition
selection keeps k per query, and the cells' selections are merged.

Components become floor(scale * x). Defined results: vectors that are null or
hold a null or non-finite component take no part; vectors of different lengths
meet on their common components; a row that repeats a vec_id and its vector
counts once, the same vec_id with another vector is a row of its own (of which
neither is a candidate of the other); scores outside a long are clipped to it;
an empty table gives an empty table; further columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 512
_LONG = 2**63 - 1


def _quantised(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, component, weight) of the components that are not zero."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.array([len(x) for x in column], np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    weight = np.floor(scale * flat)
    row = np.repeat(np.arange(len(size)), size)
    component = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    at = np.flatnonzero(weight)
    return row[at], component[at], weight[at]


def scores(query: tuple, candidate: tuple, n_query: int, n_candidate: int) -> np.ndarray:
    """Dense scores of all queries against all candidates of a cell."""
    top = [max(abs(x[2]).max(initial=0), 1) for x in (query, candidate)]
    dims = int(max(query[1].max(initial=0), candidate[1].max(initial=0))) + 1
    exact = top[0] * top[1] * dims < 2.0**62
    kind = (lambda w: w.astype(np.int64)) if exact else (lambda w: np.array([int(x) for x in w], object))
    out = np.zeros((n_query, n_candidate), np.int64 if exact else object)
    parts = []
    for row, component, weight in (query, candidate):
        by = np.argsort(component, kind="stable")
        edge = np.searchsorted(component[by], np.arange(dims + 1))
        parts.append((row[by], kind(weight[by]), edge))
    (q_row, q_weight, q_edge), (c_row, c_weight, c_edge) = parts
    for j in range(dims):
        cr, cw = c_row[c_edge[j]:c_edge[j + 1]], c_weight[c_edge[j]:c_edge[j + 1]]
        dense = len(cr) == n_candidate
        for r, w in zip(q_row[q_edge[j]:q_edge[j + 1]], q_weight[q_edge[j]:q_edge[j + 1]], strict=True):
            if dense:
                out[r] += w * cw
            else:
                out[r, cr] += w * cw
    return out if exact else np.clip(out, -_LONG - 1, _LONG).astype(np.int64)


def select(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(score) > k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= floor)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], ~score[at]))][:k]


def top_products(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, vec_id: str = "vec_id",
                 embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for every row with ``is_query`` (a Column)."""
    bad = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).alias("v"), is_query.alias("asks")).where(
        F.col("v").isNotNull() & F.col("id").isNotNull() & ~bad)
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("asks").cast("int")), F.lit(0)).alias("q")).first()
    n_c, n_q = -(-n["n"] // CANDIDATE_BLOCK) or 1, -(-n["q"] // QUERY_BLOCK) or 1

    def all_blocks(m):
        return F.explode(F.sequence(F.lit(0), F.lit(m - 1)))

    def own_block(m):
        return F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")

    candidates = rows.select(own_block(n_c).alias("c"), all_blocks(n_q).alias("q"), "id", "v")
    queries = rows.where("asks").select(all_blocks(n_c).alias("c"), own_block(n_q).alias("q"), "id", "v")

    def once(t: pa.Table) -> pa.Table:
        """The cell's rows in order of id, repeated rows once."""
        order = np.argsort(t["id"].to_numpy(), kind="stable")
        t = t.take(order)
        seen, keep = set(), []
        for i, (a, v) in enumerate(zip(t["id"].to_pylist(), t["v"].to_pylist(), strict=True)):
            if (mark := (a, tuple(v))) not in seen:
                seen.add(mark)
                keep.append(i)
        return t.take(keep) if len(keep) < len(t) else t

    def cell(c: pa.Table, q: pa.Table) -> pa.Table:
        out = {"query_id": [], "query_no": [], "vec_id": [], "score": []}
        if len(c) and len(q):
            c, q = once(c), once(q)
            ids, asked = c["id"].to_numpy(), q["id"].to_numpy()
            table = scores(_quantised(q["v"], scale), _quantised(c["v"], scale), len(q), len(c))
            no = np.arange(len(asked)) - np.searchsorted(asked, asked)
            for i, one in enumerate(table):
                other = np.flatnonzero(ids != asked[i])
                best = other[select(one[other], ids[other], k)]
                out["query_id"] += [asked[i]] * len(best)
                out["query_no"] += [no[i]] * len(best)
                out["vec_id"] += ids[best].tolist()
                out["score"] += one[best].tolist()
        return pa.table({n: pa.array(x, pa.int64()) for n, x in out.items()})

    best = candidates.groupBy("c", "q").cogroup(queries.groupBy("c", "q")).applyInArrow(
        cell, "query_id bigint, query_no bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(W.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_top_products(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_products(vectors, F.col("vec_id") % 50 == 0)


OP8_SQL = """
WITH v AS (SELECT vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL
           AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i,
             CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
      FROM c AS q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
