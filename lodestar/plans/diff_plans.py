"""Table comparison queries: orders against a copy of itself edited by
content-based rules (some rows dropped, some prices changed, some added)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import diff as D
from lodestar.sources.tables import load


def _pair(spark, sf_dir):
    """Expected = all orders. Actual = the same orders with content-based
    edits: pending low-priority orders dropped, urgent orders re-priced by
    +1.00, and high-priority finished orders added again under new keys."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                             "o_orderpriority")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    changed = (o.where(~((status == "P") & (prio == "5-LOW")))
               .withColumn("o_totalprice",
                           F.when(prio == "1-URGENT", F.round(F.col("o_totalprice") + 1.0, 2))
                           .otherwise(F.col("o_totalprice"))))
    added = (o.where((status == "F") & (prio == "2-HIGH"))
             .withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000))
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    return changed.unionByName(added).select(*cols), o.select(*cols)


def table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows only on one side, both directions, with multiplicities."""
    actual, expected = _pair(spark, sf_dir)
    return D.table_diff(actual, expected)


def table_diff_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 where few rows differ: order lines against a copy with some dropped
    and some written twice."""
    k = F.col("l_orderkey")
    e = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    a = e.where(k % 1009 != 5).unionByName(e.where(k % 2003 == 7)).withColumn(
        "l_returnflag", F.when(k % 997 != 11, F.col("l_returnflag")))
    return D.table_diff_by_checksums(a, e)


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed status per order (only the rows that are not 'same')."""
    actual, expected = _pair(spark, sf_dir)
    return D.reconcile(actual, expected, ["o_orderkey"], "o_totalprice").where(F.col("status") != "same")


QUERIES = {"table_diff": table_diff, "reconcile": reconcile, "table_diff_checksums": table_diff_checksums}

_PAIR = """
WITH e AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
a AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN round(o_totalprice + 1.0, 2) ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
  UNION ALL
  SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice FROM orders
  WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH')
"""

ORACLE = {
    "table_diff": _PAIR + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN na > ne THEN 'extra' ELSE 'missing' END AS side, CAST(abs(na - ne) AS BIGINT) AS n
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, sum(ta) AS na, sum(te) AS ne
      FROM (SELECT *, 1 AS ta, 0 AS te FROM a UNION ALL SELECT *, 0 AS ta, 1 AS te FROM e)
      GROUP BY ALL)
WHERE na <> ne""",
    "table_diff_checksums": """
WITH e AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem),
a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_orderkey % 997 <> 11 THEN l_returnflag END AS l_returnflag
      FROM (SELECT * FROM e WHERE l_orderkey % 1009 <> 5 UNION ALL SELECT * FROM e WHERE l_orderkey % 2003 = 7))
SELECT *, count(*) AS n FROM (SELECT *, 'extra' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e)
  UNION ALL SELECT *, 'missing' AS side FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a)) GROUP BY ALL""",
    "reconcile": _PAIR + """
SELECT * FROM (
  SELECT coalesce(a.o_orderkey, e.o_orderkey) AS o_orderkey, a.o_totalprice AS actual_value,
         e.o_totalprice AS expected_value,
         CASE WHEN a.o_orderkey IS NULL THEN 'missing' WHEN e.o_orderkey IS NULL THEN 'unexpected'
              WHEN a.o_totalprice IS DISTINCT FROM e.o_totalprice THEN 'changed' ELSE 'same' END AS status
  FROM a FULL OUTER JOIN e ON a.o_orderkey = e.o_orderkey)
WHERE status <> 'same'""",
}
