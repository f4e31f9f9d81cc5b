"""Search queries (job C) over the driver tables.

The course schema is bound to the TPC-H-like tables; every role is derived
by Spark from the given tables, so the work grows with them:

* courses          <- part      (course_id = p_partkey, dept = p_brand,
                                  course_num = p_size as text, title = p_name)
* catalog_index    <- part      (words of lower(p_name || ' ' || p_type))
* sections         <- lineitem  (course = l_partkey, pattern = l_orderkey,
                                  section_num = 2-digit l_linenumber,
                                  enrollment = floor(l_quantity),
                                  building = 'B' || l_suppkey)
* meeting_patterns <- orders    (day from o_orderstatus; start minute
                                  480 + 30 * (o_orderkey % 20), 80 minutes long,
                                  written as hhmm)
* gps              <- supplier  (building = 'B' || s_suppkey, coordinates
                                  derived from the keys)

``lineitem`` is the fact table: it is never broadcast. The dimension sides
are left to AQE (broadcast only when their measured size is under the
threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import search as S
from lodestar.sources.tables import load

# Fixed values of this binding (not of the reference): day pattern per order
# status and coordinate origin / steps for supplier buildings.
DAY_OF_STATUS = (("F", "MWF"), ("O", "TR"), ("P", "MW"))
LON0, LON_STEP, LON_MOD = -87.6, 0.0005, 37
LAT0, LAT_STEP = 41.79, 0.0004


def _hhmm(minutes):
    return ((minutes / 60).cast("int") * 100 + minutes % 60).cast("int")


def course_tables(spark: SparkSession, sf_dir: str) -> S.CourseTables:
    part = load(spark, sf_dir, "part")
    courses = part.select(F.col("p_partkey").alias("course_id"), F.col("p_brand").alias("dept"),
                          F.col("p_size").cast("string").alias("course_num"),
                          F.col("p_name").alias("title"))
    catalog_index = (part.select(F.col("p_partkey").alias("course_id"),
                                 F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " "))
                                 .alias("word"))
                     .distinct())
    li = load(spark, sf_dir, "lineitem")
    sections = li.select(F.col("l_partkey").alias("course_id"),
                         F.col("l_orderkey").alias("meeting_pattern_id"),
                         F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("section_num"),
                         F.floor("l_quantity").cast("int").alias("enrollment"),
                         F.concat(F.lit("B"), F.col("l_suppkey").cast("string")).alias("building_code"))
    orders = load(spark, sf_dir, "orders")
    day = F.lit(None).cast("string")
    for status, pattern in reversed(DAY_OF_STATUS):
        day = F.when(F.col("o_orderstatus") == status, F.lit(pattern)).otherwise(day)
    start = (F.lit(480) + F.lit(30) * (F.col("o_orderkey") % 20)).cast("int")
    patterns = orders.select(F.col("o_orderkey").alias("meeting_pattern_id"), day.alias("day"),
                             _hhmm(start).alias("time_start"), _hhmm(start + 80).alias("time_end"))
    supplier = load(spark, sf_dir, "supplier")
    gps = supplier.select(
        F.concat(F.lit("B"), F.col("s_suppkey").cast("string")).alias("building_code"),
        (F.lit(LON0) + (F.col("s_suppkey") % LON_MOD).cast("double") * F.lit(LON_STEP)).alias("lon"),
        (F.lit(LAT0) + F.col("s_nationkey").cast("double") * F.lit(LAT_STEP)).alias("lat"))
    return S.CourseTables(courses, sections, patterns, gps, catalog_index)


REQUESTS = {
    "search_tier1": {"dept": "Brand#3", "terms": ["small"]},
    "search_terms_only": {"terms": ["blue", "bolt"]},
    "search_tier2": {"terms": ["small"], "day": ["MWF", "TR"], "enrollment": [10, 30],
                     "time_start": 900, "time_end": 1400},
    "search_tier2_only": {"day": ["TR"], "time_start": 1000, "time_end": 1200, "enrollment": [40, 50]},
    "search_tier3": {"dept": "Brand#7", "day": ["MW", "MWF"], "building_code": "B7",
                     "walking_time": 10},
}


def _search(name):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return S.find_courses(course_tables(spark, sf_dir), REQUESTS[name])
    return run


def walk_time_from_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every building within 12 walking minutes of B3."""
    t = course_tables(spark, sf_dir)
    lon0, lat0 = S.anchor_point(t.gps, "B3")
    from lodestar.functions.geo import walking_minutes
    return (t.gps.withColumn("walking_time", walking_minutes(F.col("lon"), F.col("lat"), lon0, lat0))
            .where(F.col("walking_time") <= 12)
            .select("building_code", "walking_time"))


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 + F15: distinct order priorities except one sentinel value."""
    return S.distinct_values(load(spark, sf_dir, "orders"), "o_orderpriority", exclude="5-LOW")


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One part's attributes by key."""
    return S.point_lookup(load(spark, sf_dir, "part"), "p_partkey", 42,
                          ["p_partkey", "p_name", "p_brand", "p_retailprice"])


def topn_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 + W8: the 10 most expensive orders (a top-k report; ties broken by key)."""
    o = load(spark, sf_dir, "orders")
    return S.top_sorted(o.select("o_orderkey", "o_totalprice"),
                        [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


def request_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11 + F12 over a requests table derived from orders (one request per
    order; hhmm values and bounds from key arithmetic, some deliberately bad)."""
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    req = o.select(
        k.alias("request_id"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(((k * 7) % 2500).cast("int")).alias("time_start"),
        ((k * 13) % 2500).cast("int").alias("time_end"),
        F.when(k % 5 == 0, F.lit(None)).otherwise((k % 1100).cast("int")).alias("enroll_lo"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(((k * 3) % 1100).cast("int")).alias("enroll_hi"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("B"), (k % 50).cast("string"))).alias("building_code"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(((k % 30) - 5).cast("int")).alias("walking_time"),
    )
    out = S.request_rule_violations(req)
    return out.select("request_id", F.size("problems").alias("n_problems"),
                      F.array_join("problems", "; ").alias("problems"))


QUERIES = {name: _search(name) for name in REQUESTS}
QUERIES.update({
    "walk_time_from_anchor": walk_time_from_anchor,
    "distinct_values": distinct_values,
    "point_lookup": point_lookup,
    "topn_sorted": topn_sorted,
    "request_rules": request_rules,
})

# ---------------------------------------------------------------------------
# DuckDB oracles. The derived tables are re-stated in SQL independently.

_DERIVED = """
WITH courses AS (
  SELECT p_partkey AS course_id, p_brand AS dept, CAST(p_size AS VARCHAR) AS course_num,
         p_name AS title FROM part),
catalog_index AS (
  SELECT DISTINCT course_id, word FROM (
    SELECT p_partkey AS course_id,
           unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS word FROM part)),
sections AS (
  SELECT l_partkey AS course_id, l_orderkey AS meeting_pattern_id,
         lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS section_num,
         CAST(floor(l_quantity) AS INTEGER) AS enrollment,
         'B' || CAST(l_suppkey AS VARCHAR) AS building_code FROM lineitem),
mp0 AS (
  SELECT o_orderkey AS meeting_pattern_id,
         CASE o_orderstatus WHEN 'F' THEN 'MWF' WHEN 'O' THEN 'TR' WHEN 'P' THEN 'MW' END AS day,
         CAST(480 + 30 * (o_orderkey % 20) AS INTEGER) AS s FROM orders),
meeting_patterns AS (
  SELECT meeting_pattern_id, day,
         CAST((s // 60) * 100 + s % 60 AS INTEGER) AS time_start,
         CAST(((s + 80) // 60) * 100 + (s + 80) % 60 AS INTEGER) AS time_end FROM mp0),
gps AS (
  SELECT 'B' || CAST(s_suppkey AS VARCHAR) AS building_code,
         CAST(-87.6 AS DOUBLE) + CAST(s_suppkey % 37 AS DOUBLE) * CAST(0.0005 AS DOUBLE) AS lon,
         CAST(41.79 AS DOUBLE) + CAST(s_nationkey AS DOUBLE) * CAST(0.0004 AS DOUBLE) AS lat
  FROM supplier)
"""

_WALK = ("CAST(ceil(2.0 * asin(sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) "
         "+ cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2)))"
         " * 6367000.0 / 66.0) AS INTEGER)")

_INDEXED = "c.course_id IN (SELECT course_id FROM catalog_index)"


def _all_terms(terms):
    t = sorted(set(terms))
    lits = ", ".join(f"'{x}'" for x in t)
    return (f"c.course_id IN (SELECT course_id FROM catalog_index WHERE word IN ({lits}) "
            f"GROUP BY course_id HAVING count(DISTINCT word) = {len(t)})")


ORACLE = {
    "search_tier1": _DERIVED + f"""
SELECT DISTINCT c.dept, c.course_num, c.title FROM courses c
WHERE {_INDEXED} AND {_all_terms(['small'])} AND c.dept = 'Brand#3'""",
    "search_terms_only": _DERIVED + f"""
SELECT DISTINCT c.dept, c.course_num, c.title FROM courses c
WHERE {_INDEXED} AND {_all_terms(['blue', 'bolt'])}""",
    "search_tier2": _DERIVED + f"""
SELECT DISTINCT c.dept, c.course_num, c.title, s.section_num, m.day, m.time_start, m.time_end, s.enrollment
FROM courses c JOIN sections s ON c.course_id = s.course_id
JOIN meeting_patterns m ON s.meeting_pattern_id = m.meeting_pattern_id
WHERE {_INDEXED} AND {_all_terms(['small'])} AND m.day IN ('MWF', 'TR')
  AND s.enrollment BETWEEN 10 AND 30 AND m.time_start >= 900 AND m.time_end <= 1400""",
    "search_tier2_only": _DERIVED + f"""
SELECT DISTINCT c.dept, c.course_num, c.title, s.section_num, m.day, m.time_start, m.time_end, s.enrollment
FROM courses c JOIN sections s ON c.course_id = s.course_id
JOIN meeting_patterns m ON s.meeting_pattern_id = m.meeting_pattern_id
WHERE {_INDEXED} AND m.day IN ('TR') AND m.time_start >= 1000 AND m.time_end <= 1200
  AND s.enrollment BETWEEN 40 AND 50""",
    "search_tier3": _DERIVED + f"""
SELECT DISTINCT * FROM (
  SELECT c.dept, c.course_num, c.title, s.section_num, m.day, m.time_start, m.time_end, s.enrollment,
         a.building_code, {_WALK} AS walking_time
  FROM courses c JOIN sections s ON c.course_id = s.course_id
  JOIN meeting_patterns m ON s.meeting_pattern_id = m.meeting_pattern_id
  JOIN gps a ON a.building_code = s.building_code
  CROSS JOIN (SELECT lon, lat FROM gps WHERE building_code = 'B7') b
  WHERE {_INDEXED} AND c.dept = 'Brand#7' AND m.day IN ('MW', 'MWF'))
WHERE walking_time <= 10""",
    "walk_time_from_anchor": _DERIVED + f"""
SELECT * FROM (SELECT a.building_code, {_WALK} AS walking_time
  FROM gps a CROSS JOIN (SELECT lon, lat FROM gps WHERE building_code = 'B3') b)
WHERE walking_time <= 12""",
    "distinct_values": """
SELECT DISTINCT o_orderpriority FROM orders
WHERE o_orderpriority IS NOT NULL AND o_orderpriority <> '5-LOW'""",
    "point_lookup": """
SELECT p_partkey, p_name, p_brand, p_retailprice FROM part WHERE p_partkey = 42""",
    "topn_sorted": """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "request_rules": """
WITH r AS (
  SELECT o_orderkey AS request_id,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST((o_orderkey * 7) % 2500 AS INTEGER) END AS ts,
         CAST((o_orderkey * 13) % 2500 AS INTEGER) AS te,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 1100 AS INTEGER) END AS lo,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST((o_orderkey * 3) % 1100 AS INTEGER) END AS hi,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'B' || CAST(o_orderkey % 50 AS VARCHAR) END AS b,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST((o_orderkey % 30) - 5 AS INTEGER) END AS w
  FROM orders),
p AS (
  SELECT request_id, list_filter([
    CASE WHEN ts IS NOT NULL AND NOT (ts >= 0 AND ts < 2400 AND ts % 100 < 60) THEN 'time_start is not a valid hhmm time' END,
    CASE WHEN te IS NOT NULL AND NOT (te >= 0 AND te < 2400 AND te % 100 < 60) THEN 'time_end is not a valid hhmm time' END,
    CASE WHEN (ts IS NULL AND te IS NOT NULL) OR (ts IS NOT NULL AND te IS NULL) THEN 'a time range needs both bounds' END,
    CASE WHEN ts IS NOT NULL AND te IS NOT NULL AND te < ts THEN 'time_start exceeds time_end' END,
    CASE WHEN (lo IS NULL) <> (hi IS NULL) THEN 'enrollment needs both bounds' END,
    CASE WHEN (lo IS NOT NULL AND NOT (lo BETWEEN 1 AND 1000)) OR (hi IS NOT NULL AND NOT (hi BETWEEN 1 AND 1000)) THEN 'enrollment bounds must be in 1..1000' END,
    CASE WHEN lo IS NOT NULL AND hi IS NOT NULL AND hi < lo THEN 'enrollment lower bound exceeds upper' END,
    CASE WHEN (b IS NULL) <> (w IS NULL) THEN 'building and walking time go together' END,
    CASE WHEN w IS NOT NULL AND w < 0 THEN 'walking time must be non-negative' END
  ], lambda x: x IS NOT NULL) AS problems FROM r)
SELECT request_id, CAST(len(problems) AS INTEGER) AS n_problems, array_to_string(problems, '; ') AS problems FROM p""",
}
