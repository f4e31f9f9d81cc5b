"""Multi-criteria search over a star schema (job C).

Roles: ``courses(course_id, dept, course_num, title)``,
``sections(course_id, meeting_pattern_id, section_num, enrollment,
building_code)``, ``meeting_patterns(meeting_pattern_id, day, time_start,
time_end)``, ``gps(building_code, lon, lat)``, ``catalog_index(course_id,
word)``.

A request is a dict of optional criteria. It becomes a list of Column
predicates and a choice of joins; no SQL text is assembled. Catalyst pushes
each predicate to the scan of the table it touches before the joins, and
the all-terms test runs as a semi join against a grouped index, so a course
with many index words never multiplies result rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.geo import walking_minutes
from lodestar.functions.text import split_ws

# Criteria keys, grouped by the join tier they need, and the
# output columns of each tier.
TIER1_KEYS = ("terms", "dept")
TIER2_KEYS = ("day", "enrollment", "time_start", "time_end")
TIER3_KEYS = ("building_code", "walking_time")
ALL_KEYS = TIER1_KEYS + TIER2_KEYS + TIER3_KEYS
TIER1_COLS = ("dept", "course_num", "title")
TIER2_COLS = TIER1_COLS + ("section_num", "day", "time_start", "time_end", "enrollment")
TIER3_COLS = TIER2_COLS + ("building_code", "walking_time")

# Display labels of the result columns (F8).
DISPLAY_NAMES = {
    "dept": "Department", "course_num": "Course", "title": "Title",
    "section_num": "Section", "day": "Day", "time_start": "Time (start)",
    "time_end": "Time (end)", "enrollment": "Enrollment",
    "building_code": "Building", "walking_time": "Walking Time",
}


@dataclass(frozen=True)
class CourseTables:
    courses: DataFrame
    sections: DataFrame
    meeting_patterns: DataFrame
    gps: DataFrame
    catalog_index: DataFrame


# --- F11: request validation ------------------------------------------------

def request_problems(criteria: dict) -> list[str]:
    """Reasons a request is invalid (empty list when valid)."""
    out = []
    unknown = set(criteria) - set(ALL_KEYS)
    if unknown:
        out.append(f"unknown keys: {sorted(unknown)}")
    has_b, has_w = "building_code" in criteria, "walking_time" in criteria
    if has_b != has_w:
        out.append("building_code and walking_time must be given together")
    if has_b and not isinstance(criteria["building_code"], str):
        out.append("building_code must be a string")
    if has_w and not isinstance(criteria["walking_time"], int):
        out.append("walking_time must be an int")
    if "day" in criteria and not (isinstance(criteria["day"], (list, tuple))
                                  and all(isinstance(d, str) for d in criteria["day"])):
        out.append("day must be a list of strings")
    if "dept" in criteria and not isinstance(criteria["dept"], str):
        out.append("dept must be a string")
    if "terms" in criteria:
        t = criteria["terms"]
        if not (isinstance(t, (list, tuple)) and t and all(isinstance(s, str) for s in t)):
            out.append("terms must be a non-empty list of strings")
    if "time_start" in criteria and not (isinstance(criteria["time_start"], int) and criteria["time_start"] >= 0):
        out.append("time_start must be an int >= 0")
    if "time_end" in criteria and not (isinstance(criteria["time_end"], int) and criteria["time_end"] < 2400):
        out.append("time_end must be an int < 2400")
    if "enrollment" in criteria:
        e = criteria["enrollment"]
        if not (isinstance(e, (list, tuple)) and len(e) == 2 and all(isinstance(i, int) for i in e)
                and e[0] <= e[1]):
            out.append("enrollment must be a pair of ints (lo <= hi)")
    return out


def validate_request(criteria: dict) -> None:
    problems = request_problems(criteria) if isinstance(criteria, dict) else ["request must be a dict"]
    if problems:
        raise ValueError("; ".join(problems))


def request_rule_violations(requests: DataFrame) -> DataFrame:
    """F11 + F12 over a table of requests, one row per request.

    Expected nullable columns: time_start, time_end, enroll_lo, enroll_hi,
    building_code, walking_time. Adds ``problems array<string>`` (empty when
    valid): each rule is a ``when`` that yields its reason or null."""
    ts, te = F.col("time_start"), F.col("time_end")
    lo, hi = F.col("enroll_lo"), F.col("enroll_hi")
    b, w = F.col("building_code"), F.col("walking_time")

    def hhmm_ok(t):
        return (t >= 0) & (t < 2400) & (t % 100 < 60)

    rules = [
        F.when(ts.isNotNull() & ~hhmm_ok(ts), F.lit("time_start is not a valid hhmm time")),
        F.when(te.isNotNull() & ~hhmm_ok(te), F.lit("time_end is not a valid hhmm time")),
        F.when(ts.isNull() != te.isNull(), F.lit("a time range needs both bounds")),
        F.when(ts.isNotNull() & te.isNotNull() & (te < ts), F.lit("time_start exceeds time_end")),
        F.when(lo.isNull() != hi.isNull(), F.lit("enrollment needs both bounds")),
        F.when((lo.isNotNull() & ~lo.between(1, 1000)) | (hi.isNotNull() & ~hi.between(1, 1000)),
               F.lit("enrollment bounds must be in 1..1000")),
        F.when(lo.isNotNull() & hi.isNotNull() & (hi < lo), F.lit("enrollment lower bound exceeds upper")),
        F.when(b.isNull() != w.isNull(), F.lit("building and walking time go together")),
        F.when(w.isNotNull() & (w < 0), F.lit("walking time must be non-negative")),
    ]
    return requests.withColumn("problems", F.array_compact(F.array(*rules)))


# --- G1 / G2: term matching --------------------------------------------------

def all_terms_ids(index: DataFrame, terms, key: str = "course_id") -> DataFrame:
    """G1: keys whose index words include every given term.

    ``count(DISTINCT word) = number of distinct terms`` is exact even when
    the request repeats a term or the index repeats a (key, word) row. The
    aggregation is keyed on ``key`` (map-side partial counts), not on word,
    so a very common word does not funnel into one task."""
    distinct_terms = sorted(set(terms))
    return (index.where(F.col("word").isin(distinct_terms))
            .groupBy(key).agg(F.countDistinct("word").alias("n_terms"))
            .where(F.col("n_terms") == len(distinct_terms))
            .select(key))


def any_term_ids(index: DataFrame, terms, key: str = "course_id") -> DataFrame:
    """Keys with at least one of the terms (duplicates left to the semi join)."""
    return index.where(F.col("word").isin(sorted(set(terms)))).select(key)


def split_query(text: str) -> list[str]:
    """T13 for a driver-side search box string."""
    return text.split()


def split_query_col(text: Column) -> Column:
    """T13 as a Column, for a table of query strings."""
    return split_ws(text)


# --- search ---------------------------------------------------------------------

def request_tier(criteria: dict) -> int:
    if any(k in criteria for k in TIER3_KEYS):
        return 3
    if any(k in criteria for k in TIER2_KEYS):
        return 2
    return 1


def empty_result(spark: SparkSession) -> DataFrame:
    """an empty request yields no columns and no rows."""
    return spark.createDataFrame([], T.StructType([]))


def anchor_point(gps: DataFrame, building_code: str) -> tuple[Column, Column]:
    """J4 without a cross join: the anchor building's coordinates from one
    scalar subquery (one row by construction: a global aggregate). Of several
    rows of the building the one with the smallest (lon, lat) counts, whole."""
    one = gps.where((F.col("building_code") == F.lit(building_code)) & F.col("lon").isNotNull() & F.col("lat").isNotNull())
    point = one.select(F.min(F.struct("lon", "lat"))).scalar()
    return point.getField("lon"), point.getField("lat")


def find_courses(tables: CourseTables, criteria: dict, require_indexed: bool = True) -> DataFrame:
    """The rows matching every given criterion.

    Tier 1 (terms, dept only): dept, course_num, title.
    Tier 2 (any of day, enrollment, time bounds): + section_num, day,
    time_start, time_end, enrollment.
    Tier 3 (building_code + walking_time): + building_code, walking_time.

    ``require_indexed`` keeps only courses that have at least one index word,
    which is what the original always-joined index did (semi join here, so no
    duplicate rows to remove)."""
    validate_request(criteria)
    spark = tables.courses.sparkSession
    if not criteria:
        return empty_result(spark)
    tier = request_tier(criteria)

    courses = tables.courses.select("course_id", "dept", "course_num", "title")
    if "dept" in criteria:
        courses = courses.where(F.col("dept") == F.lit(criteria["dept"]))
    if require_indexed and "terms" not in criteria:
        # (with terms, the all-terms semi join below already implies presence in the index)
        courses = courses.join(tables.catalog_index.select("course_id"), "course_id", "left_semi")
    if "terms" in criteria:
        courses = courses.join(all_terms_ids(tables.catalog_index, criteria["terms"]),
                               "course_id", "left_semi")
    if tier == 1:
        return courses.select(*TIER1_COLS).distinct()

    sec_preds: list[Column] = []
    if "enrollment" in criteria:
        lo, hi = criteria["enrollment"]
        sec_preds.append(F.col("enrollment").between(lo, hi))
    mp_preds: list[Column] = []
    if "day" in criteria:
        mp_preds.append(F.col("day").isin(list(criteria["day"])))
    if "time_start" in criteria:
        mp_preds.append(F.col("time_start") >= F.lit(criteria["time_start"]))
    if "time_end" in criteria:
        mp_preds.append(F.col("time_end") <= F.lit(criteria["time_end"]))

    sections = tables.sections.select("course_id", "meeting_pattern_id", "section_num",
                                      "enrollment", "building_code")
    if sec_preds:
        sections = sections.where(reduce(lambda x, y: x & y, sec_preds))
    patterns = tables.meeting_patterns.select("meeting_pattern_id", "day", "time_start", "time_end")
    if mp_preds:
        patterns = patterns.where(reduce(lambda x, y: x & y, mp_preds))

    # the selective sides first (courses, then buildings in reach), the
    # section-pattern join of the two large tables last
    rows = sections.join(courses, "course_id")
    if tier == 2:
        return rows.join(patterns, "meeting_pattern_id").select(*TIER2_COLS).distinct()

    lon0, lat0 = anchor_point(tables.gps, criteria["building_code"])
    near = (tables.gps.select("building_code", "lon", "lat")
            .withColumn("walking_time", walking_minutes(F.col("lon"), F.col("lat"), lon0, lat0))
            .where(F.col("walking_time") <= F.lit(criteria["walking_time"])).drop("lon", "lat"))
    rows = rows.join(near, "building_code").join(patterns, "meeting_pattern_id")
    return rows.select(*TIER3_COLS).distinct()


def with_display_names(result: DataFrame) -> DataFrame:
    """F8: rename result columns to their display labels."""
    return result.withColumnsRenamed({c: DISPLAY_NAMES[c] for c in result.columns if c in DISPLAY_NAMES})


def result_count(result: DataFrame) -> int:
    """G5."""
    return result.count()


# --- G4 / F15 / J13 / W7 / W8 ----------------------------------------------------

def distinct_values(df: DataFrame, column: str, exclude=None) -> DataFrame:
    """Distinct values of one column; ``exclude`` drops a sentinel."""
    out = df.select(column).where(F.col(column).isNotNull())
    if exclude is not None:
        out = out.where(F.col(column) != F.lit(exclude))
    return out.distinct()


def point_lookup(df: DataFrame, key: str, value, columns) -> DataFrame:
    """The rows of one key (a pushed-down equality on the scan)."""
    return df.where(F.col(key) == F.lit(value)).select(*columns)


def top_sorted(df: DataFrame, order_cols, n: int) -> DataFrame:
    """W7 + W8: ORDER BY then LIMIT n; Spark plans a per-partition top-n and
    a merge of n rows per partition, never a full sort."""
    return df.orderBy(*order_cols).limit(n)
