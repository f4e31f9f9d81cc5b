"""Parameterised Spark SQL over the bound course views (F9, W7, W8, U1):
the warm-up questions of the search job, written as SQL text with named
parameter markers bound through ``spark.sql(text, args=...)`` (no string
interpolation of values).

Corrections of the original text (see README): the section join uses
``c.course_id = s.course_id``; the day filter is applied where the question
asks for it; the two-word question is offered as any-term and all-term."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.functions.geo import register_sql_functions
from lodestar.plans.search_plans import _DERIVED, _WALK, course_tables


def _views(spark: SparkSession, sf_dir: str) -> None:
    t = course_tables(spark, sf_dir)
    t.courses.createOrReplaceTempView("courses")
    t.sections.createOrReplaceTempView("sections")
    t.meeting_patterns.createOrReplaceTempView("meeting_patterns")
    t.gps.createOrReplaceTempView("gps")
    t.catalog_index.createOrReplaceTempView("catalog_index")


_JOIN = """FROM courses AS c JOIN sections AS s ON c.course_id = s.course_id
JOIN meeting_patterns AS m ON s.meeting_pattern_id = m.meeting_pattern_id"""

SQL = {
    "warmup_dept_titles": ("SELECT dept, course_num, title FROM courses WHERE dept = :dept",
                           {"dept": "Brand#5"}),
    "warmup_day_time_top10": (f"""SELECT c.dept, c.course_num, s.section_num {_JOIN}
WHERE m.day = :day AND m.time_start = :t
ORDER BY s.building_code, c.dept, c.course_num, s.section_num, s.meeting_pattern_id LIMIT 10""",
                              {"day": "MWF", "t": 1030}),
    "warmup_building_window": (f"""SELECT DISTINCT c.dept, c.course_num {_JOIN}
WHERE s.building_code = :b AND m.day = :day AND m.time_start BETWEEN :t0 AND :t1""",
                               {"b": "B7", "day": "MWF", "t0": 1030, "t1": 1500}),
    "warmup_terms_any": (f"""SELECT DISTINCT c.dept, c.course_num, c.title {_JOIN}
WHERE m.day = :day AND m.time_start = :t
  AND c.course_id IN (SELECT course_id FROM catalog_index WHERE word IN (:w1, :w2))""",
                         {"day": "MWF", "t": 930, "w1": "small", "w2": "bolt"}),
    "warmup_terms_all": (f"""SELECT DISTINCT c.dept, c.course_num, c.title {_JOIN}
WHERE m.day = :day AND m.time_start = :t
  AND c.course_id IN (SELECT course_id FROM catalog_index WHERE word IN (:w1, :w2)
                      GROUP BY course_id HAVING count(DISTINCT word) = 2)""",
                         {"day": "MWF", "t": 930, "w1": "small", "w2": "ring"}),
    "walk_time_sql": ("""SELECT a.building_code,
  time_between(a.lon, a.lat, (SELECT lon FROM gps WHERE building_code = :b),
               (SELECT lat FROM gps WHERE building_code = :b)) AS walking_time
FROM gps AS a
WHERE EXISTS (SELECT 1 FROM gps WHERE building_code = :b)""", {"b": "B5"}),
}


def _run(name):
    text, args = SQL[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _views(spark, sf_dir)
        register_sql_functions(spark)
        return spark.sql(text, args=args)
    return run


QUERIES = {name: _run(name) for name in SQL}

ORACLE = {
    "warmup_dept_titles": _DERIVED + "SELECT dept, course_num, title FROM courses WHERE dept = 'Brand#5'",
    "warmup_day_time_top10": _DERIVED + f"""SELECT c.dept, c.course_num, s.section_num {_JOIN}
WHERE m.day = 'MWF' AND m.time_start = 1030
ORDER BY s.building_code, c.dept, c.course_num, s.section_num, s.meeting_pattern_id LIMIT 10""",
    "warmup_building_window": _DERIVED + f"""SELECT DISTINCT c.dept, c.course_num {_JOIN}
WHERE s.building_code = 'B7' AND m.day = 'MWF' AND m.time_start BETWEEN 1030 AND 1500""",
    "warmup_terms_any": _DERIVED + f"""SELECT DISTINCT c.dept, c.course_num, c.title {_JOIN}
WHERE m.day = 'MWF' AND m.time_start = 930
  AND c.course_id IN (SELECT course_id FROM catalog_index WHERE word IN ('small', 'bolt'))""",
    "warmup_terms_all": _DERIVED + f"""SELECT DISTINCT c.dept, c.course_num, c.title {_JOIN}
WHERE m.day = 'MWF' AND m.time_start = 930
  AND c.course_id IN (SELECT course_id FROM catalog_index WHERE word IN ('small', 'ring')
                      GROUP BY course_id HAVING count(DISTINCT word) = 2)""",
    "walk_time_sql": _DERIVED + f"""SELECT a.building_code, {_WALK} AS walking_time
FROM gps a CROSS JOIN (SELECT lon, lat FROM gps WHERE building_code = 'B5') b""",
}
