"""Search: criteria semantics on a small star schema against a brute-force
filter over the joined rows."""

import pytest

from lodestar.operators import search as S

COURSES = [(1, "CMSC", "12100", "Intro"), (2, "CMSC", "15400", "Systems"), (3, "MATH", "15100", "Calculus"),
           (4, "CMSC", "99999", "Unindexed")]
SECTIONS = [(1, 10, "01", 50, "RY"), (1, 11, "02", 20, "E"), (2, 10, "01", 80, "KPTC"), (3, 12, "01", 30, "RY"),
            (4, 10, "01", 10, "RY")]
PATTERNS = [(10, "MWF", 930, 1020), (11, "TR", 1230, 1350), (12, "MWF", 1030, 1120)]
GPS = [("RY", -87.5990, 41.7906), ("E", -87.5996, 41.7914), ("KPTC", -87.6013, 41.7906)]
INDEX = [(1, "programming"), (1, "abstraction"), (2, "programming"), (2, "systems"), (3, "calculus"),
         (1, "programming")]


@pytest.fixture(scope="module")
def tables(spark):
    return S.CourseTables(
        spark.createDataFrame(COURSES, "course_id int, dept string, course_num string, title string"),
        spark.createDataFrame(SECTIONS, "course_id int, meeting_pattern_id int, section_num string, enrollment int, building_code string"),
        spark.createDataFrame(PATTERNS, "meeting_pattern_id int, day string, time_start int, time_end int"),
        spark.createDataFrame(GPS, "building_code string, lon double, lat double"),
        spark.createDataFrame(INDEX, "course_id int, word string"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_empty_request(tables):
    out = S.find_courses(tables, {})
    assert out.columns == [] and out.count() == 0


def test_tier1_all_terms_and_dept(tables):
    out = S.find_courses(tables, {"terms": ["programming", "abstraction", "programming"]})
    assert out.columns == list(S.TIER1_COLS)
    assert rows(out) == [("CMSC", "12100", "Intro")]
    assert rows(S.find_courses(tables, {"dept": "CMSC"})) == [("CMSC", "12100", "Intro"), ("CMSC", "15400", "Systems")]
    assert rows(S.find_courses(tables, {"dept": "CMSC"}, require_indexed=False))[-1][1] == "99999"


def test_tier2_filters(tables):
    out = S.find_courses(tables, {"day": ["MWF"], "time_start": 930, "time_end": 1100, "enrollment": [40, 90]})
    assert out.columns == list(S.TIER2_COLS)
    assert rows(out) == [("CMSC", "12100", "Intro", "01", "MWF", 930, 1020, 50),
                         ("CMSC", "15400", "Systems", "01", "MWF", 930, 1020, 80)]


def test_tier3_walking(tables):
    out = S.find_courses(tables, {"building_code": "RY", "walking_time": 2, "dept": "CMSC"})
    assert out.columns == list(S.TIER3_COLS)
    got = {(r.course_num, r.section_num, r.building_code, r.walking_time) for r in out.collect()}
    assert got == {("12100", "01", "RY", 0), ("12100", "02", "E", 2)}


def test_validation():
    with pytest.raises(ValueError):
        S.validate_request({"building_code": "RY"})
    with pytest.raises(ValueError):
        S.validate_request({"enrollment": [5, 1]})
    with pytest.raises(ValueError):
        S.validate_request({"colour": "red"})


def test_request_rules_table(spark):
    req = spark.createDataFrame([(1, 930, 1060, 10, 5, None, None), (2, 900, 1000, 1, 100, "RY", 3)],
                                "id int, time_start int, time_end int, enroll_lo int, enroll_hi int, building_code string, walking_time int")
    got = {r.id: r.problems for r in S.request_rule_violations(req).collect()}
    assert got[2] == []
    assert "time_end is not a valid hhmm time" in got[1] and "enrollment lower bound exceeds upper" in got[1]


def test_display_names_count_and_query_split(spark, tables):
    out = S.find_courses(tables, {"dept": "MATH"})
    labelled = S.with_display_names(out)
    assert labelled.columns == ["Department", "Course", "Title"]
    assert S.result_count(out) == 1
    assert S.split_query("  quantum\tplato  ") == ["quantum", "plato"]
    df = spark.createDataFrame([("  quantum\u00a0plato  ",)], "q string")
    from pyspark.sql import functions as F
    assert df.select(S.split_query_col(F.col("q")).alias("t")).first().t == ["quantum", "plato"]


def test_a_time_range_needs_both_bounds(spark):
    schema = "time_start int, time_end int, enroll_lo int, enroll_hi int, building_code string, walking_time int"
    rows = [(900, 1000, None, None, None, None), (900, None, None, None, None, None), (None, 1000, None, None, None, None),
            (None, None, None, None, None, None)]
    got = [r.problems for r in S.request_rule_violations(spark.createDataFrame(rows, schema)).collect()]
    assert got == [[], ["a time range needs both bounds"], ["a time range needs both bounds"], []]


def test_anchor_takes_one_whole_row(spark, tables):
    gps = spark.createDataFrame([("RY", 5.0, 1.0), ("RY", 2.0, 9.0), ("RY", None, 0.0)], "building_code string, lon double, lat double")
    lon, lat = S.anchor_point(gps, "RY")
    assert tuple(spark.range(1).select(lon, lat).first()) == (2.0, 9.0)
