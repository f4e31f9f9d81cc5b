"""Search against the reference's golden results.

The golden database is not shipped, but the union of the expected rows of a
group of tests is closed under those tests' criteria: filtering it by each
test's request must give exactly that test's rows. Tests 2-16 use the
8-column rows; tests 17-19 the 10-column rows, with building coordinates
placed so that the walking minutes from RY are the ones in the goldens."""

import math

import pytest

from lodestar.functions.geo import EARTH_RADIUS_KM, WALK_SPEED_M_PER_S
from lodestar.operators import diff as D
from lodestar.operators import search as S
from goldens import search_goldens


@pytest.fixture(scope="module")
def goldens():
    return search_goldens()


def build_tables(spark, rows, minutes=None):
    courses, patterns, sections, gps = {}, {}, set(), {}
    for r in rows:
        ckey, pkey = tuple(r[0:3]), tuple(r[4:7])
        courses.setdefault(ckey, len(courses) + 1)
        patterns.setdefault(pkey, len(patterns) + 1)
        building = r[8] if len(r) > 8 else "X"
        sections.add((courses[ckey], patterns[pkey], r[3], r[7], building))
    lat0, lon0 = 41.79, -87.6
    for b, m in (minutes or {"X": 0}).items():
        dist = 0.0 if m == 0 else (m - 0.5) * WALK_SPEED_M_PER_S * 60.0
        gps[b] = (lon0, lat0 + math.degrees(dist / (EARTH_RADIUS_KM * 1000.0)))
    return S.CourseTables(
        spark.createDataFrame([(i, *k) for k, i in courses.items()],
                              "course_id int, dept string, course_num string, title string"),
        spark.createDataFrame(sorted(sections),
                              "course_id int, meeting_pattern_id int, section_num string, enrollment int, building_code string"),
        spark.createDataFrame([(i, *k) for k, i in patterns.items()],
                              "meeting_pattern_id int, day string, time_start int, time_end int"),
        spark.createDataFrame([(b, lon, lat) for b, (lon, lat) in gps.items()],
                              "building_code string, lon double, lat double"),
        spark.createDataFrame([(i, "w") for i in courses.values()], "course_id int, word string"))


def check(tables, test):
    header, rows = test["expected"]
    out = S.find_courses(tables, test["input"])
    assert D.header_problems(out, header) == []
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted(tuple(r) for r in rows), test["test_num"]


def test_empty_and_no_match(spark, goldens):
    out = S.find_courses(build_tables(spark, []), goldens[0]["input"])
    header, rows = goldens[0]["expected"]
    assert out.columns == header == [] and out.count() == len(rows) == 0
    rows = [r for n in range(2, 17) for r in goldens[n]["expected"][1]]
    check(build_tables(spark, rows), goldens[21])


def test_tier2_goldens(spark, goldens):
    rows = [r for n in range(2, 17) for r in goldens[n]["expected"][1]]
    tables = build_tables(spark, rows)
    for n in range(2, 17):
        check(tables, goldens[n])


def test_tier3_goldens(spark, goldens):
    rows = [r for n in range(17, 20) for r in goldens[n]["expected"][1]]
    minutes = {}
    for r in rows:
        assert minutes.setdefault(r[8], r[9]) == r[9]
    tables = build_tables(spark, rows, minutes)
    for n in range(17, 20):
        check(tables, goldens[n])
