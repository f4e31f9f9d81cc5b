"""File sources and sinks round trips."""

import json
import os
import tempfile

import pytest

from lodestar.sources import sinks
from lodestar.sources.tables import (code_map_from_dict, invert_code_map, read_code_map, read_code_map_split,
                                     read_records_csv, read_single_column, read_string_table,
                                     target_column)


def _scratch():
    return tempfile.mkdtemp(prefix="lodestar-io-")


def _lines(folder):
    out = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            with open(os.path.join(folder, name)) as fh:
                out += [line.rstrip("\n") for line in fh if line.strip()]
    return sorted(out)


def test_code_map_json_and_inversion(spark):
    d = _scratch()
    path = os.path.join(d, "map.json")
    with open(path, "w") as fh:
        json.dump({"CMSC 12100": 1, "CMSC 12200": 2, "MATH 15100": 7}, fh)
    cmap = read_code_map(spark, path)
    assert sorted(tuple(r) for r in cmap.collect()) == [("CMSC 12100", 1), ("CMSC 12200", 2), ("MATH 15100", 7)]
    inv = invert_code_map(cmap)
    assert inv.columns == ["id", "code"]
    assert sorted(tuple(r) for r in inv.collect()) == sorted(
        tuple(r) for r in invert_code_map(code_map_from_dict(spark, {"CMSC 12100": 1, "CMSC 12200": 2,
                                                                      "MATH 15100": 7})).collect())


def test_csv_sources(spark):
    d = _scratch()
    rec = os.path.join(d, "rec.csv")
    with open(rec, "w") as fh:
        fh.write("index,restaurant name,city,street address\n0,Apple Pan  The,West LA,10801 W. Pico Blvd.\n")
    r = read_records_csv(spark, rec).first()
    assert (r["index"], r.name, r.city, r.address) == (0, "Apple Pan  The", "West LA", "10801 W. Pico Blvd.")
    tab = os.path.join(d, "t.csv")
    with open(tab, "w") as fh:
        fh.write("A,B,Target\n1,x,yes\n02,y,no\n")
    t = read_string_table(spark, tab)
    assert target_column(t) == "Target"
    assert [tuple(x)[:3] for x in t.orderBy("row_id").collect()] == [("1", "x", "yes"), ("02", "y", "no")]
    one = os.path.join(d, "list.csv")
    with open(one, "w") as fh:
        fh.write("MWF,extra\nTR,extra\n")
    assert [x.value for x in read_single_column(spark, one).collect()] == ["MWF", "TR"]


def test_sinks(spark):
    d = _scratch()
    idx = spark.createDataFrame([(1, "data"), (2, "loops,")], "id int, word string")
    sinks.write_index(idx, os.path.join(d, "index"))
    assert _lines(os.path.join(d, "index")) == ["1|data", "2|loops,"]
    pairs = spark.createDataFrame([(0, 5, "match"), (1, 2, "possible match")], "zindex int, findex int, label string")
    sinks.write_pair_labels(pairs, os.path.join(d, "pairs"))
    assert _lines(os.path.join(d, "pairs")) == ["0,5,match", "1,2,possible match"]
    days = spark.createDataFrame([("MWF",), ("TR",), ("MWF",)], "day string")
    sinks.write_distinct_list(days, "day", os.path.join(d, "days"))
    assert _lines(os.path.join(d, "days")) == ["MWF", "TR"]


def test_code_map_lines(spark):
    from lodestar.sources.tables import read_code_map_lines
    d = _scratch()
    path = os.path.join(d, "map.jsonl")
    with open(path, "w") as fh:
        fh.write('{"code": "A", "id": 1}\n{"code": "B", "id": 2}\n')
    assert sorted(tuple(r) for r in read_code_map_lines(spark, path).collect()) == [("A", 1), ("B", 2)]


@pytest.mark.parametrize("split", [5, 16, 64, 1 << 20])
def test_code_object_read_by_many_tasks(spark, split):
    """The same rows as one task reads, wherever the file is cut."""
    d = _scratch()
    codes = {"": 0, ",": 1, "a,b,,c": 2, '"': 3, '",': 4, ',"': 5, "\\": 6, '\\",\\\\,"': 7, "{x": 8, "x}": 9, "{": 10, "}": 11, "é,ü": 12,
             "line\nbreak,": 13, "x" * 70 + "," * 70: 14, "CMSC 12100": 15, ":1,": 16}
    for name, text in (("a", json.dumps(codes)), ("b", json.dumps({"1" + k: v for k, v in codes.items()}, indent=2, ensure_ascii=False)),
                       ("c", "{}"), ("d", ""), ("e", ' { "one" : 1 } \n')):
        with open(os.path.join(d, name + ".json"), "w") as fh:
            fh.write(text)
    want = sorted([*codes.items(), *(("1" + k, v) for k, v in codes.items()), ("one", 1)])
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        got = read_code_map_split(spark, d)
        assert sorted(tuple(r) for r in got.collect()) == want
        if split < 100:
            assert spark.read.option("lineSep", ",").text(d + "/a.json").rdd.getNumPartitions() > 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(tuple(r) for r in read_code_map(spark, d).collect()) == want
