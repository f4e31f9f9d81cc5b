"""Locate golden inputs shipped with the reference by their content
(headers, JSON keys), so tests need no file names. Every finder skips the
test when nothing matching is found."""

import csv
import json
import os
from functools import lru_cache

import pytest

from conftest import REFDATA


@lru_cache(maxsize=None)
def _all_files():
    out = []
    for root, _, files in os.walk(REFDATA):
        out += [os.path.join(root, f) for f in sorted(files)]
    return tuple(sorted(out))


def _first_line(path):
    try:
        with open(path, encoding="utf-8", errors="replace") as fh:
            return fh.readline().strip()
    except OSError:
        return ""


def _json(path):
    try:
        with open(path) as fh:
            return json.load(fh)
    except (OSError, ValueError):
        return None


def _rows(path):
    with open(path, newline="") as fh:
        return sum(1 for _ in csv.reader(fh)) - 1


def _need(found, what):
    if not found:
        pytest.skip(f"no reference data found for {what}")
    return found


def tree_configs():
    """(config name, training path, testing path, expected labels) of every
    JSON test configuration with training/testing file names and results."""
    out = []
    for path in _all_files():
        if path.endswith(".json"):
            cfg = _json(path)
            if isinstance(cfg, dict) and {"training_filename", "testing_filename", "results"} <= set(cfg):
                base = os.path.dirname(os.path.dirname(path))
                out.append((os.path.splitext(os.path.basename(path))[0],
                            os.path.join(base, cfg["training_filename"]),
                            os.path.join(base, cfg["testing_filename"]), cfg["results"]))
    return out


def tree_config(name):
    found = [c for c in tree_configs() if c[0] == name]
    return _need(found, f"tree configuration {name}")[0]


def search_goldens():
    """{test_num: test} from the JSON list of search test cases."""
    for path in _all_files():
        if path.endswith(".json"):
            data = _json(path)
            if isinstance(data, list) and data and isinstance(data[0], dict) and "test_num" in data[0]:
                return {t["test_num"]: t for t in data}
    return _need(None, "search goldens")


def csv_files_with_header(predicate):
    return [p for p in _all_files() if p.endswith(".csv") and predicate(_first_line(p))]


def restaurant_files():
    """(left list, right list, known pairs, unmatched pairs): the record lists
    share a header (the smaller list is the left one); the pair files have
    'zindex,findex' (the known matches are the shorter file)."""
    lists = sorted(csv_files_with_header(lambda h: h.startswith("index,") and "city" in h), key=_rows)
    pairs = sorted(csv_files_with_header(lambda h: h == "zindex,findex"), key=_rows)
    _need(len(lists) == 2 and len(pairs) == 2, "restaurant lists and labelled pairs")
    return lists[0], lists[1], pairs[0], pairs[1]


def diabetes_files():
    """(raw table, [binned tables]): the raw table has the skin-fold column,
    the binned training/testing tables have the same features without it."""
    raw = csv_files_with_header(lambda h: "Plasma glucose level" in h and "Triceps" in h)
    binned = csv_files_with_header(lambda h: "Plasma glucose level" in h and "Triceps" not in h)
    _need(raw and binned, "diabetes tables")
    return raw[0], binned
