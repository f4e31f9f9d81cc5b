"""The registered tree scoring against a plain-Python tree on the smallest
scale factor."""

import math
from collections import Counter

import duckdb

import __spark_entry__ as E


def _rows(sql):
    con = duckdb.connect()
    return con.execute(sql).fetchall()


# ---- decision tree ---------------------------------------------------------

def _gini(counts):
    n = sum(counts.values())
    return 1.0 - sum((c / n) ** 2 for c in counts.values())


def _label(counts):
    return min(counts, key=lambda t: (-counts[t], t))


def _grow(rows, attrs):
    counts = Counter(r["target"] for r in rows)
    node = {"label": _label(counts), "split": None, "kids": {}}
    if len(counts) == 1 or not attrs:
        return node
    n, best = len(rows), None
    for a in sorted(attrs):
        groups = {}
        for r in rows:
            if r[a] is not None:
                groups.setdefault(r[a], []).append(r)
        m = sum(len(g) for g in groups.values())
        parent = _gini(Counter(r["target"] for g in groups.values() for r in g))
        weighted = sum(len(g) / m * _gini(Counter(r["target"] for r in g)) for g in groups.values())
        info = -sum(len(g) / m * math.log2(len(g) / m) for g in groups.values())
        ratio = round((parent - weighted) / info, 12) if info != 0 else 0.0
        if len(groups) > 1 and (best is None or ratio > best[0]):
            best = (ratio, a, groups)
    if best is None or best[0] == 0:
        return node
    _, a, groups = best
    node["split"] = a
    node["kids"] = {v: _grow(g, [x for x in attrs if x != a]) for v, g in groups.items()}
    return node


def _predict(node, row):
    while node["split"] is not None and row[node["split"]] in node["kids"]:
        node = node["kids"][row[node["split"]]]
    return node["label"]


def test_tree_predict_query_matches_brute_force(spark, sf_small):
    feats = f"""SELECT doc_id, lang, source,
        CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 2000 THEN 'medium' ELSE 'long' END AS len_bin
        FROM read_parquet('{sf_small}/documents.parquet')"""
    docs = [dict(zip(("doc_id", "lang", "source", "len_bin"), r)) for r in _rows(feats)]
    labels = dict(_rows(f"SELECT doc_id, CAST(quality AS VARCHAR) FROM read_parquet('{sf_small}/labels.parquet') "
                        "WHERE quality IS NOT NULL"))
    train = [dict(d, target=labels[d["doc_id"]]) for d in docs if d["doc_id"] in labels]
    tree = _grow(train, ["lang", "source", "len_bin"])
    expected = {d["doc_id"]: _predict(tree, d) for d in docs}
    got = {r.doc_id: r.prediction for r in E.queries()["tree_predict"](spark, sf_small).collect()}
    assert got == expected
