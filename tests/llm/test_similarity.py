"""Operators 3, 5 and 8 against brute force."""

import glob
import random
import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import components, line_dedup, signature_tree, staging, textnum, topk_products

from . import cases


def test_release_drops_shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}
    before = files()
    table = staging.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    new = files() - before
    assert new and table.count() == 7
    staging.release(table)
    end = time.monotonic() + 30
    while new & files() and time.monotonic() < end:
        time.sleep(0.2)
    assert not new & files()


# ---- signature trees -------------------------------------------------------

@pytest.mark.parametrize("num,den", [(85, 100), (80, 100), (1, 2)])
def test_linked_sets_share_a_key(num, den):
    classes = signature_tree.Classes(num, den)
    rng = np.random.default_rng(7)
    for _ in range(1500):
        n = int(rng.integers(1, 12)) if rng.random() < 0.5 else int(rng.integers(12, 900))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        most = 2 * len(a) * (den - num) // (den + num)
        gone = int(rng.integers(0, most + 1))
        b = np.delete(a, rng.choice(len(a), min(gone, len(a) - 1), replace=False))
        b = np.unique(np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, max(1, most - gone + 1))), dtype=np.uint64)]))
        inter = len(np.intersect1d(a, b))
        if den * inter >= num * (len(a) + len(b) - inter):
            assert set(signature_tree.set_keys(a, classes)) & set(signature_tree.set_keys(b, classes)), (len(a), len(b))
            if len(a) != len(b) or inter < len(a):
                for x, y in ((a, b), (b, a)):
                    other = signature_tree.set_keys(y, classes)
                    assert any(np.isin(k, other).sum() >= least for k, least in signature_tree.keys_by_class(x, classes))


@pytest.mark.parametrize("num,den", [(85, 100), (80, 100)])
def test_linked_sets_share_one_of_their_first_keys(num, den):
    """Both sets with keys of their own and of third sets among them."""
    classes = signature_tree.Classes(num, den)
    rng = np.random.default_rng(11)
    left_out = 0
    for _ in range(600):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 900)), dtype=np.uint64))
        b = a[rng.random(len(a)) >= rng.random() * (den - num) / den]
        inter = len(b)
        b = np.unique(np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, 20)), dtype=np.uint64)]))
        if not len(b) or den * inter < num * (len(a) + len(b) - inter):
            continue
        both, sent = set(signature_tree.set_keys(a, classes)) & set(signature_tree.set_keys(b, classes)), []
        for s in (a, b):
            key, place, _, least = signature_tree.keys_of_sets(s, np.array([0, len(s)]), classes)
            ok = np.isin(key, list(both)) | (rng.random(len(key)) < 0.3)
            first, _ = signature_tree.first_keys(key[ok], place[ok], least)
            left_out += int(ok.sum()) - len(first)
            sent.append(set(first))
        assert sent[0] & sent[1], (len(a), len(b))
    assert left_out > 0


def test_keys_of_many_sets_are_those_of_each():
    classes = signature_tree.Classes(85, 100)
    rng = np.random.default_rng(12)
    sets = [np.unique(rng.integers(0, 2**63, int(n), dtype=np.uint64)) for n in rng.integers(1, 700, 50)]
    edge = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    key, place, owner, _ = signature_tree.keys_of_sets(np.concatenate(sets), edge, classes)
    for i, s in enumerate(sets):
        assert key[owner[place] == i].tolist() == signature_tree.set_keys(s, classes).tolist()


def test_tree_traversal_finds_the_components_of_all_pairs():
    rng = np.random.default_rng(3)
    sets = []
    for g in range(40):
        base = np.unique(rng.integers(0, 2**63, int(rng.integers(5, 300)), dtype=np.uint64))
        for _ in range(int(rng.integers(1, 9))):
            keep = rng.random(len(base)) > rng.random() * 0.15
            s = np.unique(np.concatenate([base[keep], rng.integers(0, 2**63, int(rng.integers(0, 8)), dtype=np.uint64)]))
            if len(s):
                sets.append(s)
    n, root = len(sets), np.arange(len(sets))
    want = np.arange(n)
    for i, j in combinations(range(n), 2):
        inter = len(np.intersect1d(sets[i], sets[j]))
        if 100 * inter >= 85 * (len(sets[i]) + len(sets[j]) - inter):
            want[want == want[j]] = want[i]
    for halves in ([np.arange(n)], [np.arange(0, n, 2), np.arange(1, n, 2)]):
        root = np.arange(n)
        bitmaps = [signature_tree.bitmap_of(s) for s in sets]
        size = np.array([len(s) for s in sets])
        words = min(map(len, bitmaps))
        trees = [signature_tree.SignatureTree(size[h], [bitmaps[i] for i in h], words, h) for h in halves]

        def linked(i, j, need):
            return signature_tree.overlap_reaches(sets[i], sets[j], need)

        for t, h in zip(trees, halves):
            signature_tree.traverse(t, t, root, h, h, 85, 100, linked)
        if len(trees) == 2:
            signature_tree.traverse(trees[0], trees[1], root, halves[0], halves[1], 85, 100, linked)
        open_pairs = signature_tree.traverse(trees[0], trees[-1], np.arange(n), halves[0], halves[-1], 85, 100, lambda *x: None)
        for i, j in combinations(range(n), 2):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if 100 * inter >= 85 * (len(sets[i]) + len(sets[j]) - inter) and (len(trees) == 1 or i % 2 != j % 2):
                assert (i, j) in open_pairs or (j, i) in open_pairs
        for i in range(n):
            while root[i] != root[root[i]]:
                root[i] = root[root[i]]
        assert len(set(zip(root.tolist(), want.tolist()))) == len(set(root.tolist())) == len(set(want.tolist()))


def brute_components(rows, num, den, width):
    sets = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        grams = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets.append(grams)
    root = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        inter = len(sets[i] & sets[j])
        if inter and den * inter >= num * (len(sets[i]) + len(sets[j]) - inter):
            a, b = root[i], root[j]
            root = [a if x == b else x for x in root]
    out = []
    for i, r in enumerate(rows):
        ids = [x[0] for k, x in enumerate(rows) if root[k] == root[i] and x[0] is not None]
        out.append((r[0], len(sets[i]), min(ids, default=r[0])))
    return sorted(out, key=str)


def near_copies(n, words=150, edits=3, start=1000):
    rng = random.Random(11)
    base = cases.prose(77, words).split()
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        rows.append((start + i, " ".join(w), "en", "near", 1))
    return rows


def test_join_on_awkward_rows_and_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(signature_tree, "CELL", 16)
    rows = cases.documents() + near_copies(90)
    docs = cases.table(spark, rows).withColumns({"n": F.lit("clash"), "name": F.lit("clash"), "component_id": F.lit(0)})
    got = signature_tree.jaccard_components(docs, 85, 100, 4, filter_bits=20).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, 85, 100, 4)


def test_members_of_groups_of_one_cell_get_their_components_once(spark, monkeypatch):
    """However many turns the groups of several cells take."""
    monkeypatch.setattr(signature_tree, "CELL", 16)
    rows = near_copies(90) + near_copies(14, edits=14, words=140, start=2000)
    docs, counts = cases.table(spark, rows), []
    frame = type(docs)

    def join(self, other, on=None, how=None, join=frame.join):
        if how == "left" and isinstance(on, str) and on == "name":
            counts.append((self.where("n <= 16").count(), self.where("n > 16").count()))
        return join(self, other, on, how)

    monkeypatch.setattr(frame, "join", join)
    got = signature_tree.jaccard_components(docs, 85, 100, 4, filter_bits=20).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, 85, 100, 4)
    small, large = zip(*counts)
    assert sum(n > 0 for n in small) == 1 and sum(n > 0 for n in large) >= 2


def test_join_on_empty_and_unlinked_tables(spark):
    assert signature_tree.jaccard_components(cases.table(spark, []), filter_bits=20).count() == 0
    rows = [(1, "a b c d e f", "en", "a", 1), (2, "g h i j k l", "en", "a", 1), (3, None, "en", "a", 1)]
    got = signature_tree.jaccard_components(cases.table(spark, rows), filter_bits=20).collect()
    assert sorted(map(tuple, got)) == [(1, 2, 1), (2, 2, 2), (3, 0, 3)]


def test_stage_keeps_the_first_of_each_group(spark):
    rows = [(i, cases.prose(i, 60), "en", "a", 1) for i in range(5)] + [(10, cases.prose(2, 60), "en", "a", 1), (11, "", "en", "a", 1), (12, None, "en", "a", 1)]
    out = signature_tree.keep_one_of_each(spark, cases.table(spark, rows), "")
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 1, 2, 3, 4, 11, 12]


def test_stage_decides_by_row(spark):
    """Another text of a dropped id stays, copies without ids leave one."""
    near = cases.prose(1, 120)
    rows = [(3, near, "en", "a", 1), (5, near + " end", "en", "a", 1), (5, cases.prose(7, 90), "en", "a", 1), (3, near, "en", "z", 1),
            (None, cases.prose(8, 50), "en", "a", 1), (None, cases.prose(8, 50), "en", "b", 1), (None, near, "en", "a", 1), (None, None, "en", "a", 1)]
    out = signature_tree.keep_one_of_each(spark, cases.table(spark, rows), "")
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == sorted(
        [(3, near), (5, cases.prose(7, 90)), (0, cases.prose(8, 50)), (0, "")])


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {i: 200 for i in range(200, 203)}
    assert got == want
    assert components.components(df.limit(0)).count() == 0


# ---- lines -----------------------------------------------------------------

def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_lines_within_one_edit_share_gapped_keys_and_neighbours():
    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choice("abé🙂 ") for _ in range(rng.randint(0, 60))) + "x"
        i, kind = rng.randrange(len(a)), rng.randrange(3)
        b = a[:i] + ("" if kind == 0 else rng.choice("abz")) + a[i + (kind != 1):]
        x = line_dedup.Lines([a, b], whole=True)
        assert len(x.row) == 2
        for segments in (2, 32):
            line, key, start, stop = x.gapped_keys(segments)
            both = set(key[line == 0]) & set(key[line == 1])
            assert both
        places = [np.unique(np.concatenate([np.arange(start[k], stop[k]) for k in np.flatnonzero((line == i) & np.isin(key, list(both)))]))
                  for i in (0, 1)]
        one, two = ({(int(k), role) for keys, role in x.neighbourhood(i, places[i]) for k in keys} for i in (0, 1))
        meets = {(k, r) for k, r in one if r == 2} & {(k, r) for k, r in two if r == 2}
        meets |= {k for k, r in one if r == 1} & {k for k, r in two if r == 0} | {k for k, r in one if r == 0} & {k for k, r in two if r == 1}
        assert meets


def brute_lines(rows):
    order = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in rows if r[1]}, key=lambda k: k[:2])
    seen, out = [], {}
    for k in order:
        kept, gone = [], 0
        for line in k[2].split("\n"):
            if not line.strip(" \t\n\x0b\x0c\r"):
                kept.append(line)
                continue
            if any(line == s or abs(len(line) - len(s)) < 2 and edits(line, s) <= 1 for s in seen):
                gone += 1
            else:
                kept.append(line)
            seen.append(line)
        out[k] = ("\n".join(kept), gone)
    return out


def test_line_dedup_matches_brute_force(spark):
    rows = [r for r in cases.documents() if r[0] != 11]
    long_line = cases.prose(50, 40, 1000)
    rows += [(30, long_line + "\nshort\n" + long_line, "en", "a", 1), (31, long_line[:70] + "Q" + long_line[71:], "en", "a", 1),
             (32, long_line[:10] + long_line[11:] + "\n\n \nother line of this text", "en", "a", 1),
             (33, "shorn\nshort\nother line of this texts", "en", "a", 1)]
    rows += [(40 + i, long_line[:i] + "Z" + long_line[i:] + "\n" + cases.prose(60 + i, 20), "en", "a", 1) for i in range(20)]
    docs = cases.table(spark, rows).withColumns({"n_removed": F.lit("clash"), "h": F.lit("clash"), "extra": F.lit(1)})
    out = line_dedup.dedup_lines(docs)
    assert out.columns.count("n_removed") == 1 and {"h", "extra"} <= set(out.columns)
    got, want = out.collect(), brute_lines(rows)
    before = {(r[0], r[1]) for r in rows}
    assert len(got) == len(rows)
    by_id = {(k[1] if k[0] else None): v for k, v in want.items()}
    for r in got:
        if r["doc_id"] in by_id:
            assert (r["text"], r["n_removed"]) == by_id[r["doc_id"]], r["doc_id"]
        else:
            assert (r["doc_id"], r["text"]) in before and r["n_removed"] == 0


def test_line_dedup_on_empty_table_and_stage(spark):
    assert line_dedup.dedup_lines(cases.table(spark, [])).count() == 0
    assert line_dedup.dedup_lines(cases.table(spark), max_edits=0).count() == len(cases.documents())
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(cases.table(spark), max_edits=2)
    out = line_dedup.drop_repeated_lines(spark, cases.table(spark), "")
    assert out.columns == cases.table(spark).columns
    ids = [r["doc_id"] for r in out.collect()]
    assert 1 in ids and 2 not in ids and {5, 6, 7, 8, 11} <= set(ids)


# ---- products --------------------------------------------------------------

def test_top_products_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk_products, "CANDIDATE_BLOCK", 20)
    monkeypatch.setattr(topk_products, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    vectors = [(i, [float(np.float32(x)) for x in np.round(rng.normal(size=6), 1)]) for i in range(120)]
    vectors += [(i, vectors[0][1]) for i in range(120, 140)] + [(200, None), (201, [1.0, None]), (202, [float("nan")]), (203, [float("inf")])]
    vectors += [(50, vectors[50][1]), (None, [1.0]), (204, []), (205, [3.0]), (206, [1e30, -1e30])]
    df = spark.createDataFrame([(a, v, "x") for a, v in vectors], "vec_id bigint, embedding array<float>, score string")
    got = topk_products.top_products(df, F.col("vec_id") % 50 == 0).collect()
    ok = {a: [int(np.floor(256.0 * np.float32(x))) for x in v] for a, v in vectors
          if a is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for a in ok:
        if a % 50 == 0:
            s = sorted((-max(min(sum(x * y for x, y in zip(ok[a], v)), 2**63 - 1), -2**63), b) for b, v in ok.items() if b != a)[:5]
            want += [(a, k + 1, b, -c) for k, (c, b) in enumerate(s)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk_products.top_products(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_lookup_finds_what_it_holds():
    keys = textnum.mix(np.arange(5000, dtype=np.uint64))
    t = textnum.Lookup(keys, np.arange(5000))
    assert (t.find(keys) == np.arange(5000)).all()
    assert (t.find(textnum.mix(np.arange(5000, 9000, dtype=np.uint64))) == -1).all()
    assert (textnum.Lookup(keys[:0], keys[:0]).find(keys) == -1).all()


def test_components_of_more_edges_than_a_task_joins(spark, monkeypatch):
    monkeypatch.setattr(components, "LOCAL", 8)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 200), (201, 202), (202, 200)]
    random.Random(5).shuffle(edges)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 130)} | {i: 200 for i in range(200, 203)}


def test_few_edges_are_joined_in_one_step(spark, monkeypatch):
    """However long a path: rounds of joins took 9 tables for one like this."""
    written = []
    monkeypatch.setattr(components, "stage", lambda df, name: written.append(name) or staging.stage(df, name))
    df = spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint")
    assert {r["root"] for r in components.components(df).collect()} == {0}
    assert len(written) == 2


def test_lean_tables_leave_no_shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}
    before, counts = files(), spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    table, setting = staging.stage_lean(counts, "counts"), spark.conf.get(staging._CLEANUP)
    end = time.monotonic() + 30
    while files() - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not files() - before and setting == "false"
    assert table.count() == 7 and staging.stage(counts, "counts").count() == 7 and files() - before
