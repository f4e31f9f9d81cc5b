"""Table comparison: multiset difference with counts, set difference,
keyed reconciliation with duplicate keys, header comparison."""

from lodestar.operators import diff as D


def test_table_diff_counts(spark):
    a = spark.createDataFrame([(1, "x")] * 5 + [(2, "y"), (None, "z")], "k int, v string")
    e = spark.createDataFrame([(1, "x")] * 2 + [(3, "w"), (None, "z")], "k int, v string")
    got = sorted((r.k, r.v, r.side, r.n) for r in D.table_diff(a, e).collect())
    assert got == [(1, "x", "extra", 3), (2, "y", "extra", 1), (3, "w", "missing", 1)]
    got = sorted((r.k, r.v, r.side) for r in D.table_diff(a, e, multiset=False).collect())
    assert got == [(2, "y", "extra"), (3, "w", "missing")]


def test_reconcile_statuses(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0), (4, 1.0), (4, 2.0), (5, None)], "k int, v double")
    e = spark.createDataFrame([(1, 10.0), (2, 21.0), (3, 30.0), (5, None)], "k int, v double")
    got = {r.k: r.status for r in D.reconcile(a, e, ["k"], "v").collect()}
    assert got == {1: "same", 2: "changed", 3: "missing", 4: "duplicate key", 5: "same"}


def test_header_problems(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert D.header_problems(df, ["a", "b"]) == []
    assert D.header_problems(df, ["b", "a"]) == ["column 0: 'a' != 'b'", "column 1: 'b' != 'a'"]
    assert D.header_problems(df, ["a"]) == ["2 columns, expected 1"]


def test_diff_by_checksums_equals_diff(spark):
    import random

    from lodestar.operators import diff as D

    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, "a", "b"]), rng.choice([None, 0.0, -0.0, 1.5]), i % 50) for i in range(400)]
    other = rows[:200] + rows[210:] + rows[:5] + [(None, "z", None, None)] * 3
    swapped = [(b, a, x, i) for a, b, x, i in rows]  # nulls in other places
    make = lambda r: spark.createDataFrame(r, "a string, b string, x double, i int")
    for left, right in ((rows, rows[::-1]), (rows, other), (other, rows), (swapped, rows), ([], rows), (rows, []), ([], [])):
        for ranges, multiset in ((1, True), (37, True), (1 << 16, False)):
            got = D.table_diff_by_checksums(make(left), make(right), multiset, ranges).collect()
            want = D.table_diff(make(left), make(right), multiset).collect()
            assert sorted(map(str, got)) == sorted(map(str, want))
        if left == rows and right == rows[::-1]:
            assert not got
